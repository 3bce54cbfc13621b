"""Integer vectors in columnar blocks, and queries that stream past them (for operators 11 and 12).

Every component x becomes floor(scale * x), computed on doubles. Rows are packed into chunks of
up to `chunk_rows` vectors, dimension by dimension, and chunks are dealt to blocks of about `block_bytes`.
Queries are dealt to tiles. A unit is one block with one tile: its chunks come first, then its queries
stream past, so a task holds one block and a few queries. Blocks are taken in phases of growing
size, so that what earlier phases found bounds what later ones send; all blocks are met.

Vectors that are null, hold null or non-finite components, have no id, or another length than
the most frequent one (ties: the longer) take no part; neither do vectors whose scaled components have a
sum of squares of 2**55 or more, so that every inner product, and a hundred times it, is an exact 64-bit number.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_ROWS = 1024
LARGEST = 2.0**55
EXACT = 2.0**52  # squares below it: doubles hold every partial sum exactly
CHUNKS = "block int, ids binary, labels binary, cells binary, width int"
ASKS = "query_id long, label long, q binary"


def _integers(column: pa.Array, dim: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that take part, and their integers as doubles (rows by dimensions)."""
    size = np.array(pc.fill_null(pc.list_value_length(column), -1))
    rows = np.flatnonzero(size == dim)
    cells = column.take(pa.array(rows)).flatten()
    values = np.array(pc.fill_null(cells, float("nan")), np.float64).reshape(len(rows), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(scale * values)
        good = (values * values).sum(1) < LARGEST  # false for what is not finite
    return rows[good], values[good]


def _packed(values: np.ndarray) -> tuple[bytes, int]:
    """Integers in the narrowest type, and its bytes."""
    top = np.abs(values).max(initial=0)
    width = 2 if top < 2**15 else 4 if top < 2**31 else 8
    return values.astype(f"<i{width}").tobytes(), width


@dataclass
class Block:
    """Vectors by dimension: cells[d] holds component d of all vectors."""

    dim: int
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    cells: np.ndarray | None = None
    parts: list = field(default_factory=list)

    def add(self, ids: bytes, labels: bytes, cells: bytes, width: int) -> None:
        names = np.frombuffer(ids, "<i8")
        self.parts.append((names, np.frombuffer(labels, "<i8"), np.frombuffer(cells, f"<i{width}").reshape(self.dim, len(names))))

    def close(self) -> None:
        self.ids, self.labels = (np.concatenate([x[k] for x in self.parts]) for k in (0, 1))
        whole = np.empty((self.dim, len(self.ids)))
        at = 0
        for names, _, cells in self.parts:
            whole[:, at : at + len(names)] = cells
            at += len(names)
        self.parts = []
        if (whole * whole).sum(0).max(initial=0) >= EXACT:
            whole = whole.astype(np.int64)
        self.cells = whole


@dataclass(frozen=True)
class Corpus:
    """Rows (vec_id, label, v) of one length, and how they are dealt."""

    rows: DataFrame
    dim: int
    scale: float
    blocks: int
    chunk_rows: int

    @staticmethod
    def of(vectors: DataFrame, scale: float, label: Column | None = None, block_bytes: int = 1 << 25, chunk_rows: int = CHUNK_ROWS) -> Corpus:
        mark = F.lit(0) if label is None else label
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), mark.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
        rows = rows.where("vec_id is not null and label is not null and v is not null")
        sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
        dim, n = (sizes["dim"], sizes["count"]) if sizes else (0, 0)
        in_block = max(chunk_rows, block_bytes // (8 * max(dim, 1)))
        return Corpus(rows, dim, scale, max(-(-n // in_block), min(n // chunk_rows + 1, rows.sparkSession.sparkContext.defaultParallelism)), chunk_rows)

    def phases(self) -> list[tuple[int, int]]:
        """Ranges of blocks, each eight times what came before it; one range if blocks are few."""
        ends, end = [], max(8, self.blocks // 512)
        while end < self.blocks:
            ends.append(end)
            end *= 9
        ends.append(self.blocks)
        return list(zip([0, *ends[:-1]], ends, strict=True))

    def chunks(self) -> DataFrame:
        dim, scale, blocks, most = self.dim, self.scale, self.blocks, self.chunk_rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, values = _integers(batch.column("v"), dim, scale)
                ids, labels = (np.array(batch.column(c), "<i8")[rows] for c in ("vec_id", "label"))
                for i in range(0, len(rows), most):
                    own = slice(i, i + most)
                    cells, width = _packed(np.ascontiguousarray(values[own].T))
                    names = ids[own].tobytes()
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([zlib.crc32(names) % blocks], pa.int32()), "ids": pa.array([names], pa.binary()), "labels": pa.array([labels[own].tobytes()], pa.binary()),
                        "cells": pa.array([cells], pa.binary()), "width": pa.array([width], pa.int32()),
                    })

        return self.rows.mapInArrow(run, CHUNKS)

    def asks(self, which: Column) -> DataFrame:
        """(query_id, label, q) of the rows that ask; of rows with one id, the least by label and bytes."""
        dim, scale = self.dim, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, values = _integers(batch.column("v"), dim, scale)
                at = pa.array(rows)
                q = [x.tobytes() for x in values.astype("<i8")]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(at), batch.column("label").take(at), pa.array(q, pa.binary())], ["query_id", "label", "q"])

        found = self.rows.where(which).mapInArrow(run, ASKS)
        return found.groupBy("query_id").agg(F.min(F.struct("label", "q")).alias("x")).select("query_id", "x.label", "x.q")

    def meet(self, chunks: DataFrame, asks: DataFrame, phase: tuple[int, int], n_asks: int, kernel: Callable, schema: str, tile_rows: int = 1 << 16) -> DataFrame:
        """kernel(block, batch of asks, their vectors) for every block of the phase and all asks.

        asks has `low` and `high` (array<long>) besides the columns of `asks()`: what a kernel needs to
        know of each. The kernel yields record batches.
        """
        dim, tiles = self.dim, max(1, -(-n_asks // tile_rows))
        own = chunks.where((F.col("block") >= phase[0]) & (F.col("block") < phase[1]))
        spread_ = F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))
        none = F.lit(None)
        left = own.withColumn("tile", spread_).select(
            (F.col("block").cast("long") * tiles + F.col("tile")).alias("unit"), F.lit(0).alias("kind"), "ids", "labels", "cells", "width",
            none.cast("long").alias("query_id"), none.cast("long").alias("label"), none.cast("binary").alias("q"), none.cast("array<long>").alias("low"), none.cast("array<long>").alias("high"),
        )
        right = asks.withColumn("block", F.explode(F.sequence(F.lit(phase[0]), F.lit(phase[1] - 1)))).select(
            (F.col("block").cast("long") * tiles + F.pmod(F.xxhash64("query_id"), F.lit(tiles))).alias("unit"), F.lit(1), none.cast("binary"), none.cast("binary"), none.cast("binary"), none.cast("int"),
            "query_id", "label", "q", "low", "high",
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unit, block = None, Block(dim)
            for batch in batches:
                part, kind = np.array(batch.column("unit")), np.array(batch.column("kind"))
                edges = np.flatnonzero((np.diff(part) != 0) | (np.diff(kind) != 0)) + 1
                for a, b in zip([0, *edges], [*edges, len(part)], strict=True):
                    if a == b:
                        continue
                    rows = batch.slice(a, b - a)
                    if part[a] != unit:
                        unit, block = part[a], Block(dim)
                    if kind[a] == 0:
                        for x in zip(*(rows.column(c).to_pylist() for c in ("ids", "labels", "cells", "width")), strict=True):
                            block.add(*x)
                        continue
                    if block.parts:
                        block.close()
                    if block.cells is not None:
                        q = np.frombuffer(b"".join(rows.column("q").to_pylist()), "<i8").reshape(b - a, dim)
                        yield from kernel(block, rows, q.astype(block.cells.dtype))

        return left.union(right).repartition("unit").sortWithinPartitions("unit", "kind").mapInArrow(run, schema)
