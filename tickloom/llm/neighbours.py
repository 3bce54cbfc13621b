"""Operator 7: nearest neighbours by randomly rotated one-bit codes.

A unit vector is rotated at random and kept as the signs of its components, packed to bits, with one
correction scalar: the inner product of the vector with its code. Short vectors are padded with zeros
before the rotation, which gives longer codes and tighter bounds. The inner product with a query is
estimated from the code; its error is at most `sigmas` standard deviations of the estimate, which
depends on the scalar. Codes lie in blocks; every query meets every block. A block sends the
candidates whose upper bound reaches the k-th best lower bound of the block, the best lower bounds of
all blocks prune once more, and what is left is reranked by exact cosines of the original vectors.
Every row is coded; nothing is fitted but a seeded rotation.

Vectors that are null, zero, or hold null or non-finite components take no part; neither do vectors
of another length than the most frequent one (ties: the longer). Repeated vec_ids are candidates
once each; a query id is searched once, with the first of its vectors. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import saved

BLOCK_ROWS = 1 << 16
QUERIES_AT_ONCE = 64


def rotation(dim: int, code_bits: int = 512, seed: int = 7) -> np.ndarray:
    """The first `dim` rows of a random rotation of `code_bits` dimensions: vectors are padded with zeros."""
    wide = max(dim, code_bits)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((wide, wide)))
    return (q * np.sign(np.diag(r)))[:dim]


def encode(unit: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of rotated unit vectors, and each vector's inner product with its code."""
    turned = unit @ turn
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / np.sqrt(turned.shape[1])


def bounds(bits: np.ndarray, scalar: np.ndarray, queries: np.ndarray, turn: np.ndarray, sigmas: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (queries by codes), and each code's error bound."""
    dim = turn.shape[1]
    signs = np.unpackbits(bits, axis=1)[:, :dim].astype(np.float32) * 2 - 1
    raw = (queries @ turn).astype(np.float32) @ signs.T / np.float32(np.sqrt(dim))
    error = sigmas * np.sqrt(np.maximum(0, 1 - scalar**2)) / scalar / np.sqrt(max(1, dim - 1))
    return raw / scalar.astype(np.float32), error


def _usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    finite: Column = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    dims = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dim = dims.n if dims else 0
    largest = F.array_max(F.transform("v", F.abs))  # scaled first, so that squares neither vanish nor overflow
    rows = rows.where(F.size("v") == dim).select("vec_id", F.transform("v", lambda x: x / largest).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return rows.select("vec_id", F.transform("v", lambda x: x / norm).alias("v")), dim


def search(vectors: DataFrame, queries: Column, *, k: int = 5, sigmas: float = 3.0, code_bits: int = 512, seed: int = 7) -> DataFrame:
    """The k nearest other rows of each query row: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows, dim = _usable(vectors)
    turn = rotation(dim, code_bits, seed) if dim else np.zeros((0, 0))
    total = rows.count()
    blocks = max(-(-total // BLOCK_ROWS), min(total // 1024 + 1, spark.sparkContext.defaultParallelism))
    asked = rows.where(queries).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("q"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, scalar = encode(np.array(batch.column("v").flatten()).reshape(-1, dim), turn)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([x.tobytes() for x in bits], pa.binary()), pa.array(scalar)], ["vec_id", "bits", "scalar"])

    codes = rows.mapInArrow(code, "vec_id long, bits binary, scalar double")
    mixed = codes.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("is_query"), "vec_id", "bits", "scalar", F.lit(None).cast("array<double>").alias("q"),
    ).union(asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True), "query_id", F.lit(None).cast("binary"), F.lit(None).cast("double"), "q",
    ))
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("low", pa.float32()), ("high", pa.float32()), ("lead", pa.bool_())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come block by block, codes before queries; queries pass through in small groups."""
        block, ids, bits, scalar, known = None, [], [], [], None
        for batch in batches:
            part, asks = np.array(batch.column("block")), np.array(batch.column("is_query"))
            edges = np.flatnonzero((np.diff(part) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(part)], strict=True):
                if a == b:
                    continue
                run = batch.slice(a, b - a)
                if part[a] != block:
                    block, ids, bits, scalar, known = part[a], [], [], [], None
                if not asks[a]:
                    ids.append(np.array(run.column("vec_id")))
                    bits.append(np.frombuffer(b"".join(run.column("bits").to_pylist()), np.uint8).reshape(b - a, -1))
                    scalar.append(np.array(run.column("scalar")))
                    continue
                if not ids:
                    continue
                if known is None:
                    known = np.concatenate(ids), np.concatenate(bits), np.concatenate(scalar)
                names, vectors_ = np.array(run.column("vec_id")), np.array(run.column("q").flatten()).reshape(b - a, dim)
                for i in range(0, b - a, QUERIES_AT_ONCE):
                    mid, error = bounds(known[1], known[2], vectors_[i : i + QUERIES_AT_ONCE], turn, sigmas)
                    own = names[i : i + QUERIES_AT_ONCE]
                    low, high = mid - error, mid + error
                    self_ = known[0][None, :] == own[:, None]
                    low[self_] = high[self_] = -np.inf
                    reach = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(own), -1e30)
                    q, c = np.nonzero((high >= reach[:, None]) & ~self_)
                    cells = own[q], known[0][c], low[q, c].astype(np.float32), high[q, c].astype(np.float32), low[q, c] >= reach[q]
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cells, out, strict=True)], schema=out)

    placed = mixed.repartition("block").sortWithinPartitions("block", "is_query")
    if not dim:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    candidates = saved(placed.mapInArrow(meet, "query_id long, vec_id long, low float, high float, lead boolean"), "candidates")
    best = Window.partitionBy("query_id").orderBy(F.desc("low"))
    leads = candidates.where("lead").select("query_id", "low")  # about k per query and block
    reach = leads.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).groupBy("query_id").agg(F.min("low").alias("reach"), F.count("*").alias("n"))
    left = candidates.join(reach, "query_id").where((F.col("high") >= F.col("reach")) | (F.col("n") < k)).select("query_id", "vec_id").distinct()
    scored = left.join(rows, "vec_id").join(asked, "query_id").select(
        "query_id", "vec_id", F.aggregate(F.zip_with("v", "q", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x).alias("score"),
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
