"""Operator 2: token ids in a directly addressable file format.

Every id is cut into chunks of 8 bits. Level 0 holds the lowest chunk of all ids and a bitmap that
tells which ids go on; level 1 holds the next chunk of those, and so forth. A rank directory counts
the ones before every 512 bits, so any id is found with one rank per level and no block is decoded.

The file is a Parquet folder of segments in ascending doc_id order: whole documents, about
`segment_tokens` ids each. Documents are range-partitioned once by doc_id; a segment knows the ids
before it in its partition, and the few partition totals give every partition's base. Documents
with equal doc_id follow one another by text; a null doc_id comes first. Null and empty texts hold
only the end id. An empty table gives no segments. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, id_text, scratch, sliced
from tickloom.llm.tokenizing import model_text, word_encoder

RANK_BITS = 512
SEGMENT = "part int, tokens_before long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, levels array<binary>, bitmaps array<binary>, ranks array<binary>"
SEGMENT_ARROW = pa.schema([
    ("part", pa.int32()), ("tokens_before", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int64())), ("levels", pa.list_(pa.binary())), ("bitmaps", pa.list_(pa.binary())), ("ranks", pa.list_(pa.binary())),
])
_ONES = np.array([bin(x).count("1") for x in range(256)], np.uint32)


class Codes:
    """Directly addressable codes of a sequence of unsigned numbers."""

    def __init__(self, levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.levels = [np.frombuffer(x, np.uint8) for x in levels]
        self.bitmaps = [np.frombuffer(x, np.uint8) for x in bitmaps]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    @staticmethod
    def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
        levels, bitmaps, ranks = [], [], []
        rest = ids.astype(np.uint64)
        while True:
            levels.append((rest & np.uint64(255)).astype(np.uint8).tobytes())
            more = rest >= 256
            bits = np.packbits(more, bitorder="little")
            counts = np.add.reduceat(_ONES[bits], np.arange(0, len(bits), RANK_BITS // 8)) if len(bits) else np.zeros(0, np.uint32)
            bitmaps.append(bits.tobytes())
            ranks.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u4").tobytes())
            rest = rest[more] >> np.uint64(8)
            if not len(rest):
                return levels, bitmaps, ranks

    def __len__(self) -> int:
        return len(self.levels[0])

    def at(self, i: int) -> int:
        """The i-th number."""
        value = 0
        for k, level in enumerate(self.levels):
            value |= int(level[i]) << (8 * k)
            bits = self.bitmaps[k]
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            first = block * RANK_BITS // 8
            i = int(self.ranks[k][block]) + int(_ONES[bits[first : i >> 3]].sum()) + int(_ONES[bits[i >> 3] & ((1 << (i & 7)) - 1)])
        return value

    def between(self, a: int, b: int) -> np.ndarray:
        """Numbers a to b - 1: one rank per level, then runs of neighbours."""
        out = np.zeros(b - a, np.uint32)
        where = np.arange(b - a)
        for k, level in enumerate(self.levels):
            if not len(where):
                break
            out[where] |= level[a : a + len(where)].astype(np.uint32) << np.uint32(8 * k)
            bits = self.bitmaps[k]
            more = np.unpackbits(bits[a >> 3 : (a + len(where) + 7) >> 3], bitorder="little")[a & 7 : (a & 7) + len(where)].astype(bool)
            block = a // RANK_BITS
            first = block * RANK_BITS // 8
            a = int(self.ranks[k][block]) + int(_ONES[bits[first : a >> 3]].sum()) + int(_ONES[bits[a >> 3] & ((1 << (a & 7)) - 1)] if a & 7 else 0)
            where = where[more]
        return out


def write_ids(docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int = 1, segment_tokens: int = 1 << 16, special_as_text: bool = False) -> None:
    """Write the ids of all documents to the Parquet folder `path`."""
    model = model_text(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = word_encoder(model, special_as_text), TaskContext.get().partitionId(), 0
        names, lengths, held, size = [], [], [], 0

        def out():
            nonlocal before
            ids = np.concatenate(held)
            levels, bitmaps, ranks = Codes.pack(ids)
            row = [[part], [before], [len(ids)], [names], [lengths], [levels], [bitmaps], [ranks]]
            before += len(ids)
            return batch_of(SEGMENT_ARROW, *row)

        for rows, buf, at in sliced(batches, most=1 << 18):
            ids, offsets = encoder.encode(buf, at, end_id)
            names += rows.column("doc_id").to_pylist()
            lengths += np.diff(offsets).tolist()
            held.append(ids)
            size += len(ids)
            if size >= segment_tokens:
                yield out()
                names, lengths, held, size = [], [], [], 0
        if held:
            yield out()

    placed = id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    placed.mapInArrow(run, SEGMENT).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments of the file with `start`, the number of ids in the file before each."""
    segments = spark.read.parquet(path)
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # one row per partition of the file
    base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    return segments.join(base, "part").withColumn("start", F.col("base") + F.col("tokens_before"))


def token_at(spark: SparkSession, path: str, position: int) -> DataFrame:
    """The id at a position of the whole file (one row, none beyond the end).

    The segment is found from the narrow columns first; the scan that reads codes is then filtered by its
    two literals, so that Parquet skips all other segments.
    """

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["levels"], row["bitmaps"], row["ranks"])
                yield pa.RecordBatch.from_pydict({"token_id": pa.array([codes.at(position - start)], pa.int64())})

    places = read_segments(spark, path).select("part", "tokens_before", "start", "n_tokens")
    found = places.where((F.col("start") <= position) & (position < F.col("start") + F.col("n_tokens"))).first()
    part, before, start = (found.part, found.tokens_before, found.start) if found else (-1, -1, 0)
    segment = spark.read.parquet(path).where((F.col("part") == part) & (F.col("tokens_before") == before))
    return segment.select("levels", "bitmaps", "ranks").mapInArrow(run, "token_id long")


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the file."""
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("start", "doc_ids", "doc_tokens", "levels", "bitmaps", "ranks")}
                codes = Codes(row["levels"], row["bitmaps"], row["ranks"])
                ends = np.cumsum(row["doc_tokens"])
                begins = ends - row["doc_tokens"]
                crc = [zlib.crc32(codes.between(a, b).astype("<u4").tobytes()) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield batch_of(schema, row["doc_ids"], begins + row["start"], row["doc_tokens"], crc)

    columns = ("start", "doc_ids", "doc_tokens", "levels", "bitmaps", "ranks")
    return read_segments(spark, path).select(*columns).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the documents' ids to the shared folder and read the digest back."""
    path = scratch(docs.sparkSession, "token-ids")
    write_ids(docs, path, **options)
    return read_digest(docs.sparkSession, path)
