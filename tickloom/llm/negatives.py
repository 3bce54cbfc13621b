"""Operator 12: hard-negative mining by a secondary-sort shuffle.

An anchor's positives are its `positives` best rows of the same label. Each positive opens a window of scores,
from `least` to `most` percent of its own; the best rows of other labels inside it are its negatives.

1. Blocks of vectors (see `vectors`) send the best rows of the same label of each anchor; the bounds
   of earlier phases keep that to a few.
2. Blocks send the rows of other labels that can be among the first of a window. A row is sent once for
   an anchor, whatever windows it is in.
3. Pairs are packed into keys (anchor, descending score, kind, id) whose byte order is the order
   wanted. They are partitioned by anchor and sorted within partitions by key. One pass over the keys
   holds the open windows of a single anchor: a positive opens a window, a negative is
   emitted for every window that holds its score and is not full. A window lies below its positive, so
   it is open when its negatives come; at score 0 the kind puts positives first.

Scores are inner products of integers floor(scale * x); ties go to the smaller vec_id. Rows of an anchor's
own vec_id are neither positives nor negatives. Rows without a label take no part; for others that do
not see `vectors`. An anchor id that occurs several times is taken once, with its least label and then
vector; other repeated rows count once each. A positive with a score below 0 has an empty window.
An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import saved
from tickloom.llm.topk import best_of
from tickloom.llm.vectors import CHUNK_ROWS, Block, Corpus

PAIRS = "anchor_id long, key binary"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
POSITIVE, NEGATIVE = 0, 1
_KEY = np.dtype([("anchor", ">u8"), ("below", ">u8"), ("kind", "u1"), ("id", ">u8")])
_HALF = np.uint64(1 << 63)
_TOP = 1 << 62
AT_ONCE = 32


def pack(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> list[bytes]:
    """Keys whose order as bytes is that of anchor, descending score, kind, id."""
    out = np.empty(len(ids), _KEY)
    out["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ _HALF
    out["below"] = (_TOP - score.astype(np.int64)).view(np.uint64)
    out["kind"] = kind
    out["id"] = ids.astype(np.int64).view(np.uint64) ^ _HALF
    return [x.tobytes() for x in out]


def unpack(keys: list[bytes]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Anchors, scores, kinds and ids."""
    raw = np.frombuffer(b"".join(keys), _KEY)
    anchor, ids = ((raw[c].astype(np.uint64) ^ _HALF).view(np.int64).tolist() for c in ("anchor", "id"))
    return anchor, (_TOP - raw["below"].astype(np.uint64).view(np.int64)).tolist(), raw["kind"].tolist(), ids


def window(score: int, least: int, most: int) -> tuple[int, int]:
    """Smallest and largest score s with least*score <= 100*s <= most*score."""
    return -(-least * score // 100), most * score // 100


def _windows(block: Block, rows: pa.RecordBatch, q: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
    """Kernel: rows of other labels that are among the first n of a window (low and high of each) in this block."""
    names, labels = np.array(rows.column("query_id")), np.array(rows.column("label"))
    low, high = rows.column("low").to_pylist(), rows.column("high").to_pylist()
    for a in range(0, len(names), AT_ONCE):
        scores = q[a : a + AT_ONCE] @ block.cells
        keys, of = [], []
        for i, score in enumerate(scores, a):
            other = np.flatnonzero((block.labels != labels[i]) & (block.ids != names[i]))
            score = score[other]
            kept = []
            for x, y in zip(low[i], high[i], strict=True):
                inside = np.flatnonzero((score >= x) & (score <= y))
                if len(inside) > n:
                    reach = np.partition(score[inside], len(inside) - n)[len(inside) - n]
                    inside = inside[score[inside] >= reach]
                    inside = inside[np.lexsort((block.ids[other[inside]], -score[inside]))[:n]]
                kept.append(inside)
            some = np.unique(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
            keys += pack(np.full(len(some), names[i]), score[some], NEGATIVE, block.ids[other[some]])
            of += [names[i]] * len(some)
        yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(keys, pa.binary())], ["anchor_id", "key"])


def sweep(pairs: DataFrame, positives: int, negatives: int, least: int, most: int) -> DataFrame:
    """The negatives of every anchor and positive, from one pass over the sorted keys."""
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    out = pa.schema([(n, pa.int32() if n == "rank" else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, opened, open_ = None, 0, []
        for batch in batches:
            rows = []
            for a, score, kind, i in zip(*unpack(batch.column("key").to_pylist()), strict=True):
                if a != anchor:
                    anchor, opened, open_ = a, 0, []
                if kind == POSITIVE:
                    if opened < positives:
                        opened += 1
                        open_.append([*window(score, least, most), 0, i, score])
                    continue
                for w in open_:
                    if w[0] <= score <= w[1] and w[2] < negatives:
                        w[2] += 1
                        rows.append((a, w[3], w[2], i, w[4], score))
                open_ = [w for w in open_ if w[2] < negatives and w[0] <= score]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True) if rows else [[]] * len(out), out, strict=True)], schema=out)

    return pairs.repartition("anchor_id").sortWithinPartitions("anchor_id", "key").mapInArrow(run, MINED)


def _hundredth(x: Column) -> Column:
    """Largest whole number that is not above x / 100."""
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100).cast("long"))


def _keys(found: DataFrame) -> DataFrame:
    """Positives as pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, score, ids = (np.array(batch.column(c)) for c in ("query_id", "score", "vec_id"))
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), pa.array(pack(anchor, score, POSITIVE, ids), pa.binary())], ["anchor_id", "key"])

    return found.mapInArrow(run, PAIRS)


def mine(
    vectors: DataFrame, anchors: Column, *, label: Column | None = None, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    scale: float = 256.0, block_bytes: int = 1 << 25, chunk_rows: int = CHUNK_ROWS, tile_rows: int = 1 << 16,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. least, most: percent, 0 <= least <= most < 100."""
    if not 0 <= least <= most < 100:
        raise ValueError("windows must lie below their positives")
    corpus = Corpus.of(vectors, scale, F.col("label") if label is None else label, block_bytes, chunk_rows)
    chunks = saved(corpus.chunks(), "chunks")
    asks = saved(corpus.asks(anchors), "anchors")
    n = asks.count()
    best = best_of(corpus, chunks, asks, n, positives, same_label=True, tile_rows=tile_rows)
    windows = best.select("query_id", "score", (-_hundredth(-least * F.col("score"))).alias("low"), _hundredth(most * F.col("score")).alias("high"))
    pairs, mined = _keys(best), None
    for phase in corpus.phases():
        bounded = windows.where("low <= high").groupBy("query_id").agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
        found = corpus.meet(chunks, asks.join(bounded, "query_id"), phase, n, lambda b, r, q: _windows(b, r, q, negatives), PAIRS, tile_rows)
        pairs = pairs.union(saved(found, "pairs"))
        mined = saved(sweep(pairs, positives, negatives, least, most), "mined")
        full = mined.where(F.col("rank") == negatives).groupBy(F.col("anchor_id").alias("query_id"), F.col("positive_score").alias("score")).agg(F.max("negative_score").alias("reach"))
        windows = windows.join(full, ["query_id", "score"], "left").select("query_id", "score", F.greatest("low", F.coalesce("reach", "low")).alias("low"), "high")
    return mined
