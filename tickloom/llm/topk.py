"""Operator 11: exact top-k search by columnar branch-and-bound.

Vectors lie in blocks by dimension (see `vectors`), the dimensions of most mass first. A query adds up its
inner products over one group of dimensions at a time. What the remaining dimensions can still add is
at most the product of the remaining norms of query and vector; candidates whose sum and remaining mass
do not reach the query's bound go, and the rest is compacted before the next group. The bound is the
k-th best score known: of earlier phases, or of the few candidates of largest partial sum, which are
scored in full first. So scores are exact and no candidate is lost.

Scores are inner products of integers floor(scale * x). Ties go to the smaller vec_id. Rows with a query's
own vec_id are no candidates. An id that occurs several times among the queries is searched once, with the least of
its vectors; candidates count once for each row. For rows that take no part see `vectors`. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import saved
from tickloom.llm.vectors import CHUNK_ROWS, Block, Corpus

FOUND = "query_id long, vec_id long, score long"
AT_ONCE = 32
GROUP = 16  # dimensions that are added between two looks at the bound


class Vertical:
    """A block in the order its dimensions are taken, with the norms of what remains after each group."""

    def __init__(self, block: Block):
        squares = np.square(block.cells.astype(np.float64))
        self.order = np.argsort(-squares.sum(1), kind="stable")
        self.ids, self.labels, self.cells = block.ids, block.labels, block.cells[self.order]
        self.cuts = [*range(0, block.dim, GROUP), block.dim]
        rest = squares[self.order]
        self.rest = [np.sqrt(rest[c:].sum(0)) for c in self.cuts[1:]]  # after each group


def _kth(scores: np.ndarray, k: int):
    return np.partition(scores, len(scores) - k)[len(scores) - k]


def search_block(block: Vertical, q: np.ndarray, names: np.ndarray, bounds: list, k: int, excluded=None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, places in the block, scores) of each query's k best in the block that reach its bound.

    excluded(i) marks rows of the block that are no candidates of query i, besides those of its own id.
    """
    q = q[:, block.order]
    squares = np.square(q.astype(np.float64))
    first = block.cuts[1] if len(block.cuts) > 1 else 0
    sums = q[:, :first] @ block.cells[:first]
    for i in range(len(q)):
        out = block.ids == names[i]
        if excluded is not None:
            out |= excluded(i)
        alive = np.flatnonzero(~out)
        score, bound = sums[i][alive], bounds[i]
        if len(alive) > 4 * k:
            few = alive[np.argpartition(score, len(score) - 4 * k)[-4 * k :]]
            known = _kth(q[i] @ block.cells[:, few], k)
            bound = known if bound is None else max(bound, known)
        for g, end in enumerate(block.cuts[1:]):
            if g:
                begin = block.cuts[g]
                score = score + q[i, begin:end] @ block.cells[begin:end, alive]
            if bound is not None:
                mass = np.sqrt(squares[i, end:].sum()) * block.rest[g][alive]
                keep = score + (mass * (1 + 1e-9) + np.abs(score) * 1e-12 + 0.5) >= bound
                alive, score = alive[keep], score[keep]
        if bound is not None:  # all dimensions are in: the sums are the scores
            keep = score >= bound
            alive, score = alive[keep], score[keep]
        best = np.lexsort((block.ids[alive], -score))[:k]
        yield i, alive[best], score[best]


def top(found: DataFrame, k: int) -> DataFrame:
    """rank of the k best of each query."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def kernel_of(k: int, same_label: bool = False):
    """Kernel for `Corpus.meet`: low is empty, or holds the bound of the query."""
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    last: list = [None, None]

    def kernel(block: Block, rows: pa.RecordBatch, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        if last[0] is not block:
            last[:] = block, Vertical(block)
        names, labels = np.array(rows.column("query_id")), np.array(rows.column("label"))
        bounds = [x[0] if x else None for x in rows.column("low").to_pylist()]
        for a in range(0, len(names), AT_ONCE):
            own = slice(a, a + AT_ONCE)
            other = (lambda i, a=a: block.labels != labels[a + i]) if same_label else None
            found = list(search_block(last[1], q[own], names[own], bounds[own], k, other))
            cells = [np.repeat([names[a + i] for i, _, _ in found], [len(x) for _, x, _ in found]), block.ids[np.concatenate([x for _, x, _ in found])], np.concatenate([s for _, _, s in found])]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in cells], schema=out)

    return kernel


def best_of(corpus: Corpus, chunks: DataFrame, asks: DataFrame, n_asks: int, k: int, same_label: bool = False, tile_rows: int = 1 << 16) -> DataFrame:
    """query_id, vec_id, score, rank of the k best of every ask: all blocks, phase by phase."""
    found = None
    none = F.array().cast("array<long>")
    for phase in corpus.phases():
        if found is None:
            bounded = asks.withColumn("low", none)
        else:
            reach = found.where(F.col("rank") == k).select("query_id", F.array("score").alias("reach"))
            bounded = asks.join(reach, "query_id", "left").withColumn("low", F.coalesce("reach", none)).drop("reach")
        more = corpus.meet(chunks, bounded.withColumn("high", none), phase, n_asks, kernel_of(k, same_label), FOUND, tile_rows)
        found = saved(top(more if found is None else more.union(found.drop("rank")), k), "best")
    return found


def search(vectors: DataFrame, queries: Column, *, k: int = 5, scale: float = 256.0, block_bytes: int = 1 << 25, chunk_rows: int = CHUNK_ROWS, tile_rows: int = 1 << 16) -> DataFrame:
    """The k other rows of largest integer inner product of each query row: query_id, rank, vec_id, score."""
    corpus = Corpus.of(vectors, scale, block_bytes=block_bytes, chunk_rows=chunk_rows)
    asks = saved(corpus.asks(F.col("vec_id").isNotNull() & queries), "queries")
    found = best_of(corpus, saved(corpus.chunks(), "chunks"), asks, asks.count(), k, tile_rows=tile_rows)
    return found.select("query_id", "rank", "vec_id", "score")
