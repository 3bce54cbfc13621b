"""Operator 5: toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct words, neighbouring pairs and pairs with one word between of a text, in
lower case, hashed into two tables. Only a bounded sample of labelled rows is fitted (`sample_rows`,
lowest hashes of doc_id first): dealt to `shards` tasks, each runs FTRL-proximal with rates per
coordinate and L1, and the weights are averaged. L1 grows with the number of epochs, so that pairs seen
once are not learnt by heart; it leaves few weights, and a bounded, sparse table goes to the tasks that
score every whole text.

Labels are used only in fitting and only from rows whose crc32(doc_id) mod 4 is not the held-out
remainder. Null, empty or wordless texts get the score of the bias alone. Without any usable label
every score is 0. Repeated rows are scored alike; a doc_id with several label rows counts as toxic
if one of them does. Labels of null doc_ids or null marks are ignored. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import hashing
from tickloom.llm.common import batch_of, id_text, sliced

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])
BITS = 20
#: White space and ASCII punctuation become blanks; the rest are words, in lower case.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
for _a, _b in ((0, 48), (58, 65), (91, 97), (123, 128)):
    _PLAIN[_a:_b] = 32


def features(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, ascending, and the texts' offsets in them."""
    plain = _PLAIN[buf]
    starts, ends, first = hashing.word_spans(plain, at)
    words = hashing.span_hashes(plain, starts, ends)
    owner = np.repeat(np.arange(len(at) - 1), np.diff(first))
    table = np.uint64(2**BITS - 1)
    parts, owners = [words & table], [owner]
    with np.errstate(over="ignore"):
        for gap in (1, 2):
            pair = hashing.mix(words[:-gap] * np.uint64(2 * gap + 1) + words[gap:] * np.uint64(0xD6E8FEB86659FD93))
            inside = owner[gap:] == owner[:-gap]
            parts.append((pair[inside] & table) + np.uint64(2**BITS))
            owners.append(owner[gap:][inside])
    key = np.unique(np.concatenate(owners).astype(np.int64) << (BITS + 1) | np.concatenate(parts).astype(np.int64))
    return key & (2 ** (BITS + 1) - 1), np.searchsorted(key, np.arange(len(at), dtype=np.int64) << (BITS + 1))


class Ftrl:
    """FTRL-proximal over binary features; the last coordinate is the bias, which L1 spares."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0
        bias = np.equal(at, len(self.z) - 1)
        w[bias] = (-z / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))[bias]
        return w

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / self.alpha * w
        self.n[at] = more


def held_out(doc_id: Column, remainder: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == remainder, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, remainder: int = 2, sample_rows: int = 20_000, shards: int = 1, epochs: int = 6, alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and their weights (the bias is the last coordinate)."""
    size = 2 ** (BITS + 1)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    marks = marks.where(~held_out(F.col("doc_id"), remainder)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = id_text(docs).join(F.broadcast(sample), "doc_id").select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"), "doc_id", "text", "toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for part, buf, at in sliced(batches):
            ids, offsets = features(buf, at)
            ids = ids.astype(np.int32)
            for i, (shard, y) in enumerate(zip(part.column("shard").to_pylist(), part.column("toxic").to_pylist(), strict=True)):
                seen.setdefault(shard, []).append((np.append(ids[offsets[i] : offsets[i + 1]], size), y))
        for shard, examples in sorted(seen.items()):
            model, random = Ftrl(size, alpha, beta, l1, l2), np.random.default_rng(shard)
            for _ in range(epochs):
                for i in random.permutation(len(examples)):
                    model.learn(*examples[i])
            w = model.weights(np.arange(size + 1))
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w[at])], ["coordinate", "weight"])

    placed = rows.repartition("shard").sortWithinPartitions("shard", "doc_id", F.xxhash64("text"))
    learnt = placed.mapInArrow(run, "coordinate long, weight double").groupBy("coordinate").agg(F.sum("weight").alias("weight"))
    got = learnt.toPandas()  # a row per hashed coordinate at most
    if not len(got):
        return np.zeros(0, np.int64), np.zeros(0)
    return got["coordinate"].to_numpy(), got["weight"].to_numpy() / shards


def score(docs: DataFrame, coordinates: np.ndarray, weights: np.ndarray, *, threshold: float = 0.3, remainder: int = 2) -> DataFrame:
    """Scores of all documents from sparse weights."""
    shared = docs.sparkSession.sparkContext.broadcast((coordinates, weights.astype(np.float32)))  # 2**21 pairs at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(2 ** (BITS + 1) + 1)
        at_, w = shared.value
        dense[at_] = w
        for rows, buf, at in sliced(batches):
            ids, offsets = features(buf, at)
            sums = np.concatenate([[0.0], np.cumsum(dense[ids])])
            p = 1 / (1 + np.exp(-np.clip(sums[offsets[1:]] - sums[offsets[:-1]] + dense[-1], -35, 35))) if len(at_) else np.zeros(rows.num_rows)
            yield batch_of(ARROW, rows.column("doc_id"), rows.column("held_out"), p, (p >= threshold).astype(np.int32))

    return id_text(docs).withColumn("held_out", held_out(F.col("doc_id"), remainder)).mapInArrow(run, SCHEMA)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labelled rows and score every document."""
    return score(docs, *fit(docs, labels, **options))
