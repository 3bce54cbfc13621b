"""Operator 1: near-duplicate documents by a multi-index Hamming join of MinHash signatures.

1. A text's set holds its distinct 4-word shingles. Its signature is `chunks * width` MinHash values of
   16 bits. Texts with equal sets are one node from here on.
2. Signatures are cut into chunks. By the pigeonhole principle, two signatures that differ in fewer
   than 2 * chunks values have a chunk with one error at most, so every node is filed under each chunk
   with each one of its values left out, and all such pairs meet. (Two texts at similarity 0.8 miss
   each other in all chunks with probability 3.4e-7 under 14 chunks of 6.)
3. Each member of a bucket is first checked against the bucket's least node only: a link needs the full
   sets. Components of these links settle nearly all buckets.
4. Buckets that still hold several components are compared inside, in tiles, by full sets: a tile counts
   all its intersections at once and sends at most one row per member. So groups of copies never
   become pairs, and no link between different texts is given up.

Null texts, texts without words and rows with null doc_id link with nothing. Rows with equal doc_id
count as one document for linking. Repeated rows get equal results. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import hashing
from tickloom.llm.common import id_text, saved, sliced
from tickloom.llm.components import components

CHUNKS, WIDTH = 14, 6
#: Signatures of pairs at the threshold lie within 5 standard deviations of this screen.
SIGMAS = 5.0
TILE = 1024
#: Shingles in more sets of a tile than this are counted by matrix products.
RARE = 6
_RANDOM = np.random.default_rng(4242)
_MUL = _RANDOM.integers(1, 2**63, 512, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RANDOM.integers(0, 2**63, 512, dtype=np.uint64)


def shingle_sets(buf: np.ndarray, at: np.ndarray, words: int) -> list[np.ndarray]:
    """Each text's distinct shingles as ascending 64-bit hashes; A-Z count as a-z."""
    starts, ends, first = hashing.word_spans(buf, at)
    hashes, where = hashing.windows(hashing.span_hashes(buf, starts, ends, lower=True), first, words)
    return [np.unique(hashes[where[i] : where[i + 1]]) for i in range(len(where) - 1)]


def signature(hashes: np.ndarray, size: int) -> np.ndarray:
    """MinHash values, 16 bits each."""
    least = np.full(size, 2**64 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 2048):
            np.minimum(least, (_MUL[:size, None] * hashes[None, i : i + 2048] + _ADD[:size, None]).min(1), out=least)
    return (hashing.mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def index_keys(signatures: np.ndarray, chunks: int, width: int) -> np.ndarray:
    """Keys of each signature (rows): every chunk with every one of its values left out."""
    parts = signatures.reshape(len(signatures), chunks, width).astype(np.uint64)
    out = np.empty((len(signatures), chunks, width), np.uint64)
    with np.errstate(over="ignore"):
        for gone in range(width):
            key = np.broadcast_to(np.arange(chunks, dtype=np.uint64) * np.uint64(width) + np.uint64(gone + 1), parts.shape[:2])
            for k in range(width):
                if k != gone:
                    key = hashing.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
            out[:, :, gone] = key
    return out.reshape(len(signatures), -1).view(np.int64)


def sketch(docs: DataFrame, words: int, size: int) -> DataFrame:
    """doc_id, n_shingles, set_id (of the whole set), signature (null without words)."""
    out = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("signature", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            sets = shingle_sets(buf, at, words)
            ids = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
            signs = [signature(x, size).tobytes() if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(ids, pa.binary()), pa.array(signs, pa.binary())], schema=out)

    return id_text(docs).mapInArrow(run, "doc_id long, n_shingles long, set_id binary, signature binary")


def _filed(nodes: DataFrame, chunks: int, width: int) -> DataFrame:
    """(key, node) for all keys of all nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                signs = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(part.num_rows, -1)
                keys = index_keys(signs, chunks, width)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(np.array(part.column("node")), keys.shape[1]))], ["key", "node"])

    return nodes.select("node", "signature").mapInArrow(run, "key long, node long")


def _sharing(keys: DataFrame) -> DataFrame:
    """(key, node) of keys that several nodes have. Buckets stream by; none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, matched = None, False
        for batch in batches:
            rows = np.stack([np.array(batch.column("key")), np.array(batch.column("node"))])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            rows = rows[:, np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])]
            again = rows[0, 1:] == rows[0, :-1]
            keep = np.concatenate([[matched], again]) | np.concatenate([again, [False]])
            held, matched = rows[:, -1:], bool(keep[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep[:-1]]) for x in rows], ["key", "node"])
        if held is not None and matched:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["key", "node"])

    return keys.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "key long, node long")


def screen(pairs: DataFrame, signatures: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) whose signatures differ in `most` values at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("sa", "sb"))
            yield batch.select(["a", "b"]).filter(pa.array((x != y).sum(1) <= most))

    sides = [signatures.select(F.col("node").alias(n), F.col("signature").alias(f"s{n}")) for n in "ab"]
    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long").distinct()


def confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int, per_task: int = 1000) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough. A text a with many partners b is dealt to several tasks."""
    fan = pairs.groupBy("a").agg(F.ceil(F.count("*") / per_task).cast("int").alias("fan"))
    deal = lambda by: F.pmod(F.xxhash64(by), F.col("fan")).cast("int").alias("salt")
    leads = fan.join(texts.withColumnRenamed("node", "a"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "text")
    rest = pairs.join(fan, "a").select("a", deal("b"), "b").join(texts.withColumnRenamed("node", "b"), "b").select("a", "salt", "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand, sets = None, []
        for batch in batches:
            for rows, buf, at in sliced([batch]):
                found: list[tuple[int, int]] = []
                for a, salt, b, own in zip(*(rows.column(c).to_pylist() for c in ("a", "salt", "b")), shingle_sets(buf, at, words), strict=True):
                    if (a, salt) != at_hand:
                        at_hand, sets = (a, salt), []
                    if b is None:
                        sets.append(own)
                        continue
                    for lead in sets:
                        both = len(np.intersect1d(lead, own, assume_unique=True))
                        if 100 * both >= percent * (len(lead) + len(own) - both):
                            found.append((a, b))
                            break
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["u", "v"])

    return leads.union(rest).repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first()).mapInArrow(run, "u long, v long")


def shared_sizes(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets with each other (a tile's worth of them)."""
    m = len(sets)
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), [len(x) for x in sets])
    shared = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    begin = np.cumsum(count) - count
    for size in range(2, RARE + 1):  # values in a few sets: their pairs
        own = row[order[begin[count == size][:, None] + np.arange(size)[None, :]]]
        for i in range(size):
            for j in range(i):
                np.add.at(shared, (own[:, j], own[:, i]), 1)
    often = np.flatnonzero(count > RARE)
    place = np.full(len(values), -1)
    for i in range(0, len(often), 4096):  # the rest: products of 0/1 matrices
        part = often[i : i + 4096]
        place[part] = np.arange(len(part))
        own = place[column] >= 0
        table = np.zeros((m, len(part)), np.float32)
        table[row[own], place[column[own]]] = 1
        place[part] = -1
        shared += table @ table.T
    return np.maximum(shared, shared.T)


def _inside(keys: DataFrame, buckets: DataFrame, texts: DataFrame, labels: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (u, v) between different components inside buckets that hold several, from full sets.

    A large bucket is compared tile by tile. A task sends no pairs: only, for each member that is linked
    to another component, one row that ties it to the least node it is connected with there.
    """
    member = keys.join(buckets.select("key", "n"), "key").join(labels, "node", "left").select("key", "n", "node", F.coalesce("component", "node").alias("component"))
    mixed = member.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    placed = member.join(mixed, "key").withColumn("tiles", tiles).withColumn("own", own).select("key", "node", "component", "own", spread.alias("other"))
    placed = placed.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component").join(texts, "node")

    def compare(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        node, component = (np.array(t.column(c)) for c in ("node", "component"))
        sets = [x for rows_ in t.to_batches() for part, buf, at in sliced([rows_]) for x in shingle_sets(buf, at, words)]
        size = np.array([len(x) for x in sets])
        shared = shared_sizes(sets)
        linked = (shared > 0) & (100 * shared >= percent * (size[:, None] + size[None, :] - shared)) & (component[:, None] != component[None, :])
        least = node.copy()
        while linked.any():
            new = np.minimum(least, np.where(linked, least[None, :], np.iinfo(np.int64).max).min(1))
            if (new == least).all():
                break
            least = new
        tied = least != node
        return pa.RecordBatch.from_arrays([pa.array(node[tied]), pa.array(least[tied])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            names = list(zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j")), strict=True))
            begin = 0
            for k in range(1, len(names) + 1):
                if k == len(names) or names[k] != names[begin]:
                    if names[begin] != last and held:
                        yield compare(held)
                        held = []
                    last = names[begin]
                    held.append(batch.slice(begin, k - begin))
                    begin = k
        if held:
            yield compare(held)

    return placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, *, words: int = 4, percent: int = 80, chunks: int = CHUNKS, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    size = chunks * width
    share = percent / 100
    most = int(size * (1 - share) + SIGMAS * (size * share * (1 - share)) ** 0.5) + 1
    sketches = saved(sketch(docs, words, size), "sketches")
    linked = sketches.where("doc_id is not null and set_id is not null")
    sets = saved(linked.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.first("signature").alias("signature")), "sets")
    nodes = sets.select("node", "signature")
    keys = saved(_sharing(_filed(nodes, chunks, width)), "keys")
    groups = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("hub"), F.bit_xor(F.xxhash64("node")).alias("members"))
    # buckets with the same members need one look
    buckets = saved(groups.groupBy("members", "n", "hub").agg(F.min("key").alias("key")), "buckets")
    members = saved(keys.join(buckets.select("key", "n", "hub"), "key"), "members")
    stars = screen(members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), nodes, most)
    wanted = members.select("node").distinct()
    # both sides grow with the data: never a broadcast
    texts = saved(id_text(docs).withColumnRenamed("doc_id", "node").hint("merge").join(wanted.hint("merge"), "node", "left_semi"), "texts")
    links = saved(confirm(stars, texts, words, percent), "links")
    labels = components(links)
    more = saved(_inside(members.select("key", "node"), buckets.where("n > 2"), texts, labels, words, percent), "links")
    final = components(links.union(more)) if more.count() else labels
    named = sets.select("set_id", "node").join(final, "node", "left").select("set_id", F.coalesce("component", "node").alias("component_id"))
    joined = sketches.select("doc_id", "n_shingles", "set_id").join(named, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """docs without those that are near duplicates of a document of smaller doc_id in their component."""
    gone = near_duplicates(docs, words=words, percent=percent).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
