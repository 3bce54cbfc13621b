"""Operator 4: histogram sort into shards of nearly equal bytes, DataFrame functions only.

Documents are ordered by (xxhash64 of the text, doc_id): equal texts stand together, and a group of
copies too large for one shard can still be cut between its documents. Splitters are found by
counting: bytes and rows below all probes of a round are counted exactly over all partitions, every
splitter that is not yet within its tolerance gets 256 finer probes inside its interval, and so on.
Then one exchange moves each document, whole rows with all columns, to its part, where they are
sorted; parts are fine pieces of shards, so no task holds a shard. A shard's slots follow the order of
the keys. `place` writes the sharded documents and takes its measures from what it has written.

Null texts have size 1 and the checksum of no bytes. Null doc_ids count as the smallest long. Rows
equal in both doc_id and text cannot be told apart by any key and stay in one part. An empty table
gives no rows. Other columns are kept by `shard` (but for any named shard or slot, which are replaced).
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import id_text, saved

MIN_LONG = -(2**63)
LEVELS = 16  # bytes of the 128-bit key


def _digit(level: int) -> Column:
    word = F.col("hi" if level < 8 else "lo").bitwiseXOR(F.lit(MIN_LONG).cast("long"))
    return F.shiftrightunsigned(word, 56 - 8 * (level % 8)).bitwiseAND(F.lit(255))


def _prefix(level: int) -> list[Column]:
    """Upper `level` bytes of the key as two longs."""
    def upper(name: str, n: int) -> Column:
        word = F.col(name).bitwiseXOR(F.lit(MIN_LONG).cast("long"))
        return F.lit(0).cast("long") if n <= 0 else F.shiftrightunsigned(word, 64 - 8 * min(n, 8))

    return [upper("hi", level).alias("p_hi"), upper("lo", level - 8).alias("p_lo")]


def splitters(keys: DataFrame, targets: list[int], tolerances: list[float]) -> list[tuple[int, int, int]]:
    """(key, bytes below, rows below) near each number of bytes; a key is an unsigned 128-bit number.

    keys: hi, lo, size. Every round collects at most 256 counts per open splitter.
    """
    found = {}
    state = {i: (0, 0, 0) for i in range(len(targets))}  # known upper bytes, bytes and rows below them
    for level in range(LEVELS):
        if not state:
            break
        near = keys.select("*", *_prefix(level))
        if level:  # a list of at most one prefix per splitter
            signed, shift = lambda x: x - 2**64 if x >= 2**63 else x, 8 * max(0, level - 8)
            uppers, lowers = {signed(p >> shift) for p, _, _ in state.values()}, {signed(p & (2**shift - 1)) for p, _, _ in state.values()}
            near = near.where(F.col("p_hi").isin(*uppers) & F.col("p_lo").isin(*lowers))
        counted = near.groupBy("p_hi", "p_lo", _digit(level).alias("digit")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min(F.struct("hi", "lo")).alias("first"), (F.min(F.struct("hi", "lo")) == F.max(F.struct("hi", "lo"))).alias("one"),
        ).collect()
        buckets = defaultdict(list)
        for r in counted:
            p = (r.p_hi % 2**64 << 8 * max(0, level - 8)) | r.p_lo
            only = ((r.first.hi - MIN_LONG) << 64 | (r.first.lo - MIN_LONG)) if r.one else None  # the bucket's single key
            buckets[p].append((r.digit, r.bytes, r.rows, only))
        for i, (p, size, count) in list(state.items()):
            for digit, more, n, only in sorted(buckets[p], key=lambda x: x[0]):
                if size + more < targets[i]:
                    size, count = size + more, count + n
                    continue
                key, rest = p << 8 | digit, 8 * (LEVELS - 1 - level)
                low, high = targets[i] - size, size + more - targets[i]
                if only is None and min(low, high) > tolerances[i]:
                    state[i] = (key, size, count)
                elif low <= high:
                    found[i] = (key << rest, size, count)
                else:
                    found[i] = ((key + 1) << rest, size + more, count + n)
                break
            if i in found:
                del state[i]
    return [found[i] for i in range(len(targets))]


def _below(key: int) -> Column:
    """Whether a row's key is less than this one."""
    hi, lo = (key >> 64) + MIN_LONG, (key & (2**64 - 1)) + MIN_LONG
    if hi >= 2**63:
        return F.lit(True)
    h, l = F.lit(hi).cast("long"), F.lit(lo).cast("long")
    return (F.col("hi") < h) | ((F.col("hi") == h) & (F.col("lo") < l))


def _part(cuts: list[int], a: int, b: int) -> Column:
    """Number of cuts at or below a row's key, as a balanced tree of comparisons."""
    if a == b:
        return F.lit(a)
    m = (a + b) // 2
    return F.when(_below(cuts[m]), _part(cuts, a, m)).otherwise(_part(cuts, m + 1, b))


def shard(docs: DataFrame, *, shards: int = 16, parts: int = 8, tolerance: float = 0.005) -> DataFrame:
    """All rows of docs, moved to their shards and sorted, with `shard` and `slot`.

    tolerance: largest distance of a shard's border from its ideal place, as a share of a shard.
    parts: pieces of a shard that are sorted apart from one another.
    """
    text = F.coalesce("text", F.lit(""))
    keys = saved(id_text(docs).select(
        (F.octet_length(text) + 1).cast("long").alias("size"), F.xxhash64(text).alias("hi"), F.coalesce("doc_id", F.lit(MIN_LONG).cast("long")).alias("lo"),
    ), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    n = shards * parts
    wide = total / shards
    found = splitters(keys, [max(1, round(i * total / n)) for i in range(1, n)], [wide * (tolerance if i % parts == 0 else 0.1 / parts) for i in range(1, n)]) if total else [(0, 0, 0)] * (n - 1)
    cuts = [key for key, _, _ in found]
    starts = [0] + [rows for _, _, rows in found]
    before = F.array(*[F.lit(starts[i] - starts[i - i % parts]).cast("long") for i in range(n)])
    order = Window.partitionBy("part").orderBy("hi", "lo")
    names = [f"c{i}" for i in range(len(docs.columns))]  # no clash with columns added here
    own = {c: F.col(n) for n, c in zip(names, docs.columns, strict=True)}
    text = F.coalesce(own["text"].cast("string"), F.lit(""))
    keyed = docs.toDF(*names).select(*names, F.xxhash64(text).alias("hi"), F.coalesce(own["doc_id"].cast("long"), F.lit(MIN_LONG).cast("long")).alias("lo"))
    placed = keyed.withColumn("part", _part(cuts, 0, n - 1))
    return placed.select(
        *[x.alias(c) for c, x in own.items() if c not in ("shard", "slot")], F.floor(F.col("part") / parts).cast("int").alias("shard"),
        (F.row_number().over(order) - 1 + before[F.col("part")]).cast("long").alias("slot"),
    )


def place(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, from the rows that `shard` (same options) has moved."""
    rows = saved(shard(docs, **options), "shards")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
