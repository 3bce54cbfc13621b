"""Operator 13: spelling variants by Bloom-guided neighbourhoods.

The vocabulary (words with their counts) is put into blocked Bloom filters, one for each word length, which
are built on the executors and broadcast. Their total size is bounded by `filter_bytes`: a larger
vocabulary is dealt to several passes by hash, each with filters of its own, so that every edit
is probed in exactly one pass. Every word generates its edits as hashes: all deletions of one code point and
all replacements by a larger one, out of the letters that occur. Two words at distance one are met so exactly
once, from one side. Edits that a filter may hold (few others pass) are shuffled to an exact join with the
vocabulary; pairs are then compared as strings, so neither a filter's errors nor equal hashes leave a trace.

Each word learns how many near words it has, and its form: the near word of largest n (ties: the
smallest in code-point order), if that n is `ratio` times its own at least. Counts grow along forms, so
chains are short; roots are found by doubling.

`word_counts`: maximal runs of letters of whole texts, A-Z in lower case; texts that are null have none.
Where `typo_every` divides the crc32 of `<doc_id>:<run>` (a null doc_id is an empty string), the run loses
its code point at crc32 modulo its length. Repeated rows count each; a hot word is added up in tasks
before it is shuffled. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import id_text, saved, spread
from tickloom.llm.hashing import mix

#: Fixed value: letters of a run.
LETTERS = "A-Za-zÀ-ÿ"
LONG_TEXT = 1 << 20
#: Lengths from here on share a filter.
LONGEST = 64
BITS = 16  # of a filter, for each word
LANES = 8  # 64-bit lanes of a block, one bit of a word in each
SEGMENT = 2048  # blocks that are built together
PROBES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))
_SALT = np.random.default_rng(13).integers(1, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[str, np.ndarray] = {}


def word_counts(docs: DataFrame, *, least_chars: int = 5, typo_every: int | None = None, most: int = 200_000) -> DataFrame:
    """(word, n): words of least_chars code points and more, and how often they occur."""
    run_ = re.compile(f"[{LETTERS}]{{{least_chars},}}")  # a word made of a shorter run would be too short as well

    def words(text: str, data: bytes) -> Counter:
        if len(data) > LONG_TEXT:
            return Counter(m.group() for m in run_.finditer(text))
        return Counter(run_.findall(text))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                if not text.is_valid:
                    continue
                data = text.as_py().encode().lower()  # of bytes: A-Z only
                start = zlib.crc32(f"{i.as_py() if i.is_valid else ''}:".encode())
                for word, n in words(data.decode(), data).items():
                    if typo_every:
                        h = zlib.crc32(word.encode(), start)
                        if not h % typo_every:
                            k = h % len(word)
                            word = word[:k] + word[k + 1 :]
                            if len(word) < least_chars:
                                continue
                    held[word] = held.get(word, 0) + n
                if len(held) > most:
                    yield out()
                    held.clear()
        yield out()

    return id_text(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_POWERS.get(kind, ())) < n:
        steps = np.full(max(n, 1 << 12), np.uint64(_BASE) if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _POWERS[kind] = np.multiply.accumulate(steps)
    return _POWERS[kind][:n]


class Words:
    """Words as code points one after the other, with the hashes of them and of their edits."""

    def __init__(self, words: list[str]):
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.word = np.repeat(np.arange(len(words)), self.sizes)
        self.place = np.arange(len(self.codes)) - self.first[self.word]
        top = int(self.sizes.max(initial=0)) + 1
        self.up = _power("up", top)[self.place]
        with np.errstate(over="ignore"):
            self.value = mix(self.codes + np.uint64(1))
            sums = np.zeros(len(self.codes) + 1, np.uint64)
            np.cumsum(self.value * self.up, out=sums[1:])
        self.sums = sums
        self.total = sums[self.first + self.sizes] - sums[self.first]

    @staticmethod
    def close(raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(raw + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def keys(self) -> np.ndarray:
        return self.close(self.total, self.sizes)

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """Word and hash of every word with one code point less; of equal neighbours the last is taken."""
        last = np.ones(len(self.codes), bool)
        last[:-1] = (self.codes[1:] != self.codes[:-1]) | (self.word[1:] != self.word[:-1])
        at = np.flatnonzero(last)
        word = self.word[at]
        with np.errstate(over="ignore"):
            head = self.sums[at] - self.sums[self.first[word]]
            tail = self.sums[self.first[word] + self.sizes[word]] - self.sums[at + 1]
            return word, self.close(head + tail * _INVERSE, self.sizes[word] - 1)

    def replacements(self, letters: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word and hash of every word with one code point replaced by a larger letter."""
        values = mix(letters + np.uint64(1))
        step = max(1, PROBES // max(1, len(letters)))
        for a in range(0, len(self.codes), step):
            own = slice(a, a + step)
            with np.errstate(over="ignore"):
                raw = self.total[self.word[own]][:, None] + (values[None, :] - self.value[own][:, None]) * self.up[own][:, None]
            larger = letters[None, :] > self.codes[own][:, None]
            word = np.broadcast_to(self.word[own][:, None], larger.shape)[larger]
            yield word, self.close(raw[larger], self.sizes[word])


def _bits(keys: np.ndarray) -> Iterator[np.ndarray]:
    """In each lane of a key's block, the bit that the key sets."""
    for salt in _SALT:
        with np.errstate(over="ignore"):
            yield (keys * salt) >> np.uint64(58)


class Filters:
    """Blocked Bloom filters of all lengths in one array; a filter has so many blocks."""

    def __init__(self, blocks: np.ndarray, lanes: np.ndarray | None = None):
        self.blocks, self.base, self.lanes = blocks.astype(np.uint64), (np.cumsum(blocks) - blocks).astype(np.uint64), lanes

    def block(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        shard = np.minimum(sizes, LONGEST)
        return self.base[shard] + (((keys >> np.uint64(32)) * self.blocks[shard]) >> np.uint64(32))

    def holds(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Indices of keys that may be in the filter of their length."""
        alive = np.flatnonzero(self.blocks[np.minimum(sizes, LONGEST)] > 0)
        at = self.block(keys[alive], sizes[alive]) * np.uint64(LANES)
        for lane, salt in enumerate(_SALT):
            with np.errstate(over="ignore"):
                bit = (keys[alive] * salt) >> np.uint64(58)
            kept = (self.lanes[at + np.uint64(lane)] >> bit) & np.uint64(1) > 0
            alive, at = alive[kept], at[kept]
        return alive


def _turn(keys: np.ndarray, passes: int) -> np.ndarray:
    """The pass that a key belongs to."""
    with np.errstate(over="ignore"):
        return mix(keys + np.uint64(1)) % np.uint64(passes)


def keyed(words: DataFrame) -> DataFrame:
    """(word, n, size, key) of words and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Words(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(w.sizes), pa.array(w.keys().view(np.int64))], ["word", "n", "size", "key"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, size long, key long")


def build(vocabulary: DataFrame, turn: int, passes: int) -> Filters:
    """Filters of the words of one pass. Their blocks are built in segments by the executors."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = np.array(batch.column("key")).view(np.uint64), np.array(batch.column("size"))
            mine = _turn(keys, passes) == turn
            yield pa.RecordBatch.from_arrays([pa.array(keys[mine].view(np.int64)), pa.array(sizes[mine])], ["key", "size"])

    words = vocabulary.select("key", "size").mapInArrow(own, "key long, size long")
    counts = np.zeros(LONGEST + 1, np.int64)
    for r in words.groupBy(F.least(F.col("size"), F.lit(LONGEST)).alias("size")).count().collect():  # LONGEST rows at most
        counts[r["size"]] = r["count"]
    filters = Filters(-(-counts * BITS // (64 * LANES)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column("key")).view(np.uint64)
            block = filters.block(keys, np.array(batch.column("size"))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((block // SEGMENT).astype(np.int32)), pa.array((block % SEGMENT).astype(np.int32)), pa.array(keys.view(np.int64))], ["segment", "block", "key"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lanes = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([lanes.tobytes()], pa.binary())], ["segment", "lanes"])

        for batch in batches:
            segment, block, keys = (np.array(batch.column(c)) for c in ("segment", "block", "key"))
            for rows in np.split(np.arange(len(segment)), np.flatnonzero(np.diff(segment)) + 1):
                if not len(rows):
                    continue
                if segment[rows[0]] != now:
                    if now is not None:
                        yield out()
                    now, lanes = int(segment[rows[0]]), np.zeros(SEGMENT * LANES, np.uint64)
                for lane, bit in enumerate(_bits(keys[rows].view(np.uint64))):
                    np.bitwise_or.at(lanes, block[rows].astype(np.int64) * LANES + lane, np.uint64(1) << bit)
        if now is not None:
            yield out()

    placed = words.mapInArrow(place, "segment int, block int, key long").repartition("segment").sortWithinPartitions("segment")
    total = int(filters.blocks.sum())
    flat = np.zeros(-(-total // SEGMENT) * SEGMENT * LANES, np.uint64)
    for r in placed.mapInArrow(fill, "segment int, lanes binary").toLocalIterator():  # filter_bytes in all
        flat[r.segment * SEGMENT * LANES : (r.segment + 1) * SEGMENT * LANES] = np.frombuffer(r.lanes, np.uint64)
    filters.lanes = flat[: total * LANES]
    return filters


def _found(vocabulary: DataFrame, filters: Filters, turn: int, passes: int, letters: np.ndarray) -> DataFrame:
    """(edit, own): keys of edits that the filters of this pass may hold, and of the words they come from."""
    sent = vocabulary.sparkSession.sparkContext.broadcast((filters.blocks, filters.lanes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, lanes = sent.value
        known = Filters(blocks, lanes)
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                w = Words(batch.column("word").slice(a, 4096).to_pylist())
                own = w.keys()
                for word, keys, less in chain([(*w.deletions(), 1)], ((x, k, 0) for x, k in w.replacements(letters))):
                    if passes > 1:
                        mine = _turn(keys, passes) == turn
                        word, keys = word[mine], keys[mine]
                    some = known.holds(keys, w.sizes[word] - less)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(own[word[some]].view(np.int64))], ["edit", "own"])

    return vocabulary.select("word").mapInArrow(run, "edit long, own long")


def near_pairs(vocabulary: DataFrame, *, filter_bytes: int = 1 << 26) -> DataFrame:
    """(a, a_n, b, b_n) of all pairs of words at distance one, each once. vocabulary: as `keyed` gives it."""
    n = vocabulary.count()
    passes = max(1, -(-n * BITS // 8 // filter_bytes))
    letters = np.array(sorted(ord(r.c) for r in vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect() if r.c), np.uint64)  # of an alphabet
    found = None
    for turn in range(passes):
        own = saved(_found(vocabulary, build(vocabulary, turn, passes), turn, passes, letters), "edits")
        found = own if found is None else found.union(own)
    b = vocabulary.select(F.col("key").alias("edit"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    a = vocabulary.select(F.col("key").alias("own"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    return found.join(b, "edit").join(a, "own").where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, twice as far each round."""
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = saved(now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = now.where("moved").limit(1).count()
        now = now.drop("moved")
        if not moved:
            return now


def variants(words: DataFrame, *, ratio: int = 2, filter_bytes: int = 1 << 26) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of (word, n); words are distinct and not null."""
    vocabulary = saved(keyed(words), "vocabulary")
    pairs = near_pairs(vocabulary, filter_bytes=filter_bytes)
    both = pairs.union(pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("form")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    good = -F.col("best.n") >= ratio * F.col("n")
    formed = saved(vocabulary.select("word", "n").join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(good, F.col("best.form")).alias("form"), F.when(good, -F.col("best.n")).alias("form_n"),
    ), "forms")
    last = roots(formed.where("form is not null"))
    return formed.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def group_spellings(docs: DataFrame, *, least_chars: int = 5, least_count: int = 3, ratio: int = 2, typo_every: int | None = None, filter_bytes: int = 1 << 26) -> DataFrame:
    """`variants` of the words of whole texts that occur least_count times and more."""
    words = word_counts(docs, least_chars=least_chars, typo_every=typo_every).where(F.col("n") >= least_count)
    return variants(words, ratio=ratio, filter_bytes=filter_bytes)
