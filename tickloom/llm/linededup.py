"""Operator 6: near-equal lines by a deletion-neighbourhood join.

Lines are compared as words (`[^\\x20\\x09-\\x0D]+`, A-Z as a-z). The edit bound grows with the line: none
below `min_chars` characters (of the words, one blank between them), one inserted, deleted or replaced
character from there on, one word from `min_words` words on. Two lines match if their words are the
same, or if both lie under the same bound and are within it. A line goes if it matches any line before
it, in order of (doc_id, hash of the text, line number); lines without a word stay. The earliest line of
a kind always stays.

1. Equal lines are reduced to one, with its earliest place.
2. One edit leaves the first or the second half of a line as it was. Lines that share no half with
   another line (for either of the two lengths a partner can have) are out.
3. The rest emit themselves and all variants with one unit (word or character) deleted, as hashed keys;
   a task reduces equal ones before they are shuffled. Equal variants meet in order of their lines'
   places: one that lacks the same unit as an earlier line, is an earlier line with a unit deleted, or
   the other way round, has edit distance 1 (equal remainders of other kinds need not and are left).
So no pairs of a group are formed: each line only learns whether an earlier one exists.

Null and empty texts have no lines. A row is told apart by its doc_id and its text: rows that share an id
(or have none) are documents of their own, rows equal in both give equal results. Null doc_ids come
first. Lines and variants are told apart by 64-bit hashes. An empty table gives no rows. Other columns
are ignored by `report` and kept by `drop_lines`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import hashing
from tickloom.llm.common import id_text, saved, sliced, spread

_BASE = 0xD6E8FEB86659FD93
_INVERSE = np.uint64(pow(_BASE, -1, 2**64))
_HALVES = 4
_power = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(kind: str, n: int) -> np.ndarray:
    if len(_power[kind]) < n:
        steps = np.full(max(n, 1 << 19), np.uint64(_BASE) if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            _power[kind] = np.multiply.accumulate(steps)
    return _power[kind][:n]


_BLANK = np.uint64(0xA0761D6478BD642F)


def _characters(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the characters of words, and how many each word has."""
    sizes = ends - starts
    at = spread(starts, sizes)
    lead = (buf[at] & 0xC0) != 0x80
    lead[np.cumsum(sizes) - sizes] = True
    begin, word = at[lead], np.repeat(np.arange(len(starts)), sizes)[lead]
    end = ends[word]
    same = word[1:] == word[:-1]
    end[:-1][same] = begin[1:][same]
    code = hashing._LOWER[buf[begin]].astype(np.uint64)
    for k in (1, 2, 3):
        more = begin + k < end
        code[more] |= buf[begin[more] + k].astype(np.uint64) << np.uint64(8 * k)
    with np.errstate(over="ignore"):
        return hashing.mix(code + _BLANK), np.bincount(word, minlength=len(starts))


class Lines:
    """Lines with a word of a slice of texts: owner, line number, and hashes of any run of their units.

    The units of a line are its words, or if these are fewer than min_words their characters, with one
    blank between words.
    """

    def __init__(self, buf: np.ndarray, at: np.ndarray, min_words: int, min_chars: int):
        breaks = np.flatnonzero(buf == 10)
        starts, ends, first = hashing.word_spans(buf, at)
        owner = np.repeat(np.arange(len(at) - 1), np.diff(first))  # of each word
        before = np.searchsorted(breaks, starts)  # breaks before each word
        lead = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(before) != 0)])) if len(starts) else np.zeros(0, np.int64)
        self.owner, self.number = owner[lead], before[lead] - np.searchsorted(breaks, at)[owner[lead]]
        n_words = np.diff(np.append(lead, len(starts)))
        self.long = n_words >= min_words
        of_long = np.repeat(self.long, n_words)
        blank = np.ones(len(starts), np.int64)  # before each word but the first of its line
        blank[lead] = 0
        chars, n_chars = _characters(buf, starts[~of_long], ends[~of_long])
        units = np.ones(len(starts), np.int64)
        units[~of_long] = n_chars + blank[~of_long]
        place = np.cumsum(units) - units
        hashes = np.full(int(units.sum()), _BLANK, np.uint64)
        hashes[place[of_long]] = hashing.span_hashes(buf, starts[of_long], ends[of_long], lower=True)
        hashes[spread((place + blank)[~of_long], n_chars)] = chars
        self.first = place[lead]
        self.size = np.diff(np.append(self.first, len(hashes)))
        self.edits = self.long | (self.size >= min_chars)
        self.kind = self.long.astype(np.int64) << 40
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(hashes * _powers("up", len(hashes)), out=self.sums[1:])
        self.down = _powers("down", len(hashes) + 1)

    def part(self, a: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Unmixed hash of the n words from word a on (of the slice)."""
        return (self.sums[a + n] - self.sums[a]) * self.down[a]

    @staticmethod
    def close(raw: np.ndarray, tag: np.ndarray) -> np.ndarray:
        return hashing.mix(raw + tag.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def ids(self) -> np.ndarray:
        with np.errstate(over="ignore"):
            return self.close(self.part(self.first, self.size), self.size + self.kind).view(np.int64)

    def halves(self) -> np.ndarray:
        """Four keys a line: first and second half of lines of its length and of lines one unit longer."""
        out = np.empty((len(self.size), _HALVES), np.uint64)
        with np.errstate(over="ignore"):
            for k in (0, 1):
                longer = self.size + k
                head = longer // 2
                tail = longer - 1 - head
                out[:, 2 * k] = self.close(self.part(self.first, head), 4 * longer + self.kind)
                out[:, 2 * k + 1] = self.close(self.part(self.first + self.size - tail, tail), 4 * longer + 1 + self.kind)
        return out.view(np.int64)

    def variants(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Line (index into some), place of the deleted unit (-1: none) and key of every variant of some lines."""
        first, size, kind = self.first[some], self.size[some], self.kind[some]
        line = np.repeat(np.arange(len(some)), size)
        word = spread(first, size)
        with np.errstate(over="ignore"):
            head = self.sums[word] - self.sums[first[line]]
            tail = self.sums[(first + size)[line]] - self.sums[word + 1]
            cut = self.close((head + tail * _INVERSE) * self.down[first[line]], size[line] - 1 + kind[line])
            whole = self.close(self.part(first, size), size + kind)
        return np.concatenate([np.arange(len(some)), line]), np.concatenate([np.full(len(some), -1), word - first[line]]), np.concatenate([whole, cut]).view(np.int64)


def _named(docs: DataFrame) -> DataFrame:
    """Texts with what tells rows apart: own (the doc_id, null before all others) and hash of the text."""
    return id_text(docs).select(F.coalesce("doc_id", F.lit(-(2**63)).cast("long")).alias("own"), F.xxhash64("text").alias("th"), "doc_id", "text")


def _scan(docs: DataFrame, min_words: int, min_chars: int) -> DataFrame:
    """(own, th, line, lid, n, halves) of all lines with a word; n: such lines in the text; no halves where no edit is allowed."""
    out = pa.schema([("own", pa.int64()), ("th", pa.int64()), ("line", pa.int64()), ("lid", pa.int64()), ("n", pa.int64()), ("halves", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            lines = Lines(buf, at, min_words, min_chars)
            owner, n = pa.array(lines.owner), np.bincount(lines.owner, minlength=rows.num_rows)[lines.owner]
            ends = np.concatenate([[0], np.cumsum(_HALVES * lines.edits)]).astype(np.int32)
            halves = pa.ListArray.from_arrays(pa.array(ends), pa.array(lines.halves()[lines.edits].ravel()))
            yield pa.RecordBatch.from_arrays([rows.column("own").take(owner), rows.column("th").take(owner), pa.array(lines.number, pa.int64()), pa.array(lines.ids()), pa.array(n, pa.int64()), halves], schema=out)

    return _named(docs).mapInArrow(run, "own long, th long, line long, lid long, n long, halves array<long>")


def _sharing(keys: DataFrame) -> DataFrame:
    """lids that share a key with another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, matched = None, False
        for batch in batches:
            rows = np.stack([np.array(batch.column("key")), np.array(batch.column("lid"))])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            again = rows[0, 1:] == rows[0, :-1]  # a lid has a key once
            keep = np.concatenate([[matched], again]) | np.concatenate([again, [False]])
            held, matched = rows[:, -1:], bool(keep[-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(rows[1, :-1][keep[:-1]]))], ["lid"])
        if held is not None and matched:
            yield pa.RecordBatch.from_arrays([pa.array(held[1])], ["lid"])

    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(run, "lid long").distinct()


def _variants(texts: DataFrame, min_words: int, min_chars: int) -> DataFrame:
    """(key, own, th, line, gone, lid, late) of the lines named in `lines` (structs of line and lid).

    late: an equal variant of an earlier line was found in the same slice; such a row ends here. Equal
    rows of a slice give their variants once.
    """
    names = ("key", "own", "th", "line", "gone", "lid")
    out = pa.schema([*((n, pa.int64()) for n in names), ("late", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            lines = Lines(buf, at, min_words, min_chars)
            lid = lines.ids()
            named = rows.column("lines")
            flat, of = named.flatten(), np.repeat(np.arange(rows.num_rows), np.diff(np.array(named.offsets)))
            wanted = set(zip(of.tolist(), flat.field("line").to_pylist(), flat.field("lid").to_pylist(), strict=True))
            some = np.array([i for i, x in enumerate(zip(lines.owner.tolist(), lines.number.tolist(), lid.tolist(), strict=True)) if x in wanted], np.int64)
            line, gone, key = lines.variants(some)
            own, th = (np.array(rows.column(c))[lines.owner[some[line]]] for c in ("own", "th"))
            cells = [key, own, th, lines.number[some[line]], gone, lid[some[line]]]
            order = np.lexsort((cells[3], th, own, gone, key))
            cells = [x[order] for x in cells]
            late, again = np.zeros(len(order), bool), np.zeros(len(order), bool)
            same = [x[1:] == x[:-1] for x in cells]
            late[1:] = same[0] & same[4] & ~same[5]
            again[1:] = np.logical_and.reduce(same)
            yield pa.RecordBatch.from_arrays([pa.array(x[~again], f.type) for x, f in zip((*cells, late), out, strict=True)], schema=out)

    return texts.mapInArrow(run, "key long, own long, th long, line long, gone long, lid long, late boolean")


def _later(variants: DataFrame) -> DataFrame:
    """lids with an earlier line at edit distance 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_hand, whole, cut, seen = None, False, False, {}
        carry = None
        for batch in batches:
            key, gone, lid = (np.array(batch.column(c)) for c in ("key", "gone", "lid"))
            again = np.concatenate([[len(key) > 0 and carry is not None and key[0] == carry], key[1:] == key[:-1]])
            busy = again | np.append(again[1:], True)  # the last may go on in the next batch
            carry, found = key[-1] if len(key) else carry, []
            for k, g, i in zip(key[busy].tolist(), gone[busy].tolist(), lid[busy].tolist(), strict=True):
                if k != at_hand:
                    at_hand, whole, cut, seen = k, False, False, {}
                if cut if g < 0 else whole or seen.get(g, i) != i:
                    found.append(i)
                if g < 0:
                    whole = True
                else:
                    cut = True
                    seen.setdefault(g, i)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["lid"])

    return variants.repartition("key").sortWithinPartitions("key", "own", "th", "line").mapInArrow(run, "lid long")


def dropped(docs: DataFrame, min_words: int = 10, min_chars: int = 24) -> DataFrame:
    """own, th (see `_named`), n_lines (with a word), dropped (line numbers from 0, ascending); only rows with lines."""
    found = saved(_scan(docs, min_words, min_chars), "lines")
    place = F.struct("own", "th", "line")
    lines = saved(found.groupBy("lid").agg(F.min(place).alias("place"), F.first("halves").alias("halves")), "lines")
    near = _sharing(lines.select(F.explode("halves").alias("key"), "lid"))
    named = lines.join(near, "lid").groupBy("place.own", "place.th").agg(F.collect_list(F.struct("place.line", "lid")).alias("lines"))
    variants = saved(_variants(_named(docs).join(named, ["own", "th"]), min_words, min_chars), "variants")
    late = saved(variants.where("late").select("lid").union(_later(variants.where("not late").drop("late"))).distinct(), "late")
    state = lines.select("lid", "place").join(late.withColumn("late", F.lit(True)), "lid", "left")
    goes = F.col("late").isNotNull() | (place != F.col("place"))
    each = found.select("own", "th", "line", "lid", "n").join(state, "lid").select("own", "th", "n", "line", goes.alias("goes"))
    return each.groupBy("own", "th").agg(F.max("n").alias("n_lines"), F.array_sort(F.collect_set(F.when(F.col("goes"), F.col("line")))).alias("dropped"))


def report(docs: DataFrame, *, min_words: int = 10, min_chars: int = 24) -> DataFrame:
    """doc_id, n_lines, n_dropped and the numbers of dropped lines of every document."""
    rows = _named(docs).join(dropped(docs, min_words, min_chars), ["own", "th"], "left")
    none = F.array().cast("array<long>")
    return rows.select("doc_id", F.coalesce("n_lines", F.lit(0).cast("long")).alias("n_lines"), F.size(F.coalesce("dropped", none)).cast("long").alias("n_dropped"), F.coalesce("dropped", none).alias("dropped"))


def drop_lines(docs: DataFrame, *, min_words: int = 10, min_chars: int = 24) -> DataFrame:
    """docs without the dropped lines; documents of which no line with a word is left go."""
    names = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]  # no clash with columns added here
    gone = dropped(docs, min_words, min_chars).where(F.size("dropped") > 0).select("own", "th", "dropped")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long"))
    joined = docs.toDF(*names).withColumns({"own": own, "th": F.xxhash64(F.col("text").cast("string"))}).join(gone, ["own", "th"], "left")
    pieces = F.split(F.col("text").cast("string"), "\n", -1)
    left = F.filter(pieces, lambda line, i: ~F.array_contains(F.col("dropped"), i.cast("long")))
    cut = joined.withColumn("left", F.when(F.col("dropped").isNotNull() & F.col("text").isNotNull(), left))
    text = F.when(F.col("left").isNull(), F.col("text")).otherwise(F.array_join("left", "\n"))
    kept = cut.where(F.col("left").isNull() | F.exists("left", lambda line: line.rlike("[^\\x20\\x09-\\x0D]")))
    return kept.select(*[text.cast(docs.schema[c].dataType).alias(c) if n == "text" else F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
