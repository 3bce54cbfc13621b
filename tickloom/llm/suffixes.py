"""Operator 3: repeated substrings by common-prefix intervals of enhanced suffix arrays.

A byte goes if a string of `length` bytes that covers it also starts earlier (in a document of smaller
doc_id, or earlier in the same text). Equal strings of that length have the same minimizer (the least
hash of their `anchor`-byte windows) at the same place, so every such string belongs to one anchor:

1. Anchors of all texts meet by hash, each with a hash of its context (the bytes of all strings that
   belong to it). Anchors that occur once are done with. Of equal contexts only the earliest goes on: all
   others are marked whole, so that a passage which many texts share costs one context an anchor.
2. The others take the bytes of their contexts. Where more than HOT different ones share an anchor (at the
   edges of such a passage), single strings meet by hash instead, and no task holds them together.
3. Contexts of an anchor form a bucket of the suffix array: sorted by what follows the anchor, with the
   longest common prefixes of neighbours. A stack scan gives the intervals of the prefix tree; inside an
   interval members are sorted by what stands before the anchor, and a second scan splits them where
   left extensions differ. What comes out are maximal repeats with all occurrences (`maximal_repeats`).
4. In each repeat of sufficient length every occurrence but the earliest is marked.

Copies of a whole text are found by hash and are marked whole, so groups of copies cost one text. Two
rows of equal doc_id are never earlier than one another. Texts under `length` bytes, null and empty
ones keep everything. Null doc_ids come first. An empty table gives no rows. Texts are told apart by
xxhash64, contexts by 64 bits beside the 64 of their anchor. Other columns are ignored by `digest` and kept by `without_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import hashing
from tickloom.llm.common import batch_of, id_text, sliced, spread

SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")] + [("kept_sha256", pa.string())])
_VALUES = np.random.default_rng(99).integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = np.uint64((1 << 24) - 1)
PIECE = 1 << 21
#: Different contexts of one anchor that a task takes as a bucket; beyond it single strings are compared.
HOT = 4096
#: Bits of a spot: the occurrence is marked whole (`hash` holds its end); the anchor has more than HOT contexts.
WHOLE, CROWDED = 1 << 15, 1 << 7
#: Stands for a null doc_id: before all others.
FIRST = -(2**63)


def _sums(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which the hash of any run of bytes is taken."""
    sums = np.zeros(len(buf) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_VALUES[buf] * hashing._power("up", len(buf)), out=sums[1:])
    return sums


def _hash_of(sums: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return hashing.mix((sums[start + size] - sums[start]) * hashing._power("down", len(sums))[start])


def anchors(buf: np.ndarray, at: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Hash, position, text, first and last start of the strings, and hash of the context of each anchor of each text."""
    n, width = len(buf), length - anchor + 1
    nothing = tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64, np.int64, np.uint64))
    if n < length:
        return nothing
    sums = _sums(buf)
    hashes = _hash_of(sums, np.arange(n + 1 - anchor), anchor)
    # the place stands in the lower bits: the least is the leftmost of equal ones
    least = (hashes & ~_PLACE) | (np.arange(len(hashes), dtype=np.uint64) & _PLACE)
    size = 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    start = spread(at[:-1], np.maximum(0, np.diff(at) - length + 1))  # strings inside a text
    if not len(start):
        return nothing
    place = start + ((least[start] - start.astype(np.uint64)) & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = start[np.concatenate([new[1:], [len(start)]]) - 1]
    first = start[new]
    shape = hashing.mix(((place[new] - first) << 8 | (last - first)).astype(np.uint64))
    context = hashing.mix(_hash_of(sums, first, last - first + length) ^ shape)
    return hashes[place[new]], place[new], np.searchsorted(at, first, "right") - 1, first, last, context


ROWS = pa.schema([(c, pa.int64()) for c in ("hash", "context", "first_id", "tid", "spot")])


def _runs(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of overlapping spans of one owner; spans come by start and end."""
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return first, np.concatenate([first[1:], [len(owner)]])[: len(first)] - 1


def _anchor_rows(texts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(hash, context, first_id, tid, spot) of all anchors; spot packs position, bytes before it and number of strings.

    Contexts that stood earlier in their text are marked whole here, so that a text of one phrase over and over
    gives a few rows: start in `spot`, end in `context`, and any `hash`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            tids, firsts = np.array(rows.column("tid")), np.array(rows.column("first_id"))
            for begin in range(0, max(1, len(buf)), PIECE) if len(at) == 2 else (0,):  # a long text in overlapping pieces
                cut = (buf[begin : begin + PIECE + length - 1], np.clip(at - begin, 0, PIECE + length - 1)) if len(at) == 2 else (buf, at)
                h, place, owner, first, last, context = anchors(*cut, length, anchor)
                spot = (place + begin - at[owner]) << 16 | (place - first) << 8 | (last - first)
                order = np.lexsort((context, h, owner))  # stable: equal ones stay in order of place
                again = np.zeros(len(h), bool)
                again[order[1:]] = (owner[order[1:]] == owner[order[:-1]]) & (h[order[1:]] == h[order[:-1]]) & (context[order[1:]] == context[order[:-1]])
                yield batch_of(ROWS, *(x[~again] for x in (h.view(np.int64), context.view(np.int64), firsts[owner], tids[owner], spot)))
                if again.any():
                    mine, start, end = owner[again], (first + begin - at[owner])[again], (last + length + begin - at[owner])[again]
                    a, z = _runs(mine, start, end)
                    tid, start = tids[mine[a]], start[a]
                    yield batch_of(ROWS, hashing.mix(tid.view(np.uint64) + start.astype(np.uint64)).view(np.int64), end[z], firsts[mine[a]], tid, start << 16 | WHOLE)

    return texts.select("tid", "first_id", "text").mapInArrow(run, "hash long, context long, first_id long, tid long, spot long")


class Leads:
    """Goes through occurrences sorted by group, first_id, tid and spot, and tells which of them are earliest.

    An occurrence comes after its group's first one if it stands in a row of greater doc_id, or later in the same
    text. Rows of one doc_id but other texts are not later than one another: each is earliest. Equal rows count once.
    """

    def __init__(self) -> None:
        self.last: np.ndarray | None = None
        self.first_id = 0

    def split(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Masks of the earliest and of the later occurrences; the last three rows of `rows` are first_id, tid, spot."""
        before = rows[:, :1] - 1 if self.last is None else self.last
        differs = rows != np.concatenate([before, rows[:, :-1]], axis=1)
        group = differs[:-3].any(0)
        lead = np.maximum.accumulate(np.where(group, np.arange(rows.shape[1]), -1))
        lead_id = np.where(lead >= 0, rows[-3][lead], self.first_id)
        earliest = (rows[-3] == lead_id) & (group | differs[-3] | differs[-2])
        self.last, self.first_id = rows[:, -1:].copy(), int(lead_id[-1])
        return earliest, differs.any(0) & ~earliest


def _repeated(rows: DataFrame, length: int) -> DataFrame:
    """(hash, tid, spot) of what is left to compare, and of what is marked whole already.

    Contexts that an earlier place has as well are marked whole: runs of overlapping ones as one row, with the start
    in `spot` and the end in `hash`. Of the others those go on whose anchor has at least two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leads, crowded = Leads(), None
        held = np.zeros((3, 0), np.int64)  # at most HOT contexts of the anchor that the last batch ended with
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([np.array(batch.column(i)) for i in range(5)])
            marked = rows[4] & WHOLE != 0
            if marked.any():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows[[1, 3, 4]][:, marked]], ["hash", "tid", "spot"])
                rows = rows[:, ~marked]
                if not rows.shape[1]:
                    continue
            earliest, later = leads.split(rows)
            group, tid, spot = np.cumsum((rows[:2, 1:] != rows[:2, :-1]).any(0)), rows[3, later], rows[4, later]
            group = np.concatenate([[0], group])[later]
            start = (spot >> 16) - (spot >> 8 & 127)
            end = start + length + (spot & 127)
            a, z = _runs(np.cumsum(np.concatenate([[0], (group[1:] != group[:-1]) | (tid[1:] != tid[:-1])]))[: len(tid)], start, end)
            found = np.stack([end[z], tid[a], start[a] << 16 | WHOLE])
            held = np.concatenate([held, rows[[0, 3, 4]][:, earliest]], axis=1)
            edges = np.concatenate([[0], np.flatnonzero(held[0, 1:] != held[0, :-1]) + 1, [held.shape[1]]])
            sizes = np.diff(edges)
            flag = np.repeat((sizes > HOT) | (held[0, edges[:-1]] == crowded if crowded is not None and held.shape[1] else False), sizes)
            open_ = np.arange(held.shape[1]) >= (edges[-2] if len(edges) > 1 else 0)
            ready = flag | ~open_ & (np.repeat(sizes, sizes) > 1)
            if held.shape[1]:
                crowded = held[0, -1] if flag[-1] else None
            out = held[:, ready]
            out[2] |= np.where(flag[ready], CROWDED, 0)
            held = held[:, open_ & ~flag]
            out = np.concatenate([found, out], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["hash", "tid", "spot"])
        if held.shape[1] > 1:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["hash", "tid", "spot"])

    return rows.repartition("hash").sortWithinPartitions(*ROWS.names).mapInArrow(run, "hash long, tid long, spot long")


def _contexts(joined: DataFrame, length: int) -> DataFrame:
    """(hash, first_id, tid, spot, context) of repeated anchors, from their texts.

    Of crowded anchors the single strings, without context: `hash` is that of string and anchor, `spot` their start.
    """
    out = pa.schema([("hash", pa.int64()), ("first_id", pa.int64()), ("tid", pa.int64()), ("spot", pa.int64()), ("context", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            spots = rows.column("spots")
            flat, owner = spots.flatten(), np.repeat(np.arange(rows.num_rows), np.diff(np.array(spots.offsets)))
            all_spots = np.array(flat.field("spot"))
            for crowded in (0, CROWDED):
                chosen = np.flatnonzero(all_spots & (WHOLE | CROWDED) == crowded)
                if not len(chosen):
                    continue
                own, spot, h = owner[chosen], all_spots[chosen], np.array(flat.field("hash"))[chosen]
                begin = at[own] + (spot >> 16) - (spot >> 8 & 127)
                many = (spot & 127) + 1
                if crowded:
                    start, own, h = spread(begin, many), np.repeat(own, many), np.repeat(h, many)
                    h = hashing.mix(_hash_of(_sums(buf), start, length) ^ h.view(np.uint64)).view(np.int64)
                    spot, size = (start - at[own]) << 16 | CROWDED, np.zeros(len(start), np.int64)
                    data = np.zeros(0, np.uint8)
                else:
                    size = length - 1 + many
                    data = buf[spread(begin, size)]
                context = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(data)])
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays([pa.array(h), rows.column("first_id").take(take), rows.column("tid").take(take), pa.array(spot), context], schema=out)

    return joined.mapInArrow(run, "hash long, first_id long, tid long, spot long, context binary")


def intervals(lcp: list[int], least: int) -> list[tuple[int, int, int]]:
    """(common prefix, first, last) of all intervals of at least that prefix; lcp[i] is that of items i and i + 1."""
    found, stack = [], []
    for i, value in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > value:
            depth, first = stack.pop()
            found.append((depth, first, i))
        if value >= least and (not stack or stack[-1][0] < value):
            stack.append((value, first))
    return found


class Bucket:
    """Contexts of many anchors as suffix arrays: right of the anchor, and left of it backwards."""

    def __init__(self, run: np.ndarray, before: np.ndarray, sizes: np.ndarray, data: np.ndarray, length: int, anchor: int):
        m, self.before, self.after = len(run), before, sizes - before
        ends = np.cumsum(sizes)
        middle = ends - sizes + before
        self.right = self._matrix(data, middle, self.after, length, 1)
        self.left = self._matrix(data, middle - 1, before, length - anchor, -1)
        self.order, self.lcp = self._sorted(run, self.right, self.after)
        left_order, self.lcs = self._sorted(run, self.left, before)
        self.left_rank = np.empty(m, np.int64)
        self.left_rank[left_order] = np.arange(m)
        self.left_order = left_order

    @staticmethod
    def _matrix(data: np.ndarray, start: np.ndarray, sizes: np.ndarray, width: int, step: int) -> np.ndarray:
        wide = -(-width // 8) * 8
        out = np.zeros((len(start), wide), np.uint8)
        reach = np.arange(width)
        inside = reach[None, :] < sizes[:, None]
        index = start[:, None] + step * reach[None, :]
        out[:, :width][inside] = data[index[inside]]
        return out

    @staticmethod
    def _sorted(run: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = rows.view(">u8").astype(np.uint64)
        order = np.lexsort((sizes, *words.T[::-1], run))
        a, b = rows[order[:-1]], rows[order[1:]]
        differs = a != b
        common = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
        return order, np.minimum(common, np.minimum(sizes[order[:-1]], sizes[order[1:]]))


def maximal_repeats(bucket: Bucket, first: int, last: int, length: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(bytes before, bytes after, members) of every maximal repeat of at least `length` bytes among
    the suffixes first..last of a bucket: members share them, and no byte more on the left."""
    left_most = int(bucket.before[bucket.order[first : last + 1]].max())
    for after, i, j in intervals(bucket.lcp[first:last].tolist(), max(1, length - left_most)):
        members = bucket.order[first + i : first + j + 1]
        ranks = np.sort(bucket.left_rank[members])
        gaps = np.minimum.reduceat(bucket.lcs[ranks[0] : ranks[-1]], ranks[:-1] - ranks[0])  # between members that need not be neighbours
        own = bucket.left_order[ranks]
        for before, x, y in intervals(gaps.tolist(), length - after):
            yield before, after, own[x : y + 1]


def _marks(contexts: DataFrame, length: int, anchor: int) -> DataFrame:
    """(tid, start, end) of marked bytes: all occurrences of maximal repeats but the earliest."""
    out = pa.schema([("tid", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def mark(t: pa.Table) -> pa.RecordBatch:
        order = np.lexsort([np.array(t.column(c)) for c in ("spot", "tid", "hash")])
        same = np.stack([np.diff(np.array(t.column(c))[order]) for c in ("hash", "tid", "spot")])
        if (again := ~same.any(0)).any():  # repeated rows: a place counts once
            t = t.take(pa.array(np.sort(order[np.concatenate([[True], ~again])])))
        run = np.array(t.column("hash"))
        first_id = np.array(t.column("first_id"))
        tid, spot = np.array(t.column("tid")), np.array(t.column("spot"))
        context = t.column("context").combine_chunks()
        offsets = np.frombuffer(context.buffers()[1], np.int32)[context.offset : context.offset + len(context) + 1].astype(np.int64)
        data = np.frombuffer(context.buffers()[2], np.uint8)[offsets[0] :]
        place, sizes = spot >> 16, np.diff(offsets)
        rank = np.empty(len(run), np.int64)  # order of occurrences
        rank[np.lexsort((place, first_id))] = np.arange(len(run))
        b = Bucket(run, spot >> 8 & 255, sizes, data, length, anchor)
        edges = np.flatnonzero(np.concatenate([[True], np.diff(run) != 0, [True]]))
        # all marks of an occurrence hold its anchor, so together they are one run of bytes
        most_before, most_after = np.full(len(run), -1), np.full(len(run), -1)

        def put(members: np.ndarray, before, after) -> None:
            most_before[members] = np.maximum(most_before[members], before)
            most_after[members] = np.maximum(most_after[members], after)

        def later(members: np.ndarray, lead: int) -> np.ndarray:
            """Members that come after the earliest: rows of one doc_id but other texts don't count as later."""
            return (members != lead) & ~((first_id[members] == first_id[lead]) & (tid[members] != tid[lead]))

        pairs = edges[:-1][np.diff(edges) == 2]  # a bucket of two is a single interval
        x, y = b.order[pairs], b.order[pairs + 1]
        after, before = b.lcp[pairs], b.lcs[pairs]
        late = np.where(rank[x] < rank[y], y, x)
        good = (before + after >= length) & ((first_id[x] != first_id[y]) | (tid[x] == tid[y]))
        put(late[good], before[good], after[good])
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            if j - i > 2:
                for before_, after_, members in maximal_repeats(b, int(i), int(j) - 1, length):
                    put(members[later(members, members[rank[members].argmin()])], before_, after_)
        hit = most_after >= 0
        return pa.RecordBatch.from_arrays([pa.array(x[hit], pa.int64()) for x in (tid, place - most_before, place + most_after)], schema=out)

    def single(batch: pa.RecordBatch, leads: Leads) -> pa.RecordBatch:
        """Strings of crowded anchors, one after the other."""
        rows = np.stack([np.array(batch.column(c)) for c in ("hash", "first_id", "tid", "spot")])
        _, later = leads.split(rows)
        start = rows[3, later] >> 16
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (rows[2, later], start, start + length)], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        leads = Leads()
        for batch in batches:
            crowded = np.array(batch.column("spot")) & CROWDED != 0
            if crowded.any():
                yield single(batch.filter(pa.array(crowded)), leads)
                batch = batch.filter(pa.array(~crowded))
            if not batch.num_rows:
                continue
            h = np.array(batch.column("hash"))
            change = np.flatnonzero(np.diff(h) != 0)
            if held and h[0] != held[-1].column("hash")[-1].as_py():
                yield mark(pa.Table.from_batches(held))
                held = []
            if len(change):
                cut = int(change[-1]) + 1
                yield mark(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held, batch = [], batch.slice(cut)
            held.append(batch)
        if held:
            yield mark(pa.Table.from_batches(held))

    return contexts.repartition("hash").sortWithinPartitions("hash", "first_id", "tid", "spot").mapInArrow(run, "tid long, start long, end long")


def spans(docs: DataFrame, length: int = 100, anchor: int = 32) -> DataFrame:
    """All columns of docs, with `first_id` (least doc_id of an equal text) and `marks` (start and end of bytes that go)."""
    if not 0 < length - anchor < 128 or length > 200:
        raise ValueError("length - anchor must be 1..127 and length at most 200")
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(FIRST).cast("long"))
    keyed = docs.withColumn("tid", F.xxhash64(F.col("text").cast("string")))
    firsts = keyed.where("text is not null").groupBy("tid").agg(F.min(own).alias("first_id"))
    # all joins are by tid alone, so that the texts are shuffled once for all uses
    texts = firsts.join(keyed, "tid").where(own <= F.col("first_id"))
    lists = _repeated(_anchor_rows(texts, length, anchor), length).groupBy("tid").agg(F.collect_list(F.struct("hash", "spot")).alias("spots"))
    of_texts = lists.join(firsts, "tid").join(keyed, "tid").where(own <= F.col("first_id"))
    marks = _marks(_contexts(of_texts.select("tid", "first_id", "spots", "text"), length), length, anchor)
    marked = marks.groupBy("tid").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    whole = F.transform(
        F.filter("spots", lambda s: s["spot"].bitwiseAND(F.lit(WHOLE).cast("long")) != 0),
        lambda s: F.struct(F.shiftright(s["spot"], 16).alias("start"), s["hash"].alias("end")),
    )
    none = F.array().cast("array<struct<start:long,end:long>>")
    all_marks = F.concat(F.coalesce("marks", none), F.coalesce(whole, none))
    return keyed.join(firsts, "tid", "left").join(marked, "tid", "left").join(lists, "tid", "left").withColumn("marks", all_marks).drop("tid", "spots")


def removed(marks: pa.Array, rows: int, at: np.ndarray, copies: np.ndarray, length: int) -> np.ndarray:
    """Bytes that go, over the texts of a slice."""
    gone = np.zeros(at[-1] + 1, np.int32)
    flat, owner = marks.flatten(), np.repeat(np.arange(rows), np.diff(np.array(marks.offsets)) if len(marks) else [])
    np.add.at(gone, at[owner] + np.array(flat.field("start")), 1)
    np.add.at(gone, at[owner] + np.array(flat.field("end")), -1)
    for i in np.flatnonzero(copies & (np.diff(at) >= length)):
        gone[at[i]] += 1
        gone[at[i + 1]] -= 1
    return np.cumsum(gone[:-1]) > 0


def _copies(rows: pa.RecordBatch) -> np.ndarray:
    """Rows whose text also stands in a row of smaller doc_id."""
    own, first = (np.array(rows.column(c).cast(pa.int64()).fill_null(FIRST)) for c in ("doc_id", "first_id"))
    return (own > first) & np.array(rows.column("text").is_valid())


def digest(docs: DataFrame, *, length: int = 100, anchor: int = 32) -> DataFrame:
    """Size, removed bytes, spans and hash of the rest of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            gone = removed(rows.column("marks"), rows.num_rows, at, _copies(rows), length)
            cells = []
            for i in range(rows.num_rows):
                own, text = gone[at[i] : at[i + 1]], buf[at[i] : at[i + 1]]
                cells.append((len(text), int(own.sum()), int(np.count_nonzero(own[1:] & ~own[:-1]) + bool(len(own) and own[0])), hashlib.sha256(text[~own].tobytes()).hexdigest()))
            yield batch_of(ARROW, rows.column("doc_id"), *zip(*cells, strict=True))

    return spans(id_text(docs), length, anchor).select("doc_id", "text", "first_id", "marks").mapInArrow(run, SCHEMA)


def without_repeats(docs: DataFrame, *, length: int = 100, anchor: int = 32) -> DataFrame:
    """docs with repeats cut out of their texts, whole characters only; rows left without any text go."""
    names = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]  # no clash with columns added here
    docs_names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            gone = removed(rows.column("marks"), rows.num_rows, at, _copies(rows), length)
            lead = (buf & 0xC0) != 0x80
            char = np.cumsum(lead) - 1  # a character goes if all its bytes do
            whole = np.bincount(char, gone, minlength=1) == np.bincount(char, minlength=1) if len(buf) else np.zeros(1, bool)
            gone = whole[char] if len(buf) else gone
            texts = [None if not t else buf[at[i] : at[i + 1]][~gone[at[i] : at[i + 1]]].tobytes().decode() for i, t in enumerate(rows.column("text").is_valid().to_pylist())]
            out = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else rows.column(n) for n in names], docs_names)
            cut = np.array([gone[at[i] : at[i + 1]].any() for i in range(rows.num_rows)], bool)
            yield out.filter(pa.array([not c or bool(t.strip()) for c, t in zip(cut, texts, strict=True)]))

    return spans(docs.toDF(*names), length, anchor).select(*names, "first_id", "marks").mapInArrow(run, docs.schema)
