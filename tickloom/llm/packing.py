"""Operator 10: cost-balanced packing of token streams into sequences of fixed length.

A task tokenizes its documents and packs groups of about `group_tokens` ids. A group opens as many
sequences as its ids fill. Its documents, longest first and cut at the sequence length, go to the
sequence of lowest estimated attention cost that has room left; what does not fit there is cut and
goes on to the next. The pieces for which no room is left, fewer than `seq_len` ids, go on to the
task's next group. What the last group of a task leaves is its tail: the tails of all tasks, and only
they, are shuffled once and packed in the same way, about `tails_together` in a group, so that padding
does not depend on the number of partitions. A hot source or a group of copies is like any other rows.
Every piece comes with its ids and their checksum.

Null and empty texts have only the end id. Repeated rows are packed once each. An empty table gives
no rows. Other columns are ignored. Ties go by arrival in the task.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import batch_of, id_text, saved, sliced, spread
from tickloom.llm.tokenizing import model_text, word_encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part long, ids array<int>"
ARROW = pa.schema([(n, pa.list_(pa.int32()) if n == "ids" else pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "ids")])
#: Ids in one batch of pieces (or one piece).
BATCH_IDS = 1 << 17
#: sequence_id of the pieces that a group leaves.
LEFT = -1
_LATER = 1 << 22  # partition numbers of the second pass, in sequence ids


def balance(lengths: np.ndarray, seq_len: int, linear: float, quadratic: float, close: bool = True) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of documents of these lengths.

    close: open a last sequence for the rest; else only full ones, and what is left has sequence LEFT.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    items = []
    count = 0
    for d, n in enumerate(lengths.tolist()):
        for s in range(0, n - n % seq_len, seq_len):
            pieces.append((d, s, seq_len, count, 0))  # fills a sequence alone
            count += 1
        if n % seq_len:
            items.append((-(n % seq_len), d, n - n % seq_len))
    items.sort()
    rest = -sum(x[0] for x in items)
    # cost, sequence, ids in it
    heap = [(0.0, count + k, 0) for k in range(-(-rest // seq_len) if close else rest // seq_len)]
    for size, d, s in items:
        left = -size
        while left and heap:
            cost, k, used = heapq.heappop(heap)
            n = min(left, seq_len - used)
            pieces.append((d, s, n, k, used))
            s, left, used = s + n, left - n, used + n
            if used < seq_len:
                heapq.heappush(heap, (cost + linear * n + quadratic * n * n, k, used))
        if left:
            pieces.append((d, s, left, LEFT, 0))
    return pieces


class Packer:
    """Packs runs of documents (or pieces of them) that arrive in a task, a group at a time."""

    def __init__(self, part: int, seq_len: int, linear: float, quadratic: float, group_tokens: int):
        self.part, self.options, self.group_tokens = part, (seq_len, linear, quadratic), group_tokens
        self.sequence, self.held, self.tokens = part << 40, [], 0

    def add(self, names: pa.Array, ids: np.ndarray, lengths: np.ndarray, starts: np.ndarray, totals: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Ids of some pieces one after the other; each one's document, length, place in the document, and the document's length."""
        self.held.append((names, ids, lengths, starts, totals))
        self.tokens += len(ids)
        if self.tokens >= self.group_tokens:
            yield from self.pack(False)

    def pack(self, close: bool) -> Iterator[pa.RecordBatch]:
        """Packs what is held; keeps what is left of it."""
        if not self.held:
            return
        names = pa.concat_arrays([x[0] for x in self.held])
        ids, lengths, starts, totals = (np.concatenate([x[k] for x in self.held]) for k in (1, 2, 3, 4))
        self.held, self.tokens = [], 0
        begin = np.cumsum(lengths) - lengths
        placed = np.array(balance(lengths, *self.options, close), np.int64).reshape(-1, 5)
        rest = placed[placed[:, 3] == LEFT]
        if len(rest):
            d, s, n = rest[:, 0], rest[:, 1], rest[:, 2]
            self.held.append((names.take(pa.array(d)), ids[spread(begin[d] + s, n)], n, starts[d] + s, totals[d]))
            self.tokens = int(n.sum())
        placed = placed[placed[:, 3] != LEFT]
        if len(placed):
            yield from self._out(names, ids, begin, starts, totals, placed, self.sequence)
            self.sequence += int(placed[:, 3].max()) + 1

    def tail(self) -> Iterator[pa.RecordBatch]:
        """What is held, unpacked: without sequence and offset."""
        for names, ids, lengths, starts, totals in self.held:
            n = len(lengths)
            placed = np.stack([np.arange(n), np.zeros(n, np.int64), lengths, np.zeros(n, np.int64), np.zeros(n, np.int64)], axis=1)
            yield from self._out(names, ids, np.cumsum(lengths) - lengths, starts, totals, placed, None)

    def _out(self, names, ids, begin, starts, totals, placed, sequence) -> Iterator[pa.RecordBatch]:
        sums = np.cumsum(placed[:, 2])
        for own in np.split(placed, np.flatnonzero(np.diff(sums // BATCH_IDS)) + 1):
            d, s, n, k, o = own.T
            flat = ids[spread(begin[d] + s, n)].astype(np.int32)
            at = np.concatenate([[0], np.cumsum(n)])
            data = memoryview(flat.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * x : 4 * y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            none = pa.nulls(len(d), pa.int64())
            yield batch_of(
                ARROW, names.take(pa.array(d)), starts[d] + s, n, crc, totals[d], none if sequence is None else k + sequence, none if sequence is None else o,
                np.full(len(d), self.part), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat)),
            )


def pack(
    docs: DataFrame, *, tokenizer: str | None = None, seq_len: int = 4096, end_id: int = 2, linear: float = 1.0, quadratic: float = 1 / 2048,
    group_tokens: int = 1 << 20, tails_together: int = 256, special_as_text: bool = False,
) -> DataFrame:
    """Pieces of all documents: their ids, the checksum of these, and their place in the sequences.

    linear, quadratic: estimated cost of n ids that attend to one another is linear*n + quadratic*n*n.
    sequence_id is unique (partition in the upper bits), not gapless. special_as_text: the tokenizer's
    special strings in a text are ordinary text, and not their own ids.
    """
    model = model_text(tokenizer)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = word_encoder(model, special_as_text), Packer(TaskContext.get().partitionId(), seq_len, linear, quadratic, group_tokens)
        for rows, buf, at in sliced(batches):
            ids, ends = encoder.encode(buf, at, end_id)
            lengths = np.diff(ends)
            yield from packer.add(rows.column("doc_id"), ids, lengths, np.zeros_like(lengths), lengths)
        yield from packer.pack(False)
        yield from packer.tail()

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(_LATER + TaskContext.get().partitionId(), seq_len, linear, quadratic, group_tokens)
        for batch in batches:
            if batch.num_rows:
                lengths, starts, totals = (np.array(batch.column(c)) for c in ("length", "start", "doc_tokens"))
                yield from packer.add(batch.column("doc_id"), np.array(batch.column("ids").flatten()), lengths, starts, totals)
        yield from packer.pack(True)

    placed = saved(id_text(docs).mapInArrow(first, SCHEMA), "pieces")
    tails = placed.where("sequence_id is null")
    left = tails.agg(F.sum("length")).first()[0] or 0
    groups = max(1, round(left / (tails_together * seq_len)))
    again = tails.repartition(groups, "part").sortWithinPartitions("part", "doc_id", "start", "ids_crc32").mapInArrow(second, SCHEMA)
    return placed.where("sequence_id is not null").union(again).drop("part")
