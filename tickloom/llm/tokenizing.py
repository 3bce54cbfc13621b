"""Ids of whole texts by the `tokenizers` library, every distinct word encoded once per worker.

The word tokenizer drops white space and none of its normalizers, patterns or merges reach across
it, so a text's ids are those of its words (split at ASCII white space) one after the other. Its
pattern also parts letters from the stop behind them and its ids do not depend on ASCII case, so
"word, " and "Word. " share what is encoded. A text with one of the tokenizer's special strings is
encoded whole, as the library does by default: the string becomes its own id.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np

from tickloom.llm.common import spread

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes of distinct words that a worker remembers (and words of 16 bytes on average); beyond it starts
#: anew. Only speed depends on it.
REMEMBERED = 12 << 20


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,!?;:")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


class _Seen(dict):
    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


def parted(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in lower case (A-Z), with a blank between a letter and a stop that white space follows."""
    buf = _LOWER[buf]
    if len(buf) < 3:
        return buf, at
    stops = np.flatnonzero(_STOP[buf[1:-1]] & _LETTER[buf[:-2]] & _SPACE[buf[2:]]) + 1
    return np.insert(buf, stops, 32), at + np.searchsorted(stops, at)


class WordEncoder:
    def __init__(self, model: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        own = [] if special_as_text else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, own))) if own else None
        self.forget()

    def forget(self) -> None:
        self.seen, self.flat, self.start, self.length, self.used = _Seen(), np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), 0
        self.bytes = 0

    def _learn(self) -> None:
        self.tokenizer.encode_special_tokens = True  # words in lower case: what looks like a special string here is none
        self.bytes += sum(map(len, self.seen.new)) + 16 * len(self.seen.new)
        words, self.seen.new = [w.decode() for w in self.seen.new], []
        plain = [w.isascii() and w.isalpha() for w in words]  # lower case already: a single match of the pattern
        rest = iter(self.tokenizer.encode_batch_fast([w for w, p in zip(words, plain, strict=True) if not p], add_special_tokens=False))
        model = self.tokenizer.model
        ids = [[x.id for x in model.tokenize(w)] if p else next(rest).ids for w, p in zip(words, plain, strict=True)]
        known, lengths = len(self.seen) - len(words), np.fromiter(map(len, ids), np.int64, len(ids))
        while len(self.start) < len(self.seen):
            self.start, self.length = np.concatenate([self.start, np.zeros_like(self.start)]), np.concatenate([self.length, np.zeros_like(self.length)])
        total = int(lengths.sum())
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        ends = self.used + np.cumsum(lengths)
        self.start[known : len(self.seen)], self.length[known : len(self.seen)] = ends - lengths, lengths
        self.used += total

    def encode(self, buf: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with end_id behind it, and the texts' offsets in them."""
        data = buf.tobytes()
        if not self.special or not self.special.search(data):
            return self._encode(buf, at, end_id)
        parts, begin = [], 0
        for i in [*(i for i in range(len(at) - 1) if self.special.search(data, at[i], at[i + 1])), len(at) - 1]:
            parts.append(self._encode(buf[at[begin] : at[i]], at[begin : i + 1] - at[begin], end_id))
            if i < len(at) - 1:
                self.tokenizer.encode_special_tokens = False
                ids = self.tokenizer.encode(data[at[i] : at[i + 1]].decode(), add_special_tokens=False).ids
                parts.append((np.array([*ids, end_id], np.uint32), np.array([0, len(ids) + 1])))
            begin = i + 1
        lengths = np.concatenate([np.diff(x[1]) for x in parts])
        return np.concatenate([x[0] for x in parts]), np.concatenate([[0], np.cumsum(lengths)])

    def _encode(self, buf: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        if self.bytes > REMEMBERED:
            self.forget()
        buf, at = parted(buf, at)
        data, words, counts = buf.tobytes(), [], []
        for i in range(len(at) - 1):
            own = data[at[i] : at[i + 1]].split()
            counts.append(len(own))
            words += own
        index = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
        if self.seen.new:
            self._learn()
        lengths = self.length[index]
        sums = np.zeros(len(words) + 1, np.int64)
        np.cumsum(lengths, out=sums[1:])
        first = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=first[1:])
        offsets = sums[first] + np.arange(len(first))
        out = np.empty(offsets[-1], np.uint32)
        ends = np.zeros(len(out), bool)
        ends[offsets[1:] - 1] = True
        out[ends] = end_id
        out[~ends] = self.flat[spread(self.start[index], lengths)]
        return out, offsets


_encoders: dict[str, WordEncoder] = {}


def word_encoder(model: str, special_as_text: bool = False) -> WordEncoder:
    """The worker's encoder of a tokenizer file's content. special_as_text: special strings are ordinary text."""
    key = hashlib.md5(model.encode()).hexdigest() + str(special_as_text)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordEncoder(model, special_as_text)
    return _encoders[key]


def model_text(path: str | None = None) -> str:
    """Content of a tokenizer file, read on the driver and sent to tasks (its size does not grow with the data)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()
