"""Operator 9: quality rules in a short-circuit cascade.

Base measures come from every whole text. Documents that pass the base rule go through further
rules, each only over what the rules before it have kept. A bounded sample gives each rule's seconds
per document and share of rejections, and rules with the most rejections per second go first. The
order changes the work, never the verdict: a document stays if no rule rejects it.

Map only: no shuffle, so hot sources and copies cost nothing more. Null and empty texts have no words
and fail the base rule. Repeated rows are judged alike. An empty table gives no rows. Extra columns
are ignored by `judge` and kept by `keep`.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields, replace
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import batch_of, id_text, sliced
from tickloom.llm.hashing import mix, span_hashes, windows, word_spans

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [("base_failed", pa.bool_()), ("kept", pa.bool_())])

_SYMBOL = np.zeros(256, np.int8)
_SYMBOL[list(b"#*$%&|<>")] = 1
_UPPER = np.zeros(256, np.int8)
_UPPER[65:91] = 1
_LETTER = _UPPER.copy()
_LETTER[97:123] = 1
_SHOUT = np.zeros(256, np.int8)
_SHOUT[ord("!")] = 1
_DIGIT = np.zeros(256, np.int8)
_DIGIT[48:58] = 1
_NOT_ASCII = re.compile("[^\x00-\x7f]")


def _count(kinds: np.ndarray, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many bytes of each text are of a kind."""
    sums = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(kinds[buf] if kinds.dtype != bool else kinds, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def _group_sizes(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item how many of its owner's items are equal to it, and whether it is the first of them."""
    with np.errstate(over="ignore"):
        key = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first, inverse, counts = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    leads = np.zeros(len(key), bool)
    leads[first] = True
    return counts[inverse], leads


@dataclass
class Texts:
    """Texts of a slice and their measures; `of` restricts them to some."""

    buf: np.ndarray
    at: np.ndarray
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_lines: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray

    @staticmethod
    def measure(buf: np.ndarray, at: np.ndarray) -> Texts:
        starts, ends, first = word_spans(buf, at)
        n_words = np.diff(first)
        depth = np.zeros(len(buf) + 1, np.int8)
        depth[starts] += 1
        depth[ends] -= 1
        chars = _count((np.cumsum(depth[:-1], dtype=np.int8) > 0) & ((buf & 0xC0) != 0x80), buf, at)
        # lines
        breaks = np.flatnonzero(buf == 10)
        a = np.sort(np.concatenate([at[:-1], breaks + 1]), kind="stable")
        owner = np.searchsorted(at, np.concatenate([at[:-1], breaks]), "right") - 1
        owner[: len(at) - 1] = np.arange(len(at) - 1)
        line_owner = np.sort(owner, kind="stable")
        # a line ends before the next break or at its text's end
        b = at[line_owner + 1].copy()
        follows = np.flatnonzero(line_owner[1:] == line_owner[:-1])
        b[follows] = a[follows + 1] - 1
        worded = np.searchsorted(starts, b) > np.searchsorted(starts, a)
        a, b, line_owner = a[worded], b[worded], line_owner[worded]
        _, leads = _group_sizes(line_owner, span_hashes(buf, a, b))
        n = len(at) - 1
        # words in repeated windows of three
        shingles, where = windows(span_hashes(buf, starts, ends), first, 3)
        short = np.repeat(n_words < 3, np.diff(where))
        texts = np.repeat(np.arange(n), np.diff(where))
        sizes, _ = _group_sizes(texts, shingles)
        often = (sizes > 1) & ~short
        begin = (first[texts] + np.arange(len(shingles)) - where[texts])[often]
        covered = np.zeros(len(starts), bool)
        for k in range(3):
            covered[begin + k] = True
        sums = np.concatenate([[0], np.cumsum(covered)])
        return Texts(buf, at, n_words, chars, _count(_SYMBOL, buf, at), np.bincount(line_owner, minlength=n), np.bincount(line_owner[~leads], minlength=n), sums[first[1:]] - sums[first[:-1]])

    @property
    def base_failed(self) -> np.ndarray:
        return (self.n_words < 50) | (100 * self.n_repeat_words > 50 * self.n_words)

    def of(self, some: np.ndarray) -> Texts:
        """Only these texts; bytes are copied for them alone."""
        parts = [self.buf[self.at[i] : self.at[i + 1]] for i in some]
        at = np.zeros(len(some) + 1, np.int64)
        np.cumsum([len(x) for x in parts], out=at[1:])
        rest = {f.name: getattr(self, f.name)[some] for f in fields(self) if f.name not in ("buf", "at")}
        return replace(self, buf=np.concatenate(parts) if parts else self.buf[:0], at=at, **rest)


def symbol_heavy(t: Texts) -> np.ndarray:
    return 10 * t.n_symbols > 3 * t.n_words


def duplicate_lines(t: Texts) -> np.ndarray:
    return 10 * t.n_dup_lines > 5 * t.n_lines


def long_words(t: Texts) -> np.ndarray:
    """Mean word over 40 characters: encoded data or text without spaces between markup."""
    return t.word_chars > 40 * t.n_words


def shouting(t: Texts) -> np.ndarray:
    """Over 70 % capitals among the letters of all scripts; at least half of the letters must have case."""
    letters, upper = _count(_LETTER, t.buf, t.at), _count(_UPPER, t.buf, t.at)
    others = np.zeros(len(letters), np.int64)  # letters without case
    for i in np.flatnonzero(_count(t.buf >= 128, t.buf, t.at)):
        text = t.buf[t.at[i] : t.at[i + 1]].tobytes().decode(errors="replace")
        for c, n in Counter(_NOT_ASCII.findall(text)).items():
            if c.isalpha():
                if c.isupper() or c.istitle():
                    upper[i] += n
                if c.isupper() or c.islower() or c.istitle():
                    letters[i] += n
                else:
                    others[i] += n
    return (letters > 0) & (letters >= others) & (10 * upper > 7 * letters)


def exclamations(t: Texts) -> np.ndarray:
    return 2 * _count(_SHOUT, t.buf, t.at) > t.n_words


def digits(t: Texts) -> np.ndarray:
    return 2 * _count(_DIGIT, t.buf, t.at) > t.word_chars


RULES: dict[str, Callable[[Texts], np.ndarray]] = {f.__name__: f for f in (symbol_heavy, duplicate_lines, long_words, shouting, exclamations, digits)}


def order_rules(docs: DataFrame, rules: dict[str, Callable] = RULES, sample_rows: int = 2000) -> list[str]:
    """Names of rules by rejections per second of work, measured on about `sample_rows` documents.

    Every partition measures the same small number of its first rows and reads no further.
    """
    each = max(1, sample_rows // max(1, docs.rdd.getNumPartitions()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {n: [0.0, 0] for n in rules}
        for _, buf, at in sliced(b.slice(0, each) for b in islice(batches, 1)):
            texts = Texts.measure(buf, at)
            for n, rule in rules.items():
                began = time.perf_counter()
                seen[n][1] += int(rule(texts).sum())
                seen[n][0] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": list(seen), "seconds": [x[0] for x in seen.values()], "rejected": [x[1] for x in seen.values()]})

    rows = id_text(docs).mapInArrow(run, "rule string, seconds double, rejected long").groupBy("rule").sum("seconds", "rejected").collect()
    return [r[0] for r in sorted(rows, key=lambda r: (-r[2] / (r[1] + 1e-9), r[0]))] or list(rules)


def verdicts(t: Texts, order: list[str], rules: dict[str, Callable] = RULES) -> np.ndarray:
    """Which texts stay: each rule sees only those that all rules before it have kept."""
    kept = ~t.base_failed
    for name in order:
        left = np.flatnonzero(kept)
        if not len(left):
            break
        kept[left] = ~rules[name](t.of(left) if len(left) < len(kept) else t)
    return kept


def judge(docs: DataFrame, *, rules: dict[str, Callable] = RULES, sample_rows: int = 2000) -> DataFrame:
    """Measures and verdict of every document."""
    order = order_rules(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            t = Texts.measure(buf, at)
            yield batch_of(ARROW, rows.column("doc_id"), t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, t.base_failed, verdicts(t, order, rules))

    return id_text(docs).mapInArrow(run, SCHEMA)


def keep(docs: DataFrame, *, rules: dict[str, Callable] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The documents that stay, with all their columns."""
    order = order_rules(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in sliced(batches):
            yield rows.filter(pa.array(verdicts(Texts.measure(buf, at), order, rules)))

    return docs.mapInArrow(run, docs.schema)
