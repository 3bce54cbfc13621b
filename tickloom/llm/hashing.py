"""Words of UTF-8 text as numpy arrays: positions and 64-bit hashes without a Python loop per word.

A word is a run of bytes other than space and 0x09-0x0D; continuation bytes of UTF-8 never fall
into that set. The hash is a polynomial over random byte values, taken from prefix sums, then
mixed; words over LONG_WORD bytes are hashed one by one.
"""

from __future__ import annotations

import numpy as np
import xxhash

LONG_WORD = 1000
PIECE = 1 << 21

_RANDOM = np.random.default_rng(20240229)
_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWERED = _VALUES[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C15
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base, or of its inverse modulo 2**64."""
    have = _powers[kind]
    if len(have) < n:
        size = max(n, PIECE + LONG_WORD)
        base = _BASE if kind == "up" else pow(_BASE, -1, 2**64)
        steps = np.full(size, base & (2**64 - 1), np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            have = _powers[kind] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_spans(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (one more at the end)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = ~_SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[at] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, at)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """Hashes of ascending, disjoint spans. lower: A-Z count as a-z."""
    out = np.zeros(len(starts), np.uint64)
    values, i = (_LOWERED if lower else _VALUES), 0
    with np.errstate(over="ignore"):
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
            a, b = starts[i], ends[j - 1]
            if b - a <= PIECE:
                n = int(b - a)
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(values[buf[a:b]] * _power("up", n), out=sums[1:])
                s, e = starts[i:j] - a, ends[i:j] - a
                out[i:j] = (sums[e] - sums[s]) * _power("down", n)[s]
            i = j
        out = mix(out + (ends - starts).astype(np.uint64))
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        span = buf[starts[k] : ends[k]]
        out[k] = xxhash.xxh3_64_intdigest((_LOWER[span] if lower else span).tobytes())
    return out


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words inside a text, and each text's first run.

    A text with fewer words, but one at least, has a single run: all of its words.
    """
    n = np.diff(first)
    with np.errstate(over="ignore"):
        full = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
        for k in range(width):
            full += hashes[k : k + len(full)] * np.uint64((0xD6E8FEB86659FD93 * (2 * k + 1)) & (2**64 - 1))
        full = mix(full)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    at = np.zeros(len(first), np.int64)
    np.cumsum(count, out=at[1:])
    out = np.zeros(at[-1], np.uint64)
    whole = np.repeat(n >= width, count)
    begin = np.repeat(first[:-1], count) + np.arange(at[-1]) - np.repeat(at[:-1], count)
    out[whole] = full[begin[whole]]
    for i in np.flatnonzero((n > 0) & (n < width)):
        out[at[i]] = xxhash.xxh3_64_intdigest(hashes[first[i] : first[i + 1]].tobytes(), seed=1)
    return out, at
