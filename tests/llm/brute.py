"""Plain versions of the operators for small inputs, and a table of awkward documents."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

#: Extra columns carry names that operators use inside.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, tid string, own long, dropped string, first_id string, marks string, key string, component_id string, part string, grp string, gone_id long"


def awkward() -> list[tuple]:
    """Null and empty texts, blanks only, copies, near copies, shared passages and lines, long and odd texts."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeéßλ日") for _ in range(rnd.randint(1, 7)))
    prose = lambda n: " ".join(word() + rnd.choice(["", "", ",", ".", ".\n", "\n"]) for _ in range(n))
    passage, base = prose(60), prose(120)
    texts = [None, "", "   \n\t", "one", "One two", base, base, base + " more", base.replace("a", "A", 1), passage, prose(40) + " " + passage + " " + prose(40), passage + passage, prose(3000)]
    for _ in range(8):
        words = base.split(" ")
        words[rnd.randrange(len(words))] = word()
        texts.append(" ".join(words))
    line = " ".join(word() for _ in range(14))
    texts += [f"{line}\n{prose(20)}\n{line} plus", f"{line.rsplit(' ', 1)[0]}\n{line} plus\nshort\nshort", f"x {line}\n\n\n{line.replace(' ', '  ')}"]
    texts += ["a b c " * 40, "!!! ### $$$ " * 30, "x" * 3000, "tab\x1csep\x85nel\xa0nbsp  two em 's don't 12½ Ⅷ", "<|endoftext|> <|startoftext|>", "Å é ΑΣ ΣΑΣ", "\x00" * 250, "ab\x00" * 120, "ab\x00" * 100 + "c", "\r\nline\r\nline\r\n" * 9]
    texts += [prose(rnd.randint(1, 200)) for _ in range(20)]
    rows = [(i * 3 - 6, t) for i, t in enumerate(texts)]
    rows += [rows[5], rows[12]]  # repeated rows
    return [(i, t, "en", f"src{n % 3}", len(t or ""), "x", 1, "y", "z", "m", "k", "c", "p", "g", 7) for n, (i, t) in enumerate(rows)]


def sets(text: str | None, size: int) -> set[tuple[str, ...]]:
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def near_duplicates(rows: list[tuple[int, str | None]], size: int = 4, percent: int = 80) -> dict[int, tuple[int, int, bool]]:
    own = {i: sets(t, size) for i, t in rows}
    parent = {i: i for i in own}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(own)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(own[a] & own[b])
            if both and 100 * both >= percent * len(own[a] | own[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(own[i]), root(i), root(i) == i) for i in ids}


def repeats(rows: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple]:
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        out[i] = (len(b), sum(gone), sum(k for k, _ in groupby(gone)), hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    raw = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", raw)
    lines = [x for x in raw.split(b"\n") if re.search(rb"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    often = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    n = len(words)
    return n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(often), n < 50 or 100 * len(often) > 50 * n


def dropped_lines(rows: list[tuple[int, str | None]], min_words: int = 10, min_chars: int = 24) -> dict[int, tuple[int, list[int]]]:
    """Every line against all earlier ones by edit distance over words, or over characters of lines with few words."""
    def near(x, y):
        if x == y:
            return True
        if (len(x) < min_words) != (len(y) < min_words):
            return False
        a, b = (x, y) if len(x) >= min_words else (" ".join(x), " ".join(y))
        if len(x) < min_words and min(len(a), len(b)) < min_chars or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(c != d for c, d in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    before, out = [], {}
    for i, text in sorted(set(rows), key=lambda r: r[0]):
        n, gone = 0, []
        for k, line in enumerate((text or "").split("\n")):
            words = WORD.findall(line.translate(LOWER))
            if words:
                n += 1
                if any(near(words, x) for x in before):
                    gone.append(k)
                before.append(words)
        out[i] = n, gone
    return out


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def by_id(rows, key: str = "doc_id") -> dict:
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out
