"""Exact top-k search, hard negatives and spelling variants against plain versions."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import negatives, queries, spelling, topk, vectors
from tickloom.llm.vectors import Corpus

SCHEMA = "vec_id long, embedding array<float>, label int, q binary, low long, unit int, key string, score double"
#: Small blocks: several phases.
SMALL = {"block_bytes": 1, "chunk_rows": 16, "tile_rows": 4}


def odd(n: int = 900, dim: int = 10) -> list[tuple]:
    """Vectors with ties and copies, nulls, other lengths, values that are not finite, huge ones, repeated ids, and columns with names used inside."""
    rnd = np.random.default_rng(3)
    cells = rnd.standard_normal((n, dim)).astype("float32")
    cells[n // 3 : 2 * n // 3] = np.repeat(cells[n // 3 : n // 3 + 3], n // 9, axis=0)[: 2 * n // 3 - n // 3]  # groups of copies
    cells[: n // 4] = cells[: n // 4].round(1)
    rows = [(i, v, int(rnd.integers(0, 4))) for i, v in enumerate(cells.tolist())]
    zero, big = [0.0] * dim, [3e38] * dim
    rows += [(n, zero, 1), (1000, None, 1), (1100, [float("nan")] * dim, 1), (1200, [None] * dim, 2), (1300, [1.0] * (dim - 1) + [float("-inf")], 0), (1400, [1.0], 1), (1500, [], 1), (1600, big, 1)]
    rows += [(-100, cells[5].tolist(), 2), (-99, cells[6].tolist(), 2), (None, cells[1].tolist(), 1), (300, cells[7].tolist(), None), (200, cells[8].tolist(), 3), (200, cells[8].tolist(), 3), (7, cells[9].tolist(), 1), (7, cells[9].tolist(), 1)]
    return [(*r, b"q", 1, 2, "k", 0.5) for r in rows]


def usable(rows, dim=10, labels=False):
    out = []
    for i, v, label, *_ in rows:
        if i is None or v is None or len(v) != dim or any(x is None or not np.isfinite(x) or abs(x) > 1e10 for x in v) or labels and label is None:
            continue
        out.append((i, np.floor(256 * np.array(v, "float32").astype(float)).astype(np.int64), label))
    return out


def least(rows, which):
    """The row of every id that asks: the least by label and bytes of the integers."""
    out = {}
    for i, v, label in rows:
        if which(i):
            out[i] = min(out.get(i, ((label if label is not None else 0), v.astype("<i8").tobytes(), v)), (label if label is not None else 0, v.astype("<i8").tobytes(), v), key=lambda x: x[:2])
    return {i: (x[2], x[0]) for i, x in out.items()}


def brute_top(rows, k, step):
    out = []
    for q, (v, _) in least([(i, v, 0) for i, v, _ in rows], lambda i: i % step == 0).items():
        best = sorted((-int(v @ w), i) for i, w, _ in rows if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return Counter(out)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(odd(), SCHEMA).repartition(4)


@pytest.mark.parametrize("options", [{}, SMALL], ids=["one phase", "phases"])
def test_top_k(table, options):
    got = topk.search(table, F.col("vec_id") % 50 == 0, **options)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert Counter(map(tuple, got.collect())) == brute_top(usable(odd()), 5, 50)


def test_phases_bound_what_is_sent(table):
    corpus = Corpus.of(table, 256.0, block_bytes=1, chunk_rows=16)
    phases = corpus.phases()
    assert len(phases) == 2 and phases[0][0] == 0 and phases[-1][1] == corpus.blocks and all(a[1] == b[0] for a, b in zip(phases, phases[1:], strict=False))
    cells = corpus.chunks().agg(F.sum(F.length("ids") / 8)).first()[0]
    assert cells == len(usable(odd()))


@pytest.mark.parametrize("top", [300, 2**20, 2**24])
def test_search_block_is_exact(top):
    """Also where doubles no longer hold the sums."""
    rnd = np.random.default_rng(top)
    cells = rnd.integers(-top, top, (40, 700))
    cells[:, 100:200] = cells[:, :1]
    block = vectors.Block(40)
    block.add(np.arange(700).astype("<i8").tobytes(), np.zeros(700, "<i8").tobytes(), *vectors._packed(cells.astype(float)))
    block.close()
    q = cells[:, [0, 3, 650]].T.astype(block.cells.dtype)
    for i, at, score in topk.search_block(topk.Vertical(block), q, np.array([0, 3, 650]), [None, None, 10], 7):
        own = [0, 3, 650][i]
        want = sorted((-int(s), c) for c, s in enumerate(cells.T.astype(object) @ cells[:, own].astype(object)) if c != own)[:7]
        assert [(-int(s), int(block.ids[c])) for c, s in zip(at, score, strict=True)] == want


def test_few_rows(spark):
    few = spark.createDataFrame([(50, [1.0, 2.0], 1), (1, [2.0, 4.0], 1), (2, [1.0, 0.0], 2)], "vec_id long, embedding array<double>, label long")
    assert [tuple(r) for r in topk.search(few, F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(50, 1, 1, 655360), (50, 2, 2, 65536)]
    assert topk.search(few.where("vec_id = 50"), F.col("vec_id") == 50).count() == 0
    assert topk.search(few.limit(0), F.col("vec_id") == 50).count() == 0
    assert negatives.mine(few.limit(0), F.col("vec_id") == 50).count() == 0
    assert [tuple(r) for r in negatives.mine(few, F.col("vec_id") == 50, least=0).collect()] == [(50, 1, 1, 2, 655360, 65536)]


def brute_negatives(rows, step, positives=5, most=10):
    out = []
    for a, (v, label) in least(rows, lambda i: i % step == 0).items():
        scored = sorted((-int(v @ w), i, other) for i, w, other in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            inside = [(-t, i) for t, i, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s][:most]
            out += [(a, p, r, i, -s, t) for r, (t, i) in enumerate(inside, 1)]
    return Counter(out)


@pytest.mark.parametrize("options", [{}, SMALL], ids=["one phase", "phases"])
def test_hard_negatives(table, options):
    got = Counter(map(tuple, negatives.mine(table, F.col("vec_id") % 100 == 0, **options).collect()))
    assert got == brute_negatives(usable(odd(), labels=True), 100)


def test_windows_of_low_scores(spark):
    """Positives of score 0 and below: a window of zeros, or an empty one."""
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [-1.0, 0.0], 1), (3, [0.0, 3.0], 2), (4, [0.0, -3.0], 2), (5, [-0.5, 0.0], 2), (6, [0.5, 0.0], 2), (-8, [0.0, 0.0], 2)]
    got = negatives.mine(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 0).collect()
    assert [(r.positive_id, r["rank"], r.negative_id) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, -8), (1, 2, 3), (1, 3, 4)]


def test_keys_sort_as_bytes():
    rnd = random.Random(1)
    rows = sorted({(rnd.randrange(-3, 3), -rnd.choice([2**55, -(2**55), 0, 1, -1, 70]), rnd.randrange(2), rnd.choice([-(2**63), 2**63 - 1, 0, -1, 5])) for _ in range(200)})
    keys = [negatives.pack(np.array([a]), np.array([-s]), k, np.array([i]))[0] for a, s, k, i in rows]
    assert keys == sorted(keys) and [list(x) for x in zip(*rows, strict=True)] == [x if n != 1 else [-s for s in x] for n, x in enumerate(negatives.unpack(keys))]


@pytest.mark.parametrize("name", ["op11_exact_top_k", "op12_hard_negatives"])
def test_sql(spark, data, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{data}/embeddings.parquet')")
    got = queries.QUERIES[name](spark, data)
    want = con.execute(queries.ORACLES[name])
    assert got.columns == [x[0] for x in want.description]
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


def brute_words(rows, every):
    import re

    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(counts, ratio=2):
    forms, out = {}, {}
    for w, n in counts.items():
        others = [x for x in counts if near(w, x)]
        best = min(((-counts[x], x) for x in others), default=None)
        forms[w] = best[1] if best and -best[0] >= ratio * n else None
        out[w] = [forms[w], None, n, len(others), counts[forms[w]] if forms[w] else None]
    for w in out:
        last = w
        while forms[last]:
            last = forms[last]
        out[w][1] = last
    return {w: tuple(x) for w, x in out.items()}


def shown(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows) and df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return out


def test_spellings(spark, docs, rows):
    counts = {w: n for w, n in brute_words(rows, 3).items() if len(w) >= 2 and n >= 2}
    assert any(x[0] for x in brute_variants(counts).values())
    assert shown(spelling.group_spellings(docs, least_chars=2, least_count=2, typo_every=3)) == brute_variants(counts)


@pytest.mark.parametrize("filter_bytes", [1 << 26, 40], ids=["one pass", "passes"])
def test_random_words(spark, filter_bytes):
    """Few letters: many near words, equal neighbours, chains of forms, ties."""
    rnd = random.Random(7)
    counts = {"".join(rnd.choice("abÀÿ×") for _ in range(rnd.randint(1, 6))): rnd.choice([1, 2, 3, 4, 5, 8, 9, 16, 17, 40]) for _ in range(400)}
    counts |= {"x" * 200: 3, "x" * 199: 7, "x" * 100 + "y" + "x" * 99: 2, "z" * 5000: 4, "z" * 4999 + "a": 9, "日本語": 2, "日本": 5}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert shown(spelling.variants(df, filter_bytes=filter_bytes)) == brute_variants(counts)


def test_long_chain(spark):
    """Forms that lead to forms: the root is the last."""
    counts = {"a" * 20 + "b" * k + "c" * (12 - k): 2**k for k in range(13)}
    got = shown(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute_variants(counts) and {x[1] for x in got.values()} == {"a" * 20 + "b" * 12}


def test_runs(spark):
    """Maximal runs, lower case of A-Z only, typos by doc_id, and a text beyond LONG_TEXT."""
    texts = [(1, "Straße ÉCOLE école naïve×x don't x1y2zzzzz"), (1, "Straße ÉCOLE école naïve×x don't x1y2zzzzz"), (None, "Straße \x00nullid ÀÖØÞ"), (3, None), (4, ""), (5, "ŁódźLong ЖЖЖЖЖЖ word"), (6, "Lengthy wörds " * 90_000)]
    got = {r.word: r.n for r in spelling.word_counts(spark.createDataFrame(texts, "doc_id long, text string"), least_chars=4, typo_every=2).collect()}
    assert got == {w: n for w, n in brute_words(texts, 2).items() if len(w) >= 4}


def test_filters_hold_their_words(spark):
    words = [f"w{i}" for i in range(5000)]
    vocabulary = spelling.keyed(spark.createDataFrame([(w, 1) for w in words], "word string, n long"))
    filters = spelling.build(vocabulary, 0, 1)
    w = spelling.Words(words)
    assert len(filters.holds(w.keys(), w.sizes)) == 5000
    others = spelling.Words([f"v{i}" for i in range(5000)])
    assert len(filters.holds(others.keys(), others.sizes)) < 100


def test_empty_and_null(spark, empty, no_ids):
    assert spelling.group_spellings(empty).count() == 0
    assert shown(spelling.group_spellings(no_ids, least_chars=4)) == {"some": (None, "some", 60, 0, None), "text": (None, "text", 60, 0, None)}
