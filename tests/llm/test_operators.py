"""Each operator against a plain version, on awkward documents, nulls and empty tables."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import bpe, components, linededup, minhash, neighbours, packing, quality, sharding, suffixes, tokenids, toxicity
from tickloom.llm.common import scratch


@pytest.fixture(scope="module")
def words():
    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_near_duplicates(docs, rows):
    got = minhash.near_duplicates(docs).collect()
    want = brute.near_duplicates(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == want


def test_near_duplicates_tiles_and_fans(docs, rows, monkeypatch):
    """Small tiles and many tasks for one text change nothing."""
    monkeypatch.setattr(minhash, "TILE", 2)
    got = minhash.near_duplicates(docs, words=3, percent=60).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_duplicates(rows, 3, 60)


def test_chain_of_near_duplicates(spark):
    """Neighbours in a chain are similar, its ends are not: one component, and no link to the hub is needed."""
    words = [f"w{i}" for i in range(200)]
    texts = [(i, " ".join(words[4 * i : 4 * i + 100])) for i in range(20)]
    got = minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), words=4, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute.near_duplicates(texts)


def test_index_meets_pairs_within_the_distance():
    """Any two signatures with fewer than 2 * chunks differing values share a key."""
    rnd = np.random.default_rng(0)
    for _ in range(50):
        a = rnd.integers(0, 2**16, (1, 84), dtype=np.uint16)
        b = a.copy()
        b[0, rnd.choice(84, 27, replace=False)] ^= 1
        x, y = minhash.index_keys(np.concatenate([a, b]), 14, 6)
        assert set(x) & set(y)


def test_shared_sizes():
    rnd = np.random.default_rng(2)
    base = rnd.integers(0, 1000, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rnd.choice(base, 200), rnd.integers(0, 2**60, 9, dtype=np.uint64)])) for _ in range(40)]
    got = minhash.shared_sizes(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(40) for j in range(40) if i != j)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {i: i for e in edges for i in e}
    for _ in range(80):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {i: parent[i] for e in edges if e[0] != e[1] for i in e}


def test_one_of_each(docs, rows):
    got = minhash.one_of_each(docs)
    assert got.columns == docs.columns
    want = brute.near_duplicates(rows, 5)
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in rows if want[i][2])


def test_token_ids(docs, rows, words):
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokenids.round_trip(docs, segment_tokens=500).collect())
    start, want = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*words(text), 1]
        want.append((i, start, len(ids), brute.crc(ids)))
        start += len(ids)
    assert got == want


def test_random_access(spark, docs, rows, words):
    path = scratch(spark, "ids")
    tokenids.write_ids(docs, path, segment_tokens=300)
    flat = [x for _, t in sorted(rows, key=lambda r: (r[0], r[1] or "")) for x in [*words(t), 1]]
    for position in (0, 7, len(flat) // 2, len(flat) - 1):
        found = tokenids.token_at(spark, path, position)
        assert [r.token_id for r in found.collect()] == [flat[position]]
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(part," in plan and "EqualTo(tokens_before," in plan and "doc_ids" not in plan
    assert tokenids.token_at(spark, path, len(flat)).count() == 0


def test_special_strings(spark, words):
    """Special strings become their ids as in the plain library call, or are ordinary text if asked for."""
    texts = [(0, "<|endoftext|>. x</w> <unk>"), (1, "a <|ENDOFTEXT|> b"), (2, "Plain. Words, here"), (3, "x<|startoftext|>y<|endoftext|><|endoftext|>"), (4, "<|endoftext"), (5, None), (6, "The End.")]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.ids for r in packing.pack(df).collect()}
    assert got == {i: [*words(t), 2] for i, t in texts} and got[0][0] == 49407
    plain = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    plain.encode_special_tokens = True
    got = {r.doc_id: r.ids for r in packing.pack(df, special_as_text=True).collect()}
    assert got == {i: [*plain.encode(t or "", add_special_tokens=False).ids, 2] for i, t in texts} and got[0][0] != 49407


@pytest.mark.parametrize("top", [2, 255, 256, 60_000, 2**24])
def test_codes(top):
    ids = np.random.default_rng(top).integers(0, top, 3000).astype(np.uint32)
    codes = tokenids.Codes(*tokenids.Codes.pack(ids))
    assert [codes.at(i) for i in range(0, 3000, 7)] == ids[::7].tolist()
    for a, b in ((0, 3000), (0, 0), (511, 513), (5, 2999), (1024, 1040)):
        assert codes.between(a, b).tolist() == ids[a:b].tolist()


def test_repeats(docs, rows):
    got = suffixes.digest(docs).collect()
    want = brute.repeats(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_random_bytes(spark, seed):
    """Few letters and short strings: deep prefix trees, overlaps, repeats inside a text."""
    rnd = random.Random(seed)
    texts = [(i, "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 400)))) for i in range(60)]
    got = suffixes.digest(spark.createDataFrame(texts, "doc_id long, text string"), length=12, anchor=4).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.repeats(texts, 12)


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 200)
    rnd = random.Random(9)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(500))
    texts = [(1, part + "--" + part), (2, "xy" + part[50:])]
    got = suffixes.digest(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute.repeats(texts)


def _spans_of(spark, texts, **options):
    got = suffixes.digest(spark.createDataFrame(texts, "doc_id long, text string"), **options).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}


@pytest.mark.parametrize("hot", [1, 2, 5])
def test_crowded_anchors(spark, monkeypatch, hot):
    """Anchors with more different contexts than a bucket takes: strings meet one by one, with the same result."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    rnd = random.Random(hot)
    noise = lambda n: "".join(rnd.choice("abé ") for _ in range(n))
    passage = noise(120)
    texts = [(i, noise(rnd.randint(0, 60)) + (passage[rnd.randint(0, 30) :] if i % 3 else "") + noise(rnd.randint(0, 60)) + "a" * (i % 40)) for i in range(80)]
    texts += [(100 + i, texts[i][1]) for i in range(5)]
    assert _spans_of(spark, texts, length=16, anchor=5) == brute.repeats(texts, 16)


def test_passage_in_a_third_of_all_texts(spark):
    """More texts than a bucket takes share a passage: inside of it one context an anchor is left, edges are compared by strings."""
    rnd = random.Random(4)
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = noise(300)
    texts = [(i, noise(60) + (passage if i % 3 == 0 else noise(90)) + noise(60)) for i in range(3 * (suffixes.HOT + 100))]
    assert _spans_of(spark, texts) == brute.repeats(texts)


def test_long_run_of_one_byte(spark):
    """Ten million equal bytes between other text: equal contexts collapse to a few marks."""
    texts = [(1, "start of it " + "a" * 10_000_000 + " end"), (2, "b" + "a" * 300 + "b")]
    assert _spans_of(spark, texts) == brute.repeats(texts)


def test_rows_of_one_doc_id(spark):
    """Other texts of equal doc_id are not earlier than one another; later rows have all of them as earlier ones."""
    rnd = random.Random(6)
    part = "".join(rnd.choice("abcdefgh ") for _ in range(250))
    texts = [(1, "x" + part), (1, "y" + part + "y"), (1, "x" + part), (2, part), (None, "z" + part[:120])]
    got = suffixes.digest(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed) for r in got) == [(0, 121, 0), (1, 251, 120), (1, 251, 120), (1, 252, 120), (2, 250, 250)]


def test_intervals():
    assert sorted(suffixes.intervals([2, 3, 3, 1, 4], 1)) == [(1, 0, 5), (2, 0, 3), (3, 1, 3), (4, 4, 5)]


def test_without_repeats(docs, rows):
    got = suffixes.without_repeats(docs)
    assert got.columns == docs.columns
    want = brute.repeats(rows)
    for r in got.collect():
        text = dict(rows)[r.doc_id]
        assert r.text == text or want[r.doc_id][1] and len(r.text.encode()) >= len(text.encode()) - want[r.doc_id][1]


def test_sharding(docs, rows):
    got = sharding.place(docs, shards=4, parts=2).collect()
    texts, shards = dict(rows), {}
    assert len(got) == len(rows) and "Python" not in sharding.place(docs)._jdf.queryExecution().toString()
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        shards.setdefault(r.shard, []).append(r)
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))


def test_shard_moves_whole_rows(docs):
    """Every row comes out with all its columns, in the order of its shard's slots, after one exchange."""
    moved = sharding.shard(docs, shards=4, parts=2)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(part") == 1 and "Python" not in plan
    got = moved.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    assert moved.columns == [*docs.columns, "shard", "slot"]
    assert Counter(tuple(r)[:-3] for r in got) == Counter(map(tuple, docs.collect()))
    want = Counter((r.doc_id, r.shard, r.slot) for r in sharding.place(docs, shards=4, parts=2).collect())
    assert Counter((r.doc_id, r.shard, r.slot) for r in got).keys() == want.keys()
    keys = {(r.shard, r.slot): r.hash for r in got}
    assert all(keys[s, k] <= keys[s, k + 1] for s, k in keys if (s, k + 1) in keys)


@pytest.mark.parametrize("hot", [0, 3000])
def test_shards_are_equal(spark, hot):
    """Also with a group of copies over a third of all bytes."""
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < hot, F.lit("copy" * 9)).otherwise(F.concat(F.lit("text"), F.col("id").cast("string"), F.repeat(F.lit("z"), (F.col("id") % 60).cast("int")))).alias("text"))
    sizes = [r.b for r in sharding.place(df).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) < 0.02 * sum(sizes) / 16 + 130


def test_toxicity(spark):
    rnd = random.Random(2)
    clean = ["tree", "house", "river", "cloud", "stone", "grass", "light", "table", "paper", "glass"]
    data, marks = [], []
    for i in range(1500):
        toxic = i % 7 == 0
        words = [rnd.choice(clean) + str(rnd.randrange(30)) for _ in range(60)]
        if toxic:
            words[rnd.randrange(60)] = rnd.choice(["vile,", "Nasty", "awful."])
        data.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame([*data, (9001, ""), (9002, None), (None, "vile")], "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(data) + 3 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in [*range(1500), 9001, 9002] if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r.predicted == int(r.doc_id % 7 == 0) for r in held if r.doc_id < 9000]
    assert sum(right) > 0.98 * len(right)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.classify(docs, flipped).collect()  # held-out labels are never used
    assert all(math.isclose(a.score, b.score, abs_tol=1e-6) for a, b in zip(sorted(got, key=str), sorted(again, key=str), strict=True))


def test_line_dedup(docs, rows):
    got = linededup.report(docs).collect()
    want = brute.dropped_lines(rows)
    assert len(got) >= len(rows)
    assert {r.doc_id: (r.n_lines, r.dropped) for r in got} == want


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_of_random_lines(spark, seed):
    """Few words, so that lines repeat words and deletions coincide."""
    rnd = random.Random(seed)
    texts = [(i, "\n".join(" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 6))) for _ in range(rnd.randint(1, 8)))) for i in range(40)]
    got = linededup.report(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), min_words=4, min_chars=4).collect()
    assert {r.doc_id: (r.n_lines, r.dropped) for r in got} == brute.dropped_lines(texts, 4, 4)


@pytest.mark.parametrize("seed", range(3))
def test_short_lines_differ_by_one_character(spark, seed):
    """Few letters of one to four bytes, so that characters repeat and deletions coincide."""
    rnd = random.Random(seed)
    texts = [(i, "\n".join("".join(rnd.choice("aBé日🙂 ") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 9)))) for i in range(60)]
    got = linededup.report(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), min_words=7, min_chars=5).collect()
    assert {r.doc_id: (r.n_lines, r.dropped) for r in got} == brute.dropped_lines(texts, 7, 5)


SHARED_IDS = [
    ([(0, "d e f"), (1, "a b c\nd e f"), (1, "g h i\nq w e")], [(0, "d e f"), (1, "a b c"), (1, "g h i\nq w e")]),
    ([(None, "q q\nx y z"), (None, "a b\nonly here"), (3, "only here\nx y z\nnew")], [(None, "q q\nx y z"), (None, "a b\nonly here"), (3, "new")]),
    ([(4, "same\nrow"), (4, "same\nrow"), (5, "row\nother")], [(4, "same\nrow"), (4, "same\nrow"), (5, "other")]),
    ([(None, "same\nrow"), (None, "same\nrow"), (None, None)], [(None, "same\nrow"), (None, "same\nrow"), (None, None)]),
]


@pytest.mark.parametrize("texts, left", SHARED_IDS, ids=["repeated id", "no ids", "equal rows", "equal rows without ids"])
def test_lines_of_rows_that_share_an_id(spark, texts, left):
    """Rows with one id are documents of their own; equal rows give equal results."""
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    assert Counter(map(tuple, linededup.drop_lines(df).collect())) == Counter(left)
    lines = Counter((r.doc_id, r.n_lines - r.n_dropped) for r in linededup.report(df).collect())
    assert lines == Counter((i, len(t.split("\n")) if t else 0) for i, t in left)


def test_no_line_is_lost(spark):
    """Of every kind of line one is left, whatever ids its rows have."""
    rnd = random.Random(4)
    texts = [(rnd.choice([None, 1, 2, 3]), "\n".join(rnd.choice("abcdefghij") * 3 for _ in range(rnd.randint(1, 6)))) for _ in range(40)]
    kept = linededup.drop_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {x for _, t in texts for x in t.split("\n")} == {x for r in kept for x in r.text.split("\n")}


def test_drop_lines(docs, rows):
    got = linededup.drop_lines(docs)
    assert got.columns == docs.columns
    want, seen = brute.dropped_lines(rows), set()
    for r in got.collect():
        seen.add(r.doc_id)
        text, (_, gone) = dict(rows)[r.doc_id], want[r.doc_id]
        assert r.text == (text if text is None or not gone else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone))
    lost = {i for i, (n, gone) in want.items() if n and len(gone) == n}
    assert seen == {i for i, _ in rows} - lost


def test_neighbours(spark):
    rnd = np.random.default_rng(3)
    vectors = rnd.standard_normal((2000, 24)).astype("float32").round(1).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)] + [(2000, vectors[50]), (2050, None), (2100, [0.0] * 24), (2150, [float("nan")] * 24), (2200, [1.0] * 23 + [float("inf")]), (2250, [None] * 24), (2300, [1.0]), (None, vectors[1])]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).collect()
    m = np.array([*vectors, vectors[50]], np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    found = brute.by_id(got, "query_id")
    assert set(found) == set(range(0, 2001, 50))
    hits = 0
    for q, own in found.items():
        cos = m @ m[q]
        cos[q] = -9
        best = np.lexsort((np.arange(len(m)), -cos.round(12)))[:5]
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and all(abs(r.score - cos[r.vec_id]) < 1e-9 for r in own)
        hits += len({r.vec_id for r in own} & set(best.tolist()))
    assert hits >= 0.95 * 5 * len(found)


def test_few_neighbours(spark):
    one = spark.createDataFrame([(50, [1.0, 2.0]), (1, [2.0, 4.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in neighbours.search(one, F.col("vec_id") % 50 == 0).orderBy("rank").collect()] == [(50, 1, 1), (50, 2, 2)]
    assert neighbours.search(one.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_byte_bpe(docs, rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, text in rows:
        ids = coder.encode_ordinary(text or "")
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, bpe.encode_documents(docs, group_bytes=3000, buckets=7).collect())) == want


def test_byte_bpe_gives_ids_and_decodes_given_ones(spark, docs, rows, monkeypatch):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((i, tuple(coder.encode_ordinary(text or ""))) for i, text in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in bpe.encode(docs, group_bytes=3000).collect()) == want
    monkeypatch.setattr(bpe, "DECODE_IDS", 50)
    texts = [(i, text) for i, text in rows if text] + [(None, "a b"), (7, "")]
    stored = spark.createDataFrame([(i, coder.encode_ordinary(t)) for i, t in texts] + [(8, None)], "doc_id long, ids array<int>")
    assert Counter((r.doc_id, r.bytes and bytes(r.bytes)) for r in bpe.decode(stored).collect()) == Counter([(i, t.encode()) for i, t in texts] + [(8, None)])


@pytest.mark.parametrize("doc_id", [None, 5])
def test_byte_bpe_deals_equal_ids_to_groups(spark, doc_id):
    df = spark.createDataFrame([(doc_id, f"text {k:04}") for k in range(200)], "doc_id long, text string")
    sizes = [r["count"] for r in bpe._grouped(df, 160).groupBy("grp").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 50 and sum(sizes) == 200
    assert {r.n_tokens for r in bpe.encode_documents(df, group_bytes=160).collect()} and bpe.encode(df, group_bytes=160).count() == 200


def test_byte_bpe_groups_by_bytes(spark):
    """Long texts make small groups: no group holds much more than its bytes, one text aside."""
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), F.when(F.col("id") % 100 == 7, 5000).otherwise(10).cast("int")).alias("text"))
    own = bpe._grouped(df, 4000).groupBy("grp").agg(F.sum(F.length("text")).alias("b"), F.max(F.length("text")).alias("one")).collect()
    assert all(r.b <= 3 * 4000 + r.one for r in own) and len(own) > 5


def test_quality(docs, rows):
    texts = dict(rows)
    got = quality.judge(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:7] == brute.quality(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_shouting_in_other_scripts(spark):
    """One acronym in a text of another script is no shouting; capitals of other scripts are."""
    def text(words):
        return " ".join(f"{w}{chr(ord(w[-1]) + k % 5)}{chr(ord(w[-1]) + k // 5 % 7)}{chr(ord(w[-1]) + k // 35)}" for k in range(60) for w in words)

    kept = [text(["река", "дом"]) + " NATO", text(["ποταμ", "σπιθ"]) + " NATO", text(["नदक"]) + " NATO", text(["שלא"]) + " NATO", text(["강가"]) + " NATO", text(["river", "house"]) + " NATO"]
    loud = [text(["РЕКА", "ДОВ"]), text(["ΑΒΓ", "ΔΓ"]), text(["RIVER", "HOUSE"])]
    got = quality.judge(spark.createDataFrame(list(enumerate(kept + loud)), "doc_id long, text string")).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if r.kept} == set(range(len(kept)))


def test_cascade_order_changes_nothing(docs):
    rules = dict(list(quality.RULES.items())[::-1])
    def verdict(**options):
        return sorted(((r.doc_id, r.kept) for r in quality.judge(docs, **options).collect()), key=str)

    assert verdict() == verdict(rules=rules, sample_rows=1)
    kept = quality.keep(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in verdict() if k)


def test_packing(docs, rows, words):
    got = packing.pack(docs, seq_len=256, group_tokens=3000).collect()
    pieces, sequences, copies = brute.by_id(got), brute.by_id(got, "sequence_id"), Counter(i for i, _ in rows)
    for i, text in set(rows):
        ids = [*words(text), 2]
        own = sorted(pieces[i], key=lambda r: r.start)
        assert sum(r.length for r in own) == copies[i] * len(ids) and all(r.doc_tokens == len(ids) and r.ids_crc32 == brute.crc(ids[r.start : r.start + r.length]) for r in own)
        assert Counter(p for r in own for p in range(r.start, r.start + r.length)) == Counter({p: copies[i] for p in range(len(ids))})
    for own in sequences.values():
        end = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 256
    total = sum(r.length for r in got)
    assert len(sequences) == -(-total // 256)


def test_padding_does_not_depend_on_partitions(spark, data):
    """Tails of 200 tasks are packed together."""
    docs = spark.read.parquet(f"{data}/documents.parquet").repartition(200)
    got = packing.pack(docs, tails_together=64).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"), F.countDistinct("offset").alias("k"), F.count("*").alias("c")).collect()
    assert all(r.n == r.end <= 4096 and r.k == r.c for r in got)
    total = sum(r.n for r in got)
    assert len(got) * 4096 < 1.02 * total + 4 * 4096


def test_packed_sequences_hold_ids(docs, rows, words, monkeypatch):
    """The ids of the pieces, put together by sequence and by document, are those of the texts."""
    monkeypatch.setattr(packing, "BATCH_IDS", 700)
    got, copies = packing.pack(docs, seq_len=256, group_tokens=3000).collect(), Counter(i for i, _ in rows)
    assert all(len(r.ids) == r.length and brute.crc(r.ids) == r.ids_crc32 for r in got)
    pieces = brute.by_id(got)
    for i, text in set(rows):
        ids = [*words(text), 2]
        assert all(r.ids == ids[r.start : r.start + r.length] for r in pieces[i])
        assert sum(len(r.ids) for r in pieces[i]) == copies[i] * len(ids)


def test_balance():
    lengths = np.random.default_rng(1).integers(1, 900, 500)
    cost, used = Counter(), Counter()
    for _, _, n, k, _ in packing.balance(lengths, 1024, 1.0, 1 / 512):
        cost[k] += n + n * n / 512
        used[k] += n
    assert len(used) == -(-lengths.sum() // 1024) and max(cost.values()) < 1.7 * min(cost.values())


TABLES = [
    ("near duplicates", minhash.near_duplicates), ("one of each", minhash.one_of_each), ("token ids", tokenids.round_trip), ("repeats", suffixes.digest), ("without repeats", suffixes.without_repeats),
    ("sharding", sharding.place), ("lines", linededup.report), ("drop lines", linededup.drop_lines), ("bpe", bpe.encode_documents), ("quality", quality.judge), ("keep", quality.keep), ("packing", packing.pack),
]


@pytest.mark.parametrize("name, operator", TABLES, ids=[x[0] for x in TABLES])
def test_empty_tables_and_nulls(empty, no_ids, name, operator):
    assert operator(empty).count() == 0
    few = operator(no_ids).collect()
    assert len(few) == 3 or name in ("keep", "drop lines", "packing", "without repeats")


def test_toxicity_without_labels(docs, spark, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.classify(docs, none).collect()} == {0.0}
    assert toxicity.classify(empty, none).count() == 0
