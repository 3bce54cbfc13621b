"""The corpus pipeline on awkward documents: what each stage keeps, against plain versions."""

import brute
import corpus_pipeline

import __spark_entry__ as entry_points
from tickloom.llm.common import saved


def test_stages(spark, docs, data):
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in now.collect()]
        out = saved(stage(spark, now, data), "stage")
        got = out.collect()
        if name != "packing":
            assert out.columns == docs.columns and all(r.n_chars == len(r.text or "") for r in got)
        if name == "quality rules":
            assert {r.doc_id for r in got} <= {i for i, t in before if not brute.quality(t)[5]} and got
        if name == "line dedup":
            gone = brute.dropped_lines(before)
            assert {r.doc_id for r in got} == {i for i, (n, d) in gone.items() if len(d) < n or not n}
        if name == "near dedup":
            assert {r.doc_id for r in got} == {i for i, x in brute.near_duplicates(before, 5).items() if x[2]}
        if name == "packing":
            assert {r.doc_id for r in got} == {i for i, _ in before}
        now = out


def test_whole_pipeline(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0


def test_registered():
    names = set(entry_points.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
