"""Scalars, quality reports, run logs, training helpers."""

import json
from datetime import datetime

import pytest
from helpers import START, bar_rows, frame, walk
from pyspark.sql import functions as F

from tickloom.functions import scalars as S
from tickloom.operators import quality, runlog, training
from tickloom.operators.series import with_row_index
from tickloom.session import cut_lineage


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("hour, kind", [(8, 0), (9, 1), (10, 2), (14, 2), (15, 3), (16, 0), (23, 0)])
def test_session_type(spark, hour, kind):
    ts = F.lit(datetime(2024, 3, 4, hour, 59)).cast("timestamp_ntz")
    assert one(spark, S.session_type(ts)) == kind
    assert one(spark, S.in_market_hours(ts)) == (9 <= hour <= 16)


def test_scalars(spark):
    ts = F.lit(datetime(2024, 3, 10, 2, 30, 59, 999999)).cast("timestamp_ntz")
    assert one(spark, S.minute_bucket(ts)) == datetime(2024, 3, 10, 2, 30)
    assert one(spark, S.hour_bucket(ts)) == datetime(2024, 3, 10, 2)
    assert one(spark, S.day_of_week(ts)) == 7
    assert one(spark, S.exchange_time(ts)) == datetime(2024, 3, 9, 21, 30, 59, 999999)
    assert one(spark, S.to_double(F.lit(" 1.5 "))) == 1.5 and one(spark, S.to_double(F.lit("x"))) is None
    assert one(spark, S.to_timestamp(F.lit("soon"))) is None
    assert one(spark, S.flag(F.lit(None).cast("boolean"))) == 0
    assert one(spark, S.clip(F.lit(None).cast("double"), 1.0)) is None
    assert S.clean_header("  adj close ") == "Adjclose"
    assert one(spark, S.run_day_prefix("SIGNAL_", F.lit(datetime(2024, 1, 31)).cast("timestamp_ntz"))) == "SIGNAL_20240131"


def test_time_does_not_depend_on_the_session_zone(spark):
    """Wall clocks that a zone skips or repeats stay what they are."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        bars = frame(spark, bar_rows("A", range(240), start=datetime(2024, 3, 10, 0, 0)))
        minutes = bars.select(S.minute_bucket(F.col("PriceTimestamp")).alias("m")).distinct().count()
        assert minutes == 240
        assert with_row_index(bars).orderBy("PriceTimestamp").select("rn").toPandas().rn.tolist() == list(range(240))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quality(spark):
    rows = bar_rows("A", [1, 0, 3]) + bar_rows("A", [1]) + [("B", START, None, 1.0, -1.0, 2.0, -5)]
    bars = frame(spark, rows)
    assert quality.duplicate_keys(bars, ["Symbol", "PriceTimestamp"], "t").collect() == [("t", "A", START, 2)]
    assert quality.range_violations(bars).first().asDict() == {"BadOpen": 1, "BadHigh": 0, "BadLow": 4, "BadClose": 1, "BadVolume": 1}
    assert dict(quality.null_counts(bars, ["OpenPrice", "Volume"]).collect()) == {"OpenPrice": 1, "Volume": 0}
    assert quality.row_count(bars, 6).first() == (5, False)
    assert quality.duplicate_rows(bars).count() == 2
    report = {r.check: (r.ok, r.details) for r in quality.quality_report(bars, bars.where("Symbol = 'B'"), 5).collect()}
    assert report["nulls_raw_bars"] == (False, "1 NULLs") and report["row_count_raw_bars"][0]
    assert report["duplicates_raw_bars"] == (False, "1 duplicate keys") and report["orphans_indicators"][0]
    assert not report["ranges_raw_bars"][0] and report["columns_raw_bars"] == (True, "all present")
    lacking = {r.check: r.details for r in quality.quality_report(bars.drop("BatchID"), None, required=["Symbol", "Nope"]).collect()}
    assert lacking["columns_raw_bars"] == "Nope" and lacking["table_exists_indicators"] == "missing"
    lost = {r.check: r.ok for r in quality.quality_report(None, bars.where("Symbol = 'B'")).collect()}
    assert lost.pop("table_exists_indicators") and len(lost) == 7 and not any(lost.values())
    clean = {r.check: r.ok for r in quality.quality_report(frame(spark), frame(spark)).collect()}
    assert clean["nulls_raw_bars"] and not clean["row_count_raw_bars"]


def test_newest_first(spark):
    report = quality.newest_first(quality.rows_per_day_symbol(frame(spark, bar_rows("B", [1, 2], step=1440), bar_rows("A", [1]))))
    assert [(str(r.TradeDate), r.Symbol) for r in report.collect()] == [("2024-03-05", "B"), ("2024-03-04", "A"), ("2024-03-04", "B")]


LOG = """\
2024-01-08 19:36:05 [INFO] MASTER ORCHESTRATOR STARTED
2024-01-08 19:36:06 [INFO] === Processing AAPL (Backfill=7 days) ===
2024-01-08 19:36:09 [INFO] AAPL: Ingestion completed in 2.50 seconds.
2024-01-08 19:36:09 [INFO] X: Ingestion completed in 9.99 seconds.
2024-01-08 19:36:10 [INFO] === Processing MSFT (Backfill=7 days) ===
2024-01-08 19:36:11 [INFO] === Processing IBM (Backfill=7 days) ===
2024-01-08 19:36:12 [INFO] IBM: Ingestion completed in 1.25 seconds.
2024-01-08 19:36:13 [INFO] Total symbols processed: 3
2024-01-08 19:36:13 [INFO] Total rows inserted:     1200
2024-01-08 19:36:13 [INFO] === INGESTION COMPLETED in 8.00 seconds ===
2024-01-08 19:36:14 [INFO] Inserted 1,100 new rows into tblRawPrices.
2024-01-08 19:36:14 [INFO] Total rows in RawPrices after merge: 32149
2024-01-08 19:36:15 [INFO] === MERGE COMPLETED in 1.50 seconds ===
2024-01-08 19:36:15 [INFO] Loaded 31049 price rows.
2024-01-08 19:36:16 [INFO] Starting indicator SMA (IndicatorId=1, param=20)
2024-01-08 19:36:16 [INFO] Starting indicator EMA (IndicatorId=2, param=20)
2024-01-08 19:36:17 [INFO] Completed indicator EMA with 10 rows in 0.50 seconds.
2024-01-08 19:36:18 [INFO] Completed indicator SMA with 10 rows in 1.00 seconds.
2024-01-08 19:36:19 [INFO] Completed indicator SMA with 10 rows in 2.04 seconds.
2024-01-08 19:36:20 [INFO] Total computed indicator rows: 30
2024-01-08 19:36:21 [INFO] Insert step completed in 3.25 seconds.
2024-01-08 19:36:22 [INFO] === MASTER RUN COMPLETED in 6.00 seconds ===
2024-01-08 19:36:30 [INFO] Merged dataset: 32,149 rows, 48 columns.
2024-01-08 19:36:31 [INFO] Loading rows, Insert step completed in 9.00 seconds. tblMergedFeatures
2024-01-08 19:37:05 [INFO] Completed: merge_feature.py
"""


@pytest.fixture(params=[128, 1 << 20], ids=["split", "whole"])
def logs(spark, tmp_path, request):
    """The log read as one piece and in splits of a few lines."""
    (tmp_path / "run1.txt").write_text(LOG)
    (tmp_path / "run2.txt").write_text("no marker here\n2024-01-08 19:36:05 [INFO] Total rows inserted: 7\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield cut_lineage(runlog.read_logs(spark, str(tmp_path)).withColumn("run", F.regexp_extract("run", r"(run\d)", 1)))
    for k, v in old.items():
        spark.conf.set(k, v)


def test_run_log(logs):
    stages = {r.run: r for r in runlog.stage_metrics(logs).collect()}
    first = stages["run1"].asDict()
    assert first == {
        "run": "run1", "ingest_rows": 1200, "ingest_symbols": 3, "ingest_runtime": 8.0, "merge_rows": 1100, "merge_runtime": 1.5,
        "indicator_rows": 30, "indicator_runtime": 6.0, "feature_rows": 32149, "feature_runtime": 3.25, "raw_before": 31049,
        "raw_after": 32149, "total_runtime": 60,
    }
    assert stages["run2"].ingest_rows == 7 and stages["run2"].merge_runtime is None
    assert dict((r.Symbol, r.duration) for r in runlog.symbol_durations(logs, 2).collect()) == {"AAPL": 2.5, "MSFT": None, "IBM": 1.25}
    assert {(r.IndicatorName, r.runs, r.avg_seconds) for r in runlog.indicator_runtimes(logs).collect()} == {("EMA", 1, 0.5), ("SMA", 2, 1.52)}
    parsed = runlog.parse_lines(logs).where("value LIKE '%Inserted 1,100%'").first()
    assert (parsed.ts, parsed.last_int, parsed.last_float) == (datetime(2024, 1, 8, 19, 36, 14), 1100, None)


def test_feature_sets(spark):
    def sets(*rows):
        return spark.createDataFrame(rows, "FeatureSetID int, IsActive int")

    members = spark.createDataFrame([(2, "b", 2), (2, "a", 1), (1, "c", 1)], "FeatureSetID int, FeatureName string, Ordinal int")
    assert training.active_feature_set(sets((1, 0), (2, 1))) == 2
    assert training.feature_list(sets((1, 0), (2, 1)), members) == ["a", "b"]
    with pytest.raises(ValueError, match="no active"):
        training.active_feature_set(sets((1, 0)))
    with pytest.raises(ValueError, match="more than one"):
        training.active_feature_set(sets((1, 1), (2, 1)))
    with pytest.raises(ValueError, match="none of"):
        training.select_features(members, ["zzz"])
    df = spark.createDataFrame([(1, 2.0, 3, "x", 1)], "Label int, RSI double, FutureClose_tN int, s string, n int")
    assert training.automatic_features(df) == ["RSI", "n"]


@pytest.mark.parametrize("order", ["time", "symbol"])
def test_split(spark, order):
    df = frame(spark, bar_rows("B", range(7)), bar_rows("A", range(4), step=2000), bar_rows("C", range(10), step=3))
    out = training.ordered_split(df, 0.8, order).toPandas()
    keys = ["PriceTimestamp", "Symbol"] if order == "time" else ["Symbol", "PriceTimestamp"]
    out = out.sort_values(keys).reset_index(drop=True)
    assert out.position.tolist() == list(range(21)) and out.is_train.sum() == 16 and out.is_train[:16].all()


def test_classes_that_are_only_predicted(spark):
    """They count in the report (with recall 0) and have a row in the matrix."""
    scored = spark.createDataFrame([(-1, -1), (-1, 0), (1, 1), (1, 1)], "Label int, Prediction int")
    report = {r["class"]: r for r in training.classification_report(scored).collect()}
    assert report["accuracy"].precision is None and report["accuracy"].f1 == pytest.approx(scored.agg(training.accuracy()).first()[0])
    assert report["0"].support == 0 and report["macro avg"].recall == pytest.approx(0.5)
    matrix = {r.Label: (r["pred_-1"], r.pred_0, r.pred_1) for r in training.confusion_matrix(scored).collect()}
    assert matrix == {-1: (1, 1, 0), 0: (0, 0, 0), 1: (0, 0, 2)}


def test_feature_without_values(spark):
    rows = spark.createDataFrame([("A", i % 3 - 1, float(i % 3), None) for i in range(60)], "Symbol string, Label int, x double, y double")
    model = training.fit(rows, ["x", "y"], training.TrainSettings(rounds=2, depth=2))
    assert training.predict(model, rows, ["x", "y"]).where("Label = Prediction").count() == 60


def test_report_and_json(spark):
    pairs = [(1, 1), (1, 1), (1, -1), (-1, -1), (0, 1), (0, 0)]
    scored = spark.createDataFrame(pairs, "Label int, Prediction int")
    report = {r["class"]: r for r in training.classification_report(scored).collect()}
    assert report["1"].precision == pytest.approx(2 / 3) and report["1"].recall == pytest.approx(2 / 3) and report["1"].support == 3
    assert report["-1"].precision == 0.5 and report["0"].recall == 0.5
    assert report["macro avg"].precision == pytest.approx((2 / 3 + 0.5 + 1) / 3) and report["weighted avg"].support == 6
    matrix = {r.Label: (r.pred_m1 if "pred_m1" in r.asDict() else r["pred_-1"], r.pred_0, r.pred_1) for r in training.confusion_matrix(scored).collect()}
    assert matrix == {1: (1, 0, 2), -1: (1, 0, 0), 0: (0, 1, 1)}
    weights = {r.Label: r.weight for r in training.class_weights(scored).collect()}
    assert weights == {1: pytest.approx(6 / 9), -1: pytest.approx(2.0), 0: pytest.approx(1.0)}
    payload = json.loads(training.metrics_json(scored, scored).first().MetricsJson)
    assert payload["training_accuracy"] == payload["test_accuracy"] == pytest.approx(4 / 6)
    assert len(payload["confusion_matrix"]) == 3 and len(payload["classification_report"]) == 6


def test_permuted_is_a_permutation_and_repeatable(spark):
    df = frame(spark, walk("A", 120, 1), walk("B", 30, 2)).select("Symbol", "PriceTimestamp", "ClosePrice")
    once, again = (training.permuted(df, ["ClosePrice"], 2, 42).toPandas() for _ in range(2))
    key = ["_repeat", "Symbol", "PriceTimestamp"]
    assert once.sort_values(key).ClosePrice__other.tolist() == again.sort_values(key).ClosePrice__other.tolist()
    for repeat in (0, 1):
        part = once[once._repeat == repeat]
        assert sorted(part.ClosePrice) == sorted(part.ClosePrice__other) and len(part) == 150
        assert (part.ClosePrice != part.ClosePrice__other).mean() > 0.8


def test_importance_finds_the_feature_that_decides(spark):
    df = frame(spark, walk("A", 400, 1)).withColumns({
        "good": F.rand(1), "noise": F.rand(2), "Label": F.when(F.rand(1) > 0.5, 1).otherwise(-1)})
    df = cut_lineage(df.select("Symbol", "PriceTimestamp", "good", "noise", "Label"))
    model = training.fit(df, ["good", "noise"], training.TrainSettings(rounds=1, depth=1))
    ranked = training.permutation_importance(model, df, ["good", "noise"], repeats=3).collect()
    assert ranked[0].Feature == "good" and ranked[0].Importance > 0.3 and abs(ranked[1].Importance) < 0.05


def test_naive_times_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    moment = datetime(2024, 3, 10, 2, 30, 1, 5)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one(spark, S.naive(moment)) == moment
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quality_report_without_tables(spark):
    rows = quality.quality_report(None, None).collect()
    assert len(rows) == 8 and not any(r.ok for r in rows)
