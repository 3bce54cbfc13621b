"""Staging merge, vendor files, sinks, cutoffs."""

from datetime import datetime, timedelta

import pytest
from helpers import START, bar_rows, collect, frame, walk
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.functions import rolling
from tickloom.operators import incremental, labels, registry, signals, staging
from tickloom.operators.engineered import add_engineered_features
from tickloom.operators.merged import merge_indicators, pivot_last, with_calendar
from tickloom.schemas import BAR_COLUMNS, DEFINITIONS, INDICATOR_FIELDS, INDICATORS, RAW_BARS, SIGNAL_METRICS, STAGING
from tickloom.sources import sinks, tables, vendor

LOADED = datetime(2024, 3, 4, 18, 0)


def staged(spark, *rows):
    """(symbol, seconds after START, close, batch, load minute, exported)"""
    return spark.createDataFrame(
        [(s, START + timedelta(seconds=t), c, c, c, c, 10, b, LOADED + timedelta(minutes=m), e) for s, t, c, b, m, e in rows], STAGING)


def test_dedup_takes_the_latest_load_and_breaks_ties(spark):
    rows = staged(
        spark,
        ("A", 0, 1.0, "B1", 0, 0), ("A", 30, 2.0, "B2", 5, 0), ("A", 10, 3.0, "B1", 1, 0),
        ("B", 0, 1.0, "B1", 0, 0), ("B", 59, 2.0, "B1", 0, 0), ("B", 20, 9.0, "B0", 0, 0),
        ("C", 0, 1.0, "B1", 0, 1), ("D", -3600, 1.0, "B1", 0, 0),
    )
    out = {r.Symbol: (r.PriceTimestamp, r.ClosePrice) for r in staging.stage_dedup(rows).collect()}
    assert out == {"A": (START, 2.0), "B": (START, 2.0)}


def test_merge_inserts_only_unknown_minutes_and_is_idempotent(spark):
    raw = spark.createDataFrame([("A", START + timedelta(seconds=20), 5.0, 5.0, 5.0, 5.0, 1, "B0", LOADED)], RAW_BARS)
    pending = staged(spark, ("A", 0, 1.0, "B1", 0, 0), ("A", 60, 2.0, "B1", 0, 0), ("B", 60, 2.0, "B1", 0, 0), ("B", 61, 3.0, "B1", 0, 0))
    result = staging.merge_staging(pending, raw)
    assert sorted((r.Symbol, r.ClosePrice) for r in result.inserted.collect()) == [("A", 2.0), ("B", 3.0)]
    assert sorted((r.Symbol, r.PriceTimestamp, r.ClosePrice) for r in result.raw.collect()) == [
        ("A", START, 5.0), ("A", START + timedelta(minutes=1), 2.0), ("B", START + timedelta(minutes=1), 3.0)]
    assert result.staging.where("Exported = 0").count() == 0
    summary = {r.Symbol: (r.PendingRows, r.RowsBefore, r.InsertedRows, r.RowsAfter) for r in result.summary.collect()}
    assert summary == {"A": (2, 1, 1, 2), "B": (2, 0, 1, 1)}
    again = staging.merge_staging(pending, result.raw)
    assert again.inserted.count() == 0 and again.raw.count() == 3


def test_nothing_pending(spark):
    raw = spark.createDataFrame([], RAW_BARS)
    result = staging.merge_staging(staged(spark, ("A", 0, 1.0, "B1", 0, 1)), raw)
    assert result.inserted.count() == 0 and result.raw.count() == 0


def test_market_hours_include_the_whole_last_hour(spark):
    late = staged(spark, ("A", 7 * 3600 + 59 * 60, 1.0, "B1", 0, 0))
    staging.require_market_hours(late)
    with pytest.raises(staging.MarketHoursError, match="1 pending"):
        staging.require_market_hours(staged(spark, ("A", 8 * 3600, 1.0, "B1", 0, 0)))


def test_vendor_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "symbol, Datetime ,open,HIGH,low,Close,Adj Close,Volume\n"
        "AAA,2024-07-01 13:30:05,1,2,0.5,1.5,1.5,10\n"
        "AAA,2024-07-01 13:30:55,2,3,0.5,2.5,2.5,20\n"
        "AAA,2024-12-02 14:31:00,n/a,3,0.5,2.5,2.5,\n")
    first, last = vendor.read_vendor(spark, str(tmp_path)).orderBy("PriceTimestamp").collect()
    assert (first.PriceTimestamp, first.ClosePrice, first.Volume) == (datetime(2024, 7, 1, 9, 30), 2.5, 20)
    assert (last.PriceTimestamp, last.OpenPrice, last.Volume) == (datetime(2024, 12, 2, 9, 31), None, None)


def test_symbol_days(spark):
    raw = spark.createDataFrame([("A", "30d"), ("B", ""), ("C", "max"), ("D", " 5 "), ("E", None)], "Symbol string, Days string")
    assert {r.Symbol: r.Days for r in vendor.symbol_days(raw).collect()} == {"A": 30, "B": 7, "C": 7, "D": 5, "E": 7}


def test_symbol_file(spark, tmp_path):
    (tmp_path / "symbols.csv").write_text("Symbol,Days\nAAA,30 d\nBBB,\n")
    assert dict(vendor.read_symbols(spark, str(tmp_path)).collect()) == {"AAA": 30, "BBB": 7}


def test_definition_parameters(spark):
    rows = [(1, "OBV", None, 1), (2, "ROC", "", 1), (3, "SMA", "2", 1), (4, "EMA", "2", 0)]
    definitions = spark.createDataFrame(rows, DEFINITIONS)
    assert registry.field_names(definitions) == ["OBV_0", "ROC_12", "SMA_2"]
    long = registry.indicator_long(frame(spark, walk("A", 13, 1)), definitions, added=LOADED)
    assert {r.FieldName: r["count"] for r in long.groupBy("FieldName").count().collect()} == {"OBV_0": 13, "ROC_12": 1, "SMA_2": 12}
    assert long.schema.fieldNames() == INDICATORS.fieldNames()
    with pytest.raises(ValueError, match="needs a parameter"):
        registry.parameter("SMA", "")


def test_rolling_helpers(spark):
    w = Window.partitionBy("Symbol").orderBy("PriceTimestamp")
    close = F.col("ClosePrice")
    df = frame(spark, bar_rows("A", [1, 2, 4, 4, 0, 6])).select(
        rolling.diff(close, 1, w), rolling.cumulative(close, w), rolling.pct_change(close, 1, w),
        rolling.percent_rank_last(close, 3, w), rolling.zscore_last(close, 2, w))
    moved, total, change, rank, score = zip(*df.collect())
    assert moved == (None, 1, 2, 0, -4, 6) and total == (1, 3, 7, 11, 11, 17)
    assert change == (None, 1, 1, 0, -1, None)
    assert rank[:2] == (None, None) and [round(x * 3, 9) for x in rank[2:]] == [3, 2.5, 1, 3]
    assert score[0] is None and score[1] == pytest.approx(0.5 / 0.5 ** 0.5, rel=1e-6) and score[3] == 0


@pytest.mark.parametrize("agg, n", [("sum", 64), ("avg", 67), ("min", 100), ("max", 131)])
def test_long_frames_equal_plain_ones(spark, agg, n):
    rows = walk("A", 300, 4)
    rows[150] = (*rows[150][:5], None, rows[150][6])
    w = Window.partitionBy("Symbol").orderBy("PriceTimestamp")
    df = frame(spark, rows)
    parts = df.withColumns(rolling.long_parts(agg, "ClosePrice", n, w))
    fn = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[agg]
    out = parts.select(rolling.long_roll(agg, "ClosePrice", n, w).alias("a"), rolling.roll(fn, F.col("ClosePrice"), n, w).alias("b")).toPandas()
    assert out.a.isna().equals(out.b.isna()) and (out.a - out.b).abs().max() < 1e-9 and out.a.notna().any()


def test_backfill_window(spark):
    bars = frame(spark, bar_rows("OLD", range(10), step=720), bar_rows("NEW", range(10), step=720), bar_rows("OUT", range(3)))
    symbols = spark.createDataFrame([("OLD", 3), ("NEW", 3)], "Symbol string, Days int")
    exported = spark.createDataFrame([("OLD", START)], "Symbol string, LastTs timestamp_ntz")
    counts = {r.Symbol: r["count"] for r in vendor.backfill_window(bars, symbols, exported).groupBy("Symbol").count().collect()}
    assert counts == {"OLD": 3, "NEW": 7}


def test_cutoffs(spark):
    stored = frame(spark, bar_rows("A", [1, 2, 3]))
    fresh = frame(spark, bar_rows("A", range(5)), bar_rows("B", range(4)))
    assert incremental.newer_rows(fresh, stored).groupBy("Symbol").count().orderBy("Symbol").collect() == [("A", 2), ("B", 4)]
    assert incremental.newer_rows(fresh, stored, per_symbol=False).groupBy("Symbol").count().orderBy("Symbol").collect() == [("A", 2), ("B", 1)]
    assert incremental.newer_rows(fresh, stored.limit(0), per_symbol=False).count() == 9


def test_date_range_is_half_open(spark):
    bars = frame(spark, bar_rows("A", range(5)))
    assert tables.in_date_range(bars, START, START + timedelta(minutes=2)).count() == 2


def test_signals_do_not_depend_on_blocks_or_on_the_run(spark):
    bars = with_calendar(frame(spark, walk("A", 150, 1), walk("B", 40, 2)).withColumns(
        {**{c: F.lit(None).cast("double") for c in INDICATOR_FIELDS}, "SourceIndicatorCount": F.lit(0), "MissingIndicatorCount": F.lit(19)}))
    full = signals.signal_frame(bars, "R", LOADED)
    small = signals.signal_frame(bars, "R", LOADED, block_rows=32)
    key = ["Symbol", "FeatureTimestamp"]
    a, b = (df.toPandas().sort_values(key).reset_index(drop=True) for df in (full, small))
    for name in [*SIGNAL_METRICS, "Target"]:
        assert (a[name].round(9).fillna(-9) == b[name].round(9).fillna(-9)).all(), name
    assert a[a.Symbol == "A"].Target.isna().sum() == 1 and a[a.Symbol == "A"].Return_20.isna().sum() == 20
    stored = full.where(F.col("FeatureTimestamp") < F.lit(START + timedelta(minutes=100)).cast("timestamp_ntz"))
    later = signals.signal_incremental(bars, stored, "R", LOADED).toPandas().sort_values(key).reset_index(drop=True)
    expected = a[(a.FeatureTimestamp >= START + timedelta(minutes=100))].reset_index(drop=True)
    assert len(later) == len(expected) == 50
    for name in [*SIGNAL_METRICS, "Target"]:
        assert (later[name].round(9).fillna(-9) == expected[name].round(9).fillna(-9)).all(), name
    reopened = signals.reopen_last_bars(bars, stored, "R", LOADED).where("Symbol = 'A'").first()
    assert reopened.FeatureTimestamp == START + timedelta(minutes=99) and reopened.Target is not None


def test_labels(spark):
    bars = frame(spark, bar_rows("A", [10, 11, 9, 9, 0, 5]), bar_rows("B", [1, 2], step=2))
    out = collect(labels.label_frame(bars, bars, labels.LabelSpec(1), "R", LOADED))
    assert out[out.Symbol == "A"].Label.tolist() == [1, -1, 0, -1, 0, 0]
    assert out[out.Symbol == "A"].IsTrainableRow.tolist() == [1, 1, 1, 1, 0, 0]
    assert out[out.Symbol == "B"].IsTrainableRow.tolist() == [0, 0]  # the next bar is two minutes away
    doubled = labels.future_close(bars.where("Symbol = 'B'").unionByName(bars.where("Symbol = 'B'")), 2)
    assert doubled.where("FutureClose_tN IS NOT NULL").count() == 4  # duplicates fan out
    with pytest.raises(ValueError, match="ClosePrice"):
        labels.label_frame(bars.drop("ClosePrice"), bars, labels.LabelSpec(), "R", LOADED)


def test_pivot_takes_the_latest_value(spark):
    def row(value, added, id_=1, name="SMA_2"):
        return ("A", START, "1m", id_, "SMA", "2", value, name, added)

    long = spark.createDataFrame([row(1.0, LOADED), row(2.0, LOADED + timedelta(1)), row(None, LOADED + timedelta(2)), row(7.0, LOADED, 2, "EMA_2")], INDICATORS)
    wide = pivot_last(long, ["SMA_2", "EMA_2", "RSI_14"])
    assert wide.collect() == [("A", START, 2.0, 7.0, None)]
    merged = merge_indicators(frame(spark, bar_rows("A", [1, 2])), wide, "R", LOADED).orderBy("PriceTimestamp").collect()
    assert [(r.SourceIndicatorCount, r.MissingIndicatorCount) for r in merged] == [(2, 1), (0, 3)]
    assert merged[0].DayOfWeek == 1 and merged[0].IsRegularSession and not merged[0].IsAfterHours


def test_engineered_edges(spark):
    rows = bar_rows("A", [2.0] * 130, volumes=[5] * 130)
    needs = {c: F.lit(1.0) for c in ("EMA_9", "EMA_20", "SMA_20", "SMA_200", "BBANDS_UPPER_20", "BBANDS_LOWER_20", "WILLIAMS_R_14")}
    df = frame(spark, rows).withColumns({**needs, "EMA_200": F.lit(None).cast("double"), "ATR_14": F.lit(0.0)})
    out = collect(add_engineered_features(df, block_rows=101))
    assert out.Return_t_norm.isna().all() and out.Volatility_regime.isna().all()  # zero range
    assert (out.Trend_regime == 0).all() and (out.Volume_spike == 0).all()
    assert out.Volume_percentile.isna().sum() == 99 and (out.Volume_percentile.dropna() == 0.505).all()
    assert (out.Return_zscore.dropna() == 0).all() and out.Return_zscore.isna().sum() == 49
    with pytest.raises(ValueError, match="normalised"):
        add_engineered_features(df, ["compression"])


def test_upsert(spark):
    target = spark.createDataFrame([("A", START, 1.0, "x"), ("B", START, 2.0, "y")], "Symbol string, PriceTimestamp timestamp_ntz, v double, old string")
    source = spark.createDataFrame([("A", START, 5.0, 1), ("C", START, 6.0, 2)], "Symbol string, PriceTimestamp timestamp_ntz, v double, new int")
    out = sinks.upsert(target, source)
    assert sorted((r.Symbol, r.v, r.old, r.new) for r in out.collect()) == [("A", 5.0, None, 1), ("B", 2.0, "y", None), ("C", 6.0, None, 2)]
    assert sorted(sinks.upsert(out, source).collect()) == sorted(out.collect())


def test_snapshots_switch_by_version(spark, tmp_path):
    root = str(tmp_path / "t")
    sinks.commit_snapshot(spark.range(3), root, 1)
    old = sinks.read_snapshot(spark, root)
    sinks.commit_snapshot(old.unionByName(spark.range(10, 12)), root, 2)
    assert sinks.read_snapshot(spark, root).count() == 5 and old.count() == 3
    spark.range(9).write.parquet(f"{root}/data/version=3")  # a run that died before naming its version
    assert sinks.current_version(spark, root) == 2


def test_append_and_rebuild(spark, tmp_path):
    bars = with_calendar(frame(spark, walk("A", 30, 1)).withColumns(
        {**{c: F.lit("nan") for c in INDICATOR_FIELDS}, "SourceIndicatorCount": F.lit(0), "MissingIndicatorCount": F.lit(19)}))
    frame_ = signals.signal_frame(bars, "R", LOADED)
    path = str(tmp_path / "signals")
    for rebuild, expected in ((False, 30), (False, 60), (True, 30)):
        sinks.append_signals(frame_, path, rebuild)
        assert spark.read.parquet(path).count() == expected
    row = spark.read.parquet(path).first()
    assert row.ATR_14 is None and row.IsRegularSession == 1
    sinks.append_signals(frame_, str(tmp_path / "none"), write=False)
    assert not (tmp_path / "none").exists()


def test_sanitise(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, float("-inf")), (3, float("nan")), (4, 5e307), (5, None)], "id int, x double")
    assert [r.x for r in sinks.sanitise(df, 1e307).orderBy("id").collect()] == [None, None, None, 1e307, None]


def test_introspection(spark):
    report = tables.column_report(spark.createDataFrame([], RAW_BARS), "raw_bars").orderBy("OrdinalPosition").collect()
    assert [(r.ColumnName, r.DataType) for r in report[:2]] == [("Symbol", "string"), ("PriceTimestamp", "timestamp_ntz")]
    assert len(report) == 9
    spark.range(1).createOrReplaceTempView("here")
    assert tables.table_exists(spark, "here") and not tables.table_exists(spark, "nowhere")


def test_scans(spark, tmp_path):
    path = str(tmp_path / "raw")
    frame(spark, walk("A", 5, 1)).withColumns({"BatchID": F.lit("B"), "LoadTimestamp": F.lit(LOADED).cast("timestamp_ntz")}).write.parquet(path)
    assert tables.read_raw_bars(spark, path).columns == BAR_COLUMNS
    assert tables.read_closes(spark, path).columns == ["Symbol", "PriceTimestamp", "ClosePrice"]
    assert tables.first_rows(tables.read_raw_bars(spark, path), "A", 2).count() == 2
    assert tables.empty_like(tables.read_raw_bars(spark, path)).count() == 0
    with pytest.raises(ValueError, match="Close_t"):
        tables.require_columns(tables.read_closes(spark, path), ["Close_t"])
    path = str(tmp_path / "labelled")
    bars = frame(spark, walk("A", 20, 1))
    sinks.append_labels(labels.label_frame(bars, bars, labels.LabelSpec(), "R", LOADED), path)
    assert tables.read_labelled(spark, path, labels.LabelSpec()).count() == 20
    assert tables.read_labelled(spark, path, labels.LabelSpec(horizon=6)).count() == 0
