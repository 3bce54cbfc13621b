"""The whole pipeline over a store: vendor files in, model registry out."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import incremental
from tickloom.operators.labels import LabelSpec
from tickloom.operators.staging import MarketHoursError
from tickloom.operators.training import TrainSettings, load_model, predict
from tickloom.plans import jobs
from tickloom.schemas import DEFINITIONS, FEATURE_SET_MEMBERS, FEATURE_SETS, INDICATOR_FIELDS, SIGNAL_COLUMNS, SIGNAL_FEATURES
from tickloom.streaming.ingest import merge_stream
from helpers import walk

NOW = datetime(2024, 3, 5, 18, 0)
SPEC = LabelSpec()


def definitions(spark):
    rows = []
    for i, field in enumerate(INDICATOR_FIELDS, start=1):
        name, param = field.rsplit("_", 1)
        rows.append((i, name, param, 1))
    return spark.createDataFrame([*rows, (99, "OBV", "0", 0)], DEFINITIONS)


def vendor_file(spark, folder, *groups):
    rows = [(s, str(t), o, h, l, c, c, v) for rows in groups for s, t, o, h, l, c, v in rows]
    df = spark.createDataFrame(rows, "a string, b string, c double, d double, e double, f double, g double, h long")
    df.toDF("Symbol", "Datetime", "Open", "High", "Low", "Close", "Adj Close", "Volume").coalesce(1).write.mode("append").option("header", True).csv(str(folder))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """A store after one full run over two symbols of one day."""
    root = tmp_path_factory.mktemp("store")
    vendor_file(spark, root / "vendor1", walk("AAA", 300, 1), walk("BBB", 280, 2))
    s = jobs.Store(spark, str(root / "tables"))
    batch = jobs.ingest_job(s, str(root / "vendor1"), NOW, source_zone=None)
    assert batch.count() == 580 and s.staging().where("Exported = 0").count() == 580
    merged = jobs.merge_job(s)
    assert merged.inserted.count() == 580
    jobs.indicator_job(s, definitions(spark), NOW)
    jobs.feature_job(s, definitions(spark), NOW)
    jobs.signal_job(s, NOW)
    jobs.label_job(s, NOW)
    return s


def test_merge_marks_batches_and_is_idempotent(store):
    assert store.staging().where("Exported = 0").count() == 0
    again = jobs.merge_job(store)
    assert again.inserted.count() == 0
    assert store.raw_bars().count() == 580
    assert store.raw_bars().select("Symbol", "PriceTimestamp").distinct().count() == 580


def test_ingesting_the_same_file_again_stages_nothing(spark, store, tmp_path):
    vendor_file(spark, tmp_path / "same", walk("AAA", 300, 1))
    assert jobs.ingest_job(store, str(tmp_path / "same"), NOW, source_zone=None, write=False).count() == 0


def test_date_range_mode_ignores_the_cutoff(spark, store, tmp_path):
    vendor_file(spark, tmp_path / "same", walk("AAA", 300, 1))
    start = datetime(2024, 3, 4, 9, 0)
    picked = jobs.ingest_job(store, str(tmp_path / "same"), NOW, date_range=(start, start + timedelta(minutes=10)), source_zone=None, write=False)
    assert picked.count() == 10


def test_indicator_table(store):
    long = store.read("indicators")
    assert sorted(r.FieldName for r in long.select("FieldName").distinct().collect()) == sorted(INDICATOR_FIELDS)
    assert long.where("IndicatorValue IS NULL").count() == 0
    assert long.where("IndicatorName = 'EMA' AND Symbol = 'AAA'").count() == 4 * 300


def test_merged_snapshot(store):
    merged = store.read("merged_features")
    assert merged.count() == 580
    row = merged.where("Symbol = 'AAA'").orderBy(F.desc("PriceTimestamp")).first()
    assert row.SourceIndicatorCount == 19 and row.MissingIndicatorCount == 0 and row.Volume_percentile is not None
    assert set(row.asDict()) >= {"Return_t_norm", "BBWidth_norm", "SessionType", "Return_zscore", "Volume_spike"}


def test_feature_job_twice_keeps_one_row_per_bar(store):
    jobs.feature_job(store, definitions(store.spark), NOW + timedelta(hours=1))
    merged = store.read("merged_features")
    assert merged.count() == 580
    assert merged.select("MergeRunId").distinct().count() == 1


def test_signal_table(store):
    signals = store.read("signal_features")
    assert signals.columns == [*SIGNAL_COLUMNS, "TradeDate"] and signals.count() == 580
    assert [f.dataType for f in signals.schema][:-1] == [f.dataType for f in SIGNAL_FEATURES]
    assert jobs.signal_job(store, NOW, write=False).count() == 0


def test_labels(store):
    labelled = store.read("labelled_features")
    assert labelled.count() == 580
    assert labelled.where("IsTrainableRow = 1").count() == 580 - 2 * SPEC.horizon
    assert "Close_t" in labelled.columns and "ClosePrice" not in labelled.columns
    assert jobs.label_job(store, NOW, write=False).count() == 0


def test_training_saves_and_registers(spark, store):
    sets = spark.createDataFrame([(1, 0), (7, 1)], FEATURE_SETS)
    members = spark.createDataFrame([(7, "RSI_14", 2), (7, "Return_t_norm", 1), (7, "Gone", 3), (1, "SMA_20", 1)], FEATURE_SET_MEMBERS)
    run = jobs.training_job(store, NOW, sets, members, settings=TrainSettings(rounds=2, depth=2), repeats=2, write=True)
    assert run.features == ["Return_t_norm", "RSI_14"] and run.missing == ["Gone"]
    entry = store.read("model_registry").first()
    assert entry.FeatureSetID == 7 and entry.ModelName == "GBT_DIRECTION_5M_5m_v1_v1" and "test_accuracy" in entry.MetricsJson
    assert {r.Feature for r in run.importance.collect()} == {"Return_t_norm", "RSI_14"}
    again = load_model(entry.ArtifactPath)
    assert predict(again, store.read("labelled_features"), run.features).where("Prediction NOT IN (-1, 0, 1)").count() == 0


def test_dry_run_writes_nothing(spark, store, tmp_path):
    empty = jobs.Store(spark, str(tmp_path / "dry"))
    vendor_file(spark, tmp_path / "v", walk("AAA", 5, 1))
    assert jobs.ingest_job(empty, str(tmp_path / "v"), NOW, source_zone=None, write=False).count() == 5
    assert not (tmp_path / "dry").exists()
    before = store.raw_bars().count()
    jobs.merge_job(store, write=False)
    jobs.indicator_job(store, definitions(spark).limit(1), NOW, write=False)
    assert store.raw_bars().count() == before


def test_new_rows_only_next_day(spark, store, tmp_path):
    """Runs last: the second day gives new signals that see the first day as context."""
    next_day = datetime(2024, 3, 5, 9, 0)
    vendor_file(spark, tmp_path / "day2", walk("AAA", 30, 5, start=next_day), walk("NEW", 25, 6, start=next_day))
    jobs.ingest_job(store, str(tmp_path / "day2"), NOW + timedelta(days=1), source_zone=None)
    assert jobs.merge_job(store).inserted.count() == 55
    new = jobs.indicator_job(store, definitions(spark), NOW + timedelta(days=1), write=False)
    assert new.where("IndicatorName = 'EMA'").count() == 4 * 55 and new.where("FieldName = 'SMA_200'").count() == 30
    jobs.indicator_job(store, definitions(spark), NOW + timedelta(days=1), only_new=False)  # second values for old bars: the later ones win
    jobs.feature_job(store, definitions(spark), NOW + timedelta(days=1))
    fresh = jobs.signal_job(store, NOW + timedelta(days=1))
    assert fresh.count() == 56 and fresh.where("to_date(FeatureTimestamp) = '2024-03-04'").select("Symbol", F.col("Target").isNull()).collect() == [("AAA", False)] and fresh.where("Symbol = 'AAA' AND Return_20 IS NULL").count() == 0
    assert fresh.where("Symbol = 'NEW' AND Return_20 IS NULL").count() == 20
    assert store.read("signal_features").count() == 635
    assert jobs.label_job(store, NOW + timedelta(days=1)).count() == 55


def test_labels_are_finished_when_their_bars_arrive(spark, tmp_path):
    """Two runs in one session give the labels and targets of a single one."""
    s, bars = jobs.Store(spark, str(tmp_path / "tables")), walk("AAA", 30, 1)
    for n, part in enumerate((bars[:20], bars[20:])):
        now = NOW + timedelta(minutes=n)
        vendor_file(spark, tmp_path / f"v{n}", part)
        jobs.ingest_job(s, str(tmp_path / f"v{n}"), now, source_zone=None)
        jobs.merge_job(s)
        jobs.indicator_job(s, definitions(spark), now)
        jobs.feature_job(s, definitions(spark), now)
        jobs.signal_job(s, now)
        jobs.label_job(s, now)
    labelled = s.read("labelled_features")
    assert labelled.count() == 30 and labelled.where("IsTrainableRow = 1").count() == 30 - SPEC.horizon
    targets = s.read("signal_features")
    assert targets.count() == 30 and targets.where("Target IS NULL").count() == 1
    assert jobs.label_job(s, NOW).count() == 0


def test_two_streams_into_one_store(spark, tmp_path):
    s = jobs.Store(spark, str(tmp_path / "both"))
    for name, symbol in (("x", "AAA"), ("y", "BBB")):
        vendor_file(spark, tmp_path / name, walk(symbol, 10, 1))
        query = merge_stream(s, str(tmp_path / name), str(tmp_path / f"mark-{name}"), source_zone=None)
        assert query.awaitTermination(240) and query.exception() is None
    assert {(r.Symbol, r["count"]) for r in s.raw_bars().groupBy("Symbol").count().collect()} == {("AAA", 10), ("BBB", 10)}


def test_unreadable_rows_are_set_aside(spark, tmp_path):
    s = jobs.Store(spark, str(tmp_path / "aside"))
    rows = [("AAA", "2024-03-04 09:31:00", "1", "1", "1", "1", "1", "5"), ("AAA", "noon", "1", "1", "1", "1", "1", "5"), ("AAA", "2024-03-04 09:32:00", "1", "1", "1", "x", "1", "5")]
    spark.createDataFrame(rows, "Symbol string, Datetime string, Open string, High string, Low string, Close string, Adj string, Volume string").write.option("header", True).csv(str(tmp_path / "v"))
    jobs.ingest_job(s, str(tmp_path / "v"), NOW, source_zone=None)
    merged = jobs.merge_job(s)
    assert merged.inserted.count() == 1 and s.read("rejected").count() == 2
    assert merged.summary.select("PendingRows", "RejectedRows", "InsertedRows").collect() == [(3, 2, 1)]


def test_gate(spark, tmp_path):
    s = jobs.Store(spark, str(tmp_path / "gate"))
    vendor_file(spark, tmp_path / "v", walk("AAA", 5, 1, start=datetime(2024, 3, 4, 8, 57)))
    jobs.ingest_job(s, str(tmp_path / "v"), NOW, source_zone=None)
    with pytest.raises(MarketHoursError) as error:
        jobs.merge_job(s)
    assert error.value.count == 3 and error.value.rows.count() == 3


def test_repair_rewrites_only_damaged_dates(spark, tmp_path):
    s = jobs.Store(spark, str(tmp_path / "repair"))
    for n, day in enumerate((datetime(2024, 3, 4, 9), datetime(2024, 3, 5, 9))):
        vendor_file(spark, tmp_path / f"v{n}", walk("AAA", 20, n, start=day))
        jobs.ingest_job(s, str(tmp_path / f"v{n}"), NOW + timedelta(days=n), source_zone=None)
        jobs.merge_job(s)
    twice = s.raw_bars().where("to_date(PriceTimestamp) = '2024-03-05'").withColumn("TradeDate", F.to_date("PriceTimestamp"))
    from tickloom.session import cut_lineage

    cut_lineage(twice).write.mode("append").partitionBy("TradeDate").parquet(s.path("raw_bars"))
    assert s.raw_bars().count() == 60
    assert jobs.repair_raw_job(s).count() == 20
    assert s.raw_bars().count() == 40 and s.raw_bars().distinct().count() == 40


def test_stream_merges_files_once(spark, tmp_path):
    s = jobs.Store(spark, str(tmp_path / "stream"))
    source = tmp_path / "vendor"
    vendor_file(spark, source, walk("AAA", 20, 1))
    vendor_file(spark, source, walk("AAA", 20, 1), walk("BBB", 10, 2))
    for _ in range(2):
        query = merge_stream(s, str(source), str(tmp_path / "mark"), source_zone=None, files_per_batch=1)
        assert query.awaitTermination(240)
        assert query.exception() is None
        assert s.raw_bars().count() == 30


def _through(store, definitions_, vendor, now, date_range=None):
    jobs.ingest_job(store, vendor, now, source_zone=None, date_range=date_range)
    jobs.merge_job(store, now=now)
    jobs.indicator_job(store, definitions_, now)
    jobs.feature_job(store, definitions_, now)
    jobs.signal_job(store, now)
    jobs.label_job(store, now)


def test_chain_of_runs_equals_one_run(spark, tmp_path):
    """Daily runs, a new symbol, and a range that is back-filled last give what one run over all bars gives."""
    some = definitions(spark)
    days = [datetime(2024, 3, 4 + k, 9) for k in range(3)]
    parts = [walk("AAA", 60, 1, start=days[0]) + walk("OLD", 40, 7, start=days[0]), walk("AAA", 50, 3, start=days[2]) + walk("NEW", 45, 4, start=days[2]), walk("AAA", 40, 2, start=days[1])]
    chain, whole = jobs.Store(spark, str(tmp_path / "chain")), jobs.Store(spark, str(tmp_path / "whole"))
    for n, part in enumerate(parts):
        vendor_file(spark, tmp_path / f"v{n}", part)
        vendor_file(spark, tmp_path / "all", part)
        _through(chain, some, str(tmp_path / f"v{n}"), NOW + timedelta(hours=n), (days[1], days[2]) if n == 2 else None)
    _through(whole, some, str(tmp_path / "all"), NOW)
    stamps = {"merged_features": ["RunTimestamp", "MergeRunId"], "signal_features": ["FeatureRunId", "RunDateTime"], "labelled_features": ["RunTimestamp", "MergeRunId", "LoadTimestamp", "SourceRunID", "RunId"]}
    for table, columns in stamps.items():
        one, other = (s.read(table).drop(*columns) for s in (chain, whole))
        assert one.count() == other.count() == 235, table
        numbers = [f.name for f in one.schema if f.dataType.typeName() == "double"]
        one, other = (df.select(sorted(df.columns)).withColumns({c: F.round(c, 8) for c in numbers}) for df in (one, other))
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty(), table
    assert jobs.signal_job(chain, NOW, write=False).isEmpty() and jobs.label_job(chain, NOW, write=False).isEmpty()
    again = jobs.signal_job(whole, NOW, rebuild=True, write=False)
    assert again.count() == 235


def test_jobs_read_only_the_days_they_need(spark, tmp_path):
    """Plans of an incremental run name the partitions of staging, bars and merged features."""
    some, s = definitions(spark), jobs.Store(spark, str(tmp_path / "pruned"))
    for n, day in enumerate((4, 5, 6)):
        now = NOW + timedelta(days=n)
        vendor_file(spark, tmp_path / f"v{n}", walk("AAA", 300, n, start=datetime(2024, 3, day, 9)))
        jobs.ingest_job(s, str(tmp_path / f"v{n}"), now, source_zone=None)
        if n < 2:
            jobs.merge_job(s, now=now)
            jobs.indicator_job(s, some, now)
    jobs.feature_job(s, some, now)
    jobs.signal_job(s, now)

    def filters(df, table):
        """The partition filters of the scans of a table."""
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        scans = [x for x in df._jdf.queryExecution().explainString(mode).split("\n\n") if "Scan parquet" in x and f"/pruned/{table}" in x]
        return [x.split("PartitionFilters: ")[1].split("\n")[0] if "PartitionFilters: " in x else "" for x in scans]

    staged = filters(s.pending_staging(), "staging]")
    assert staged and all("BATCH_20240307" in x and "BATCH_20240306" not in x for x in staged)
    known = filters(jobs.merge_job(s, write=False).inserted, "raw_bars")
    assert known and all("TradeDate" in x for x in known)
    jobs.merge_job(s, now=now)
    jobs.indicator_job(s, some, now)
    bars = filters(jobs.feature_job(s, some, now, write=False), "raw_bars")
    assert bars and all("2024-03-05" in x and "2024-03-06" in x and "2024-03-04" not in x for x in bars)
    needed = incremental.days_needed(s.ledger(), incremental.starts(s.ledger(), s.open_runs("features", "indicators")), 22)
    assert [str(d) for d in incremental.trade_dates(needed)] == ["2024-03-05", "2024-03-06"]
    merged = filters(incremental.of_days(s.read("merged_features"), needed), "merged_features")
    assert merged and all("2024-03-05" in x and "2024-03-04" not in x for x in merged)


def test_indicators_resume_from_the_stored_block(spark, tmp_path):
    """A second run reads the last block on and gives the values of a run over everything; back-filled bars start anew."""
    s, some = jobs.Store(spark, str(tmp_path / "resumed")), definitions(spark).where("IndicatorName IN ('SMA', 'EMA', 'ATR', 'SUPERTREND')")
    fields = some.where("IsActive = 1").count()
    days = [datetime(2024, 3, day, 9) for day in (4, 5, 6, 8)]
    for n, (day, rows) in enumerate(zip(days, (300, 300, 300, 20))):
        vendor_file(spark, tmp_path / f"v{n}", walk("AAA", rows, n, start=day))
    for n in (0, 1, 3):
        jobs.ingest_job(s, str(tmp_path / f"v{n}"), NOW + timedelta(days=n), source_zone=None)
        jobs.merge_job(s, now=NOW + timedelta(days=n))
        if n < 3:
            jobs.indicator_job(s, some, NOW + timedelta(days=n), block_rows=256)
    state = s.indicator_state().collect()
    assert [(r.Symbol, r.Block) for r in state] == [("AAA", 2)]
    known, from_ = s.indicator_state(), incremental.starts(s.ledger(), s.open_runs("indicators"))
    assert [str(d) for d in incremental.trade_dates(incremental.days_since(s.ledger(), from_, known))] == ["2024-03-04", "2024-03-05", "2024-03-08"][1 if state[0].FromTs >= days[1] else 0:]

    def equal(one, other):
        keys = ["Symbol", "PriceTimestamp", "FieldName"]
        one, other = (x.select(*keys, F.round("IndicatorValue", 8).alias("v")) for x in (one, other))
        return one.count() == other.count() and one.exceptAll(other).isEmpty()

    new = jobs.indicator_job(s, some, NOW + timedelta(days=3), block_rows=256)
    whole = jobs.indicator_job(s, some, NOW, only_new=False, write=False)
    assert new.count() == fields * 20 and equal(new, whole.where(F.col("PriceTimestamp") >= days[3]))
    jobs.ingest_job(s, str(tmp_path / "v2"), NOW + timedelta(days=4), source_zone=None, date_range=(days[2], days[3]))
    jobs.merge_job(s, now=NOW + timedelta(days=4))
    again = jobs.indicator_job(s, some, NOW + timedelta(days=4), block_rows=256)
    whole = jobs.indicator_job(s, some, NOW, only_new=False, write=False)
    assert again.count() == fields * 320 and equal(again, whole.where(F.col("PriceTimestamp") >= days[2]))
    assert s.indicator_state().count() == 1 and jobs.indicator_job(s, some, NOW, block_rows=256, write=False).isEmpty()
