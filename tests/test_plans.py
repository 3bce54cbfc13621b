"""Shape of the physical plans: what must and must not appear in them."""

from datetime import datetime

import pytest
from helpers import frame, walk

from checks.queries import QUERIES
from tickloom.operators.indicators import indicators
from tickloom.operators.labels import LabelSpec, label_frame
from tickloom.operators.quality import duplicate_rows
from tickloom.operators.staging import stage_dedup
from tickloom.sources import sinks, tables

LAZY = [q for q in QUERIES if q not in ("train_fit", "train_importance")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("wanted", [("SMA", 200), ("ADX", 14), ("ATR", 14), ("VWAP", 0)])
def test_value_windows_run_per_block(spark, wanted):
    """Windows over prices are partitioned by (Symbol, blk); only block sums are windowed by Symbol."""
    text = plan(indicators(frame(spark, walk("A", 50, 1)), [wanted]))
    for line in text.splitlines():
        if "Window [" in line and "blk" not in line.split("windowspecdefinition")[1].split("ASC")[0]:
            assert "row_number" in line or "_n#" in line or "_ewm" in line or "_total" in line, line


def test_windows_of_one_run_share_a_shuffle(spark):
    """Ten indicators cost no more exchanges than one."""
    bars = frame(spark, walk("A", 50, 1))
    one = plan(indicators(bars, [("SMA", 20)])).count("Exchange ")
    many = [("SMA", 20), ("SMA", 200), ("RSI", 14), ("ADX", 14), ("CCI", 20), ("STOCH_D", 14), ("WILLIAMS_R", 14), ("BOLL_PCTB", 20), ("ROC", 12), ("BOLL_WIDTH", 20)]
    assert plan(indicators(bars, many)).count("Exchange ") == one


def test_scan_reads_only_needed_columns(spark, tmp_path):
    path = str(tmp_path / "raw")
    frame(spark, walk("A", 50, 1)).write.parquet(path)
    schema = [line for line in plan(indicators(spark.read.parquet(path), [("SMA", 20)])).splitlines() if "ReadSchema" in line]
    assert schema and all("OpenPrice" not in line and "Volume" not in line and "HighPrice" not in line for line in schema)
    assert any("ClosePrice" in line for line in schema)


def test_label_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "labelled")
    bars = frame(spark, walk("A", 20, 1))
    sinks.append_labels(label_frame(bars, bars, LabelSpec(), "R", datetime(2024, 1, 1)), path)
    text = plan(tables.read_labelled(spark, path, LabelSpec()).select("Label"))
    assert "EqualTo(HorizonMinutes,5)" in text and "EqualTo(LabelType,DIRECTION_5M)" in text


def test_indicator_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "ind")
    from checks.queries import definitions
    from tickloom.operators.registry import indicator_long

    sinks.append_indicators(indicator_long(frame(spark, walk("A", 30, 1)), definitions(spark).where("IndicatorId IN (1, 7)")), path)
    text = plan(tables.read_indicators(spark, path).where("IndicatorName = 'RSI'"))
    assert "PartitionFilters: [isnotnull(IndicatorName" in text


def test_copies_are_reduced_before_the_shuffle(spark, data):
    """Deduplication aggregates partially and finds duplicates without a window over the copies."""
    from tickloom.sources.sample import event_staging

    assert "partial_max_by" in plan(stage_dedup(event_staging(spark, data)))
    text = plan(duplicate_rows(event_staging(spark, data)))
    assert "Window" not in text and "LeftSemi" in text


@pytest.mark.parametrize("gaps", [True, False])
def test_plan_of_a_mean_does_not_grow_with_its_span(spark, gaps):
    """Slow means unroll nothing: as many windows and exchanges for any span."""
    bars = frame(spark, walk("A", 50, 1))
    shapes = set()
    for span in (5, 50, 500, 5000):
        text = plan(indicators(bars, [("EMA", span)], block_rows=512, gaps=gaps))
        shapes.add((text.count("Window ["), text.count("Exchange "), text.count("Sort [")))
    assert len(shapes) == 1
