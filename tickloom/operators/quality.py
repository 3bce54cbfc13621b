"""Data-quality reports: duplicates, coverage, ranges, NULLs, orphans, row counts.

Each report is aggregated in the cluster; the ones over several columns or conditions share
one pass over the table.
"""

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import minute_bucket, naive, run_day_prefix
from tickloom.schemas import BAR_COLUMNS, KEY, PRICES, TS

def _rows() -> Column:
    return F.count(F.lit(1))


def duplicate_keys(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(_rows().alias("Cnt")).where("Cnt > 1").select(F.lit(table).alias("TableName"), *keys, "Cnt")


def minute_duplicates(staging: DataFrame, exported_only: bool = False) -> DataFrame:
    """(Symbol, minute) buckets that hold more than one staged row."""
    rows = staging.where("Exported = 1") if exported_only else staging
    return rows.groupBy(KEY, minute_bucket(F.col(TS)).alias("MinuteTimestamp")).agg(_rows().alias("Cnt")).where("Cnt > 1")


def duplicate_rows(staging: DataFrame, exported_only: bool = False) -> DataFrame:
    """All staged rows of duplicated minutes.

    The duplicated keys are found by pre-aggregation and matched with a semi-join, which splits
    a hot minute under adaptive skew handling; no window gathers the copies of a minute.
    """
    dupes = minute_duplicates(staging, exported_only).select(KEY, F.col("MinuteTimestamp").alias("_minute"))
    return staging.withColumn("_minute", minute_bucket(F.col(TS))).join(dupes, [KEY, "_minute"], "left_semi").drop("_minute")


def rows_per_day(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("TradeDate")).agg(_rows().alias("SignalRowCount"))


def rows_per_day_symbol(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("TradeDate"), KEY).agg(_rows().alias("SignalRowCount"))


def low_coverage(df: DataFrame, ts: str = TS, threshold: int = 300) -> DataFrame:
    """Symbol-days with fewer rows than expected."""
    return rows_per_day_symbol(df, ts).where(F.col("SignalRowCount") < threshold)


def newest_first(report: DataFrame) -> DataFrame:
    """Presentation order of the daily reports."""
    return report.orderBy(F.desc("TradeDate"), *[c for c in (KEY,) if c in report.columns])


def inserted_since(df: DataFrame, asof: datetime, stamp: str = "RunDateTime") -> DataFrame:
    """Rows stamped on or after the start of the day of `asof`."""
    day = F.to_date(naive(asof)).cast("timestamp_ntz")
    return df.where(F.col(stamp) >= day).agg(_rows().alias("RowsInsertedToday"))


def inserted_by_run(df: DataFrame, asof: datetime, prefix: str = "SIGNAL_", run: str = "FeatureRunId") -> DataFrame:
    """Rows whose run id starts with the prefix and the day of `asof`."""
    return df.where(F.col(run).startswith(run_day_prefix(prefix, naive(asof)))).agg(_rows().alias("RowsInsertedTodayByRunId"))


def rows_between(df: DataFrame, start: Column, end: Column, stamp: str = "addDateTime") -> DataFrame:
    return df.where(F.col(stamp).between(start, end)).agg(_rows().alias("RowsThisRun"))


def _range_counts() -> dict[str, Column]:
    bad = {f"Bad{c.removesuffix('Price')}": F.count_if(F.col(c) <= 0) for c in PRICES}
    return {**bad, "BadVolume": F.count_if(F.col("Volume") < 0)}


def range_violations(bars: DataFrame) -> DataFrame:
    """Counts of prices <= 0 per price column and of negative volumes."""
    return bars.agg(*[c.alias(name) for name, c in _range_counts().items()])


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(ColumnName, NullCount) for the given columns, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "ColumnName", "NullCount")


def row_count(df: DataFrame, minimum: int = 1000) -> DataFrame:
    return df.agg(_rows().alias("Cnt"), (_rows() >= minimum).alias("Ok"))


def orphan_rows(indicators: DataFrame, bars: DataFrame) -> DataFrame:
    """Indicator rows without a bar of the same symbol and time."""
    return indicators.join(bars.select(KEY, TS), [KEY, TS], "left_anti")


def orphan_count(indicators: DataFrame, bars: DataFrame) -> DataFrame:
    return orphan_rows(indicators, bars).agg(_rows().alias("Orphans"))


def table_counts(tables: Mapping[str, tuple[DataFrame, str]], asof: datetime) -> DataFrame:
    """Per table: rows, rows before the day of `asof`, and the difference. One pass per table."""
    day = F.to_date(naive(asof)).cast("timestamp_ntz")
    parts = [
        df.agg(_rows().alias("TotalRows"), F.count_if(F.col(ts) < day).alias("RowsBeforeToday"))
        .select(F.lit(name).alias("TableName"), "*", (F.col("TotalRows") - F.col("RowsBeforeToday")).alias("Increment"))
        for name, (df, ts) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _check(name: str, ok: Column, details: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), ok.alias("ok"), details.alias("details"))


def quality_report(
    raw: DataFrame | None, indicators: DataFrame | None, minimum: int = 1000, required: list[str] = BAR_COLUMNS
) -> DataFrame:
    """(check, ok, details) for existence, columns, NULLs, duplicates, ranges, row count, orphans.

    NULLs, ranges and the row count come from one pass over raw. A table that is None counts as
    missing: it and each check that needs it fail.
    """
    lost = [] if raw is not None else [f"{check}_raw_bars" for check in ("columns", "nulls", "ranges", "row_count", "duplicates")]
    if raw is None or indicators is None:
        lost.append("orphans_indicators")
    rows = [
        _check(f"table_exists_{name}", F.lit(df is not None), F.lit("missing" if df is None else "present"))
        for name, df in (("raw_bars", raw), ("indicators", indicators))
    ] + [_check(check, F.lit(False), F.lit("could not run: a table is missing")) for check in lost]
    parts = [SparkSession.active().range(1, numPartitions=1).select(F.inline(F.array(*rows)))]
    if raw is not None:
        missing = [c for c in required if c not in raw.columns]
        present = [c for c in required if c in raw.columns]
        counts = raw.agg(
            _rows().alias("n"),
            F.sum(sum((F.col(c).isNull().cast("int") for c in present), F.lit(0))).alias("nulls"),
            *[c.alias(name) for name, c in _range_counts().items()],
        )
        bad = sum((F.col(name) for name in _range_counts()), F.lit(0))
        parts.append(counts.select(F.inline(F.array(
            _check("columns_raw_bars", F.lit(not missing), F.lit(", ".join(missing) or "all present")),
            _check("nulls_raw_bars", F.coalesce(F.col("nulls"), F.lit(0)) == 0,
                   F.concat(F.coalesce(F.col("nulls"), F.lit(0)).cast("string"), F.lit(" NULLs"))),
            _check("ranges_raw_bars", bad == 0, F.concat(bad.cast("string"), F.lit(" values out of range"))),
            _check("row_count_raw_bars", F.col("n") >= minimum, F.concat(F.col("n").cast("string"), F.lit(" rows"))),
        ))))
        dupes = duplicate_keys(raw, [KEY, TS], "raw_bars").agg(_rows().alias("n"))
        parts.append(dupes.select(F.inline(F.array(_check(
            "duplicates_raw_bars", F.col("n") == 0, F.concat(F.col("n").cast("string"), F.lit(" duplicate keys")))))))
        if indicators is not None:
            orphans = orphan_count(indicators, raw)
            parts.append(orphans.select(F.inline(F.array(_check(
                "orphans_indicators", F.col("Orphans") == 0, F.concat(F.col("Orphans").cast("string"), F.lit(" orphans")))))))
    return reduce(DataFrame.unionByName, parts)
