"""Vendor price files to staged minute bars, for all symbols in one job."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import clean_headers, days_from_text, exchange_time_of_text, naive, to_double
from tickloom.operators.incremental import symbol_cutoffs
from tickloom.operators.staging import keep_last_per_minute
from tickloom.schemas import BAR_COLUMNS, KEY, TS

# Vendor headers after cleaning, and the column each becomes.
VENDOR_HEADERS = {
    "Symbol": KEY,
    "Date": TS,
    "Datetime": TS,
    "Open": "OpenPrice",
    "High": "HighPrice",
    "Low": "LowPrice",
    "Close": "ClosePrice",
    "Volume": "Volume",
}
DEFAULT_DAYS = 7
KNOWN_SYMBOL_DAYS = 1


def read_vendor(spark: SparkSession, path: str, source_zone: str | None = "UTC") -> DataFrame:
    """Headed CSV files read as text and cleaned; a folder of any size is one scan."""
    return vendor_bars(spark.read.option("header", True).option("inferSchema", False).csv(path), source_zone)


def vendor_bars(download: DataFrame, source_zone: str | None = "UTC") -> DataFrame:
    """Clean headers, types, exchange time, and one row per minute (the last one).

    `source_zone` is the zone of naive vendor times; None keeps them as exchange time. Times that
    carry a zone are converted from it. Rows without a readable time, symbol or price are kept; the
    staging merge counts and sets them aside.
    """
    df = clean_headers(download)
    df = df.withColumnsRenamed({k: v for k, v in VENDOR_HEADERS.items() if k in df.columns}).select(BAR_COLUMNS)
    df = df.withColumns({
        TS: exchange_time_of_text(F.col(TS).cast("string"), source_zone),
        **{c: to_double(F.col(c)) for c in BAR_COLUMNS[2:-1]},
        "Volume": to_double(F.col("Volume")).cast("bigint"),
    })
    return keep_last_per_minute(df).select(BAR_COLUMNS)


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """Symbol list from headed CSV (Symbol, Days), cleaned."""
    listed = spark.read.option("header", True).schema("Symbol string, Days string").csv(path)
    return symbol_days(listed)


def symbol_days(symbols: DataFrame) -> DataFrame:
    """Symbol list with its back-fill days cleaned: '30 d' -> 30, no digits -> 7."""
    return symbols.withColumn("Days", days_from_text(F.col("Days"), DEFAULT_DAYS))


def backfill_window(bars: DataFrame, symbols: DataFrame, exported: DataFrame, asof: datetime | None = None) -> DataFrame:
    """Listed symbols only: a new symbol gives its last `Days` days, a known one its last day.

    Days are counted back from `asof`, by default the newest bar of the download.
    """
    latest = bars.agg(F.max(TS)).scalar() if asof is None else naive(asof)
    wanted = symbols.join(exported, KEY, "left").select(
        KEY, F.when(F.col("LastTs").isNull(), F.col("Days")).otherwise(KNOWN_SYMBOL_DAYS).alias("_days")
    )
    start = latest - F.make_dt_interval(days=F.col("_days"))
    return bars.join(wanted, KEY).where(F.col(TS) >= start).drop("_days")


def ingest(
    bars: DataFrame, staging: DataFrame, symbols: DataFrame | None = None,
    date_range: tuple[datetime, datetime] | None = None, asof: datetime | None = None,
) -> DataFrame:
    """Bars to stage. With a date range exactly that range; otherwise the back-fill window of
    each symbol, less what was exported before."""
    if date_range is not None:
        start, end = (naive(t) for t in date_range)
        return bars.where((F.col(TS) >= start) & (F.col(TS) < end))
    exported = symbol_cutoffs(staging, where="Exported = 1")
    if symbols is not None:
        bars = backfill_window(bars, symbols, exported, asof)
    marked = bars.join(exported, KEY, "left")
    return marked.where(F.col("LastTs").isNull() | (F.col(TS) > F.col("LastTs"))).drop("LastTs")


def ingest_summary(bars: DataFrame) -> DataFrame:
    """Rows, days and time range per symbol, and one total row with Symbol NULL.

    Days are counted per symbol first and added up, as the totals of a run are.
    """
    daily = bars.groupBy(KEY, F.to_date(TS).alias("TradeDate")).agg(
        F.count(F.lit(1)).alias("n"), F.min(TS).alias("lo"), F.max(TS).alias("hi")
    )
    return daily.rollup(KEY).agg(
        F.countDistinct(daily[KEY]).alias("Symbols"),
        F.count(F.lit(1)).alias("DaysProcessed"),
        F.sum("n").alias("RowsInserted"),
        F.min("lo").alias("FirstTimestamp"),
        F.max("hi").alias("LastTimestamp"),
    )


def rows_per_date(bars: DataFrame) -> DataFrame:
    return bars.groupBy(KEY, F.to_date(TS).alias("TradeDate")).agg(F.count(F.lit(1)).alias("RowsInserted"))
