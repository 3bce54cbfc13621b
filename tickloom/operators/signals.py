"""Next-bar signal features with a fixed output layout."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rolling import pct_change, roll
from tickloom.functions.scalars import naive, null_count, nz
from tickloom.operators.incremental import newer_rows, newer_with_context, symbol_cutoffs, with_cutoff
from tickloom.operators.series import block_window, core_rows, with_blocks, with_row_index
from tickloom.schemas import (
    CALENDAR_FIELDS, INDICATOR_FIELDS, KEY, MERGED_SOURCE_COLUMNS, PRICES, SIGNAL_COLUMNS, SIGNAL_METRICS, TS,
)

LOOKBACK = 21
COUNTED = [*PRICES, "Volume", *INDICATOR_FIELDS, *SIGNAL_METRICS, "Target"]


def signal_metrics(merged: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Returns, volatility, momentum, candle shares and the next-row return as Target."""
    w, close = block_window(), F.col("ClosePrice")
    df = with_blocks(with_row_index(merged), before=LOOKBACK, after=1, rows=block_rows)
    df = df.withColumns({
        "Range_Pct": (F.col("HighPrice") - F.col("LowPrice")) / nz(close),
        "Body_Pct": (close - F.col("OpenPrice")) / nz(close),
        "Return_1": pct_change(close, 1, w),
        "Return_5": pct_change(close, 5, w),
        "Return_20": pct_change(close, 20, w),
        "Momentum_10": pct_change(close, 10, w),
        "Target": F.lead(close, 1).over(w) / nz(close) - 1,
    }).withColumn("Volatility_20", roll(F.stddev_samp, F.col("Return_1"), 20, w))
    return core_rows(df).drop("rn", "blk", "core")


def signal_frame(merged: DataFrame, run_id: str, run_ts: datetime, version: int = 1, block_rows: int | None = None) -> DataFrame:
    """The fixed 42 output columns for every merged row."""
    source = merged.select(*[c for c in MERGED_SOURCE_COLUMNS if c in merged.columns])
    df = signal_metrics(source, block_rows)
    return df.withColumns({
        "FeatureTimestamp": F.col(TS),
        "FeatureRunId": F.lit(run_id),
        "RunDateTime": naive(run_ts),
        "SignalVersion": F.lit(version).cast("int"),
        "MissingFeatureCount": null_count([c for c in COUNTED if c in df.columns]),
        **{c: F.col(c).cast("int") for c in CALENDAR_FIELDS},
    }).select(SIGNAL_COLUMNS)


def signal_incremental(
    merged: DataFrame, existing: DataFrame, run_id: str, run_ts: datetime, version: int = 1, per_symbol: bool = True
) -> DataFrame:
    """Signal rows newer than what `existing` holds, computed with their look-back context.

    The cutoff is per symbol, so a symbol that arrives late is not skipped; `per_symbol=False`
    uses one cutoff for all. The newest stored bar of a symbol had no next bar when it was
    written: `reopen_last_bars` gives it again, for an upsert.
    """
    marked = with_cutoff(merged, existing, "FeatureTimestamp", per_symbol)
    recent = newer_with_context(marked, LOOKBACK)
    frame = signal_frame(recent.drop("LastTs"), run_id, run_ts, version)
    return newer_rows(frame, existing, "FeatureTimestamp", "FeatureTimestamp", per_symbol)


def reopen_last_bars(
    merged: DataFrame, existing: DataFrame, run_id: str, run_ts: datetime, version: int = 1
) -> DataFrame:
    """The newest stored bar of each symbol, with the Target it could not have before."""
    marked = with_cutoff(merged, existing, "FeatureTimestamp")
    recent = newer_with_context(marked, LOOKBACK + 1)
    frame = signal_frame(recent.drop("LastTs"), run_id, run_ts, version)
    last = symbol_cutoffs(existing, "FeatureTimestamp")
    return frame.join(last, KEY).where(F.col("FeatureTimestamp") == F.col("LastTs")).drop("LastTs")


def signals_from(source: DataFrame, run_id: str, run_ts: datetime, version: int = 1) -> DataFrame:
    """Signal rows from FromTs on, and each symbol's bar before it once that has a Target.

    `source` has FromTs and the days before it that `days_needed` gives for LOOKBACK + 1 rows.
    """
    from_ = source.groupBy(KEY).agg(F.min("FromTs").alias("FromTs"), F.max(F.when(F.col(TS) < F.col("FromTs"), F.col(TS))).alias("_last"))
    frame = signal_frame(source, run_id, run_ts, version).join(from_, KEY)
    at = F.col("FeatureTimestamp")
    return frame.where((at >= F.col("FromTs")) | ((at == F.col("_last")) & F.col("Target").isNotNull())).select(SIGNAL_COLUMNS)
