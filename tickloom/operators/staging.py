"""Staged ticks to raw minute bars."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import in_market_hours, minute_bucket, naive
from tickloom.schemas import KEY, PRICES, RAW_BARS, TRADE_DATE, TS

RAW_COLUMNS = [f.name for f in RAW_BARS.fields]


class MarketHoursError(ValueError):
    """Pending rows outside market hours; `rows` is the DataFrame of offenders."""

    def __init__(self, count: int, rows: DataFrame):
        super().__init__(f"{count} pending staging rows lie outside market hours")
        self.count, self.rows = count, rows


def pending(staging: DataFrame) -> DataFrame:
    return staging.where("Exported = 0")


def unreadable() -> Column:
    """Rows that can be no bar: without symbol, time or one of the prices."""
    return reduce(Column.__or__, [F.col(c).isNull() for c in (KEY, TS, *PRICES)])


def rejected(staging: DataFrame) -> DataFrame:
    """Pending rows that a merge sets aside."""
    return pending(staging).where(unreadable())


def pending_per_symbol(staging: DataFrame) -> DataFrame:
    return pending(staging).groupBy(KEY).agg(F.count(F.lit(1)).alias("PendingRows"))


def outside_market_hours(staging: DataFrame) -> DataFrame:
    return pending(staging).where(~in_market_hours(F.col(TS)))


def gate(staging: DataFrame) -> DataFrame:
    """One row: pending rows, those outside market hours, those that cannot be read, and whether a merge may run."""
    bad = F.count_if(~in_market_hours(F.col(TS)))
    return pending(staging).agg(
        F.count(F.lit(1)).alias("PendingRows"), bad.alias("InvalidRows"), F.count_if(unreadable()).alias("RejectedRows"),
        (bad == 0).alias("MayMerge"),
    )


def require_market_hours(staging: DataFrame) -> None:
    """Raise when a pending row lies outside market hours."""
    offenders = outside_market_hours(staging)
    count = offenders.count()
    if count:
        raise MarketHoursError(count, offenders)


def _newest(columns: list[str]) -> tuple[Column, Column]:
    """(payload, order): latest load first, then batch, original time and values, all descending."""
    order = ["LoadTimestamp", "BatchID", TS, *PRICES, "Volume"]
    return F.struct(*columns), F.struct(*order)


def newest_per_minute(rows: DataFrame) -> DataFrame:
    """One row per (Symbol, minute), the one loaded last.

    An aggregation instead of a ranking window: copies are reduced before the shuffle, so a
    minute that was loaded a million times does not end up in one task. Ties are broken by
    batch, original time and values, so reruns give the same row.
    """
    payload, order = _newest([c for c in RAW_COLUMNS if c not in (KEY, TS)])
    return (
        rows.groupBy(KEY, minute_bucket(F.col(TS)).alias("_minute"))
        .agg(F.max_by(payload, order).alias("_row"))
        .select(KEY, F.col("_minute").alias(TS), "_row.*")
        .select(RAW_COLUMNS)
    )


def stage_dedup(staging: DataFrame) -> DataFrame:
    """Readable pending rows within market hours, one per (Symbol, minute)."""
    return newest_per_minute(pending(staging).where(in_market_hours(F.col(TS)) & ~unreadable()))


def new_only(candidates: DataFrame, raw: DataFrame) -> DataFrame:
    """Candidates whose (Symbol, minute) is not in raw yet.

    Only raw rows within the time range of the candidates can match. The range is a pair of
    scalar subqueries on the stored time (and on the trade date, when raw is partitioned by it),
    so it prunes files and row groups and keeps the rest of the history out of the join.
    """
    span = candidates.agg(F.min(TS).alias("lo"), (F.max(TS) + F.make_dt_interval(mins=F.lit(1))).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    known = raw.where((F.col(TS) >= lo) & (F.col(TS) < hi))
    if TRADE_DATE in raw.columns:
        known = known.where((F.col(TRADE_DATE) >= F.to_date(lo)) & (F.col(TRADE_DATE) <= F.to_date(hi)))
    return candidates.join(known.select(KEY, minute_bucket(F.col(TS)).alias(TS)), [KEY, TS], "left_anti")


def raw_dedup(raw: DataFrame) -> DataFrame:
    """Safety net: one row per (Symbol, minute) in the raw table, the one loaded last."""
    return newest_per_minute(raw)


def duplicate_minutes(raw: DataFrame) -> DataFrame:
    """(Symbol, minute) held by more than one raw row."""
    keys = raw.groupBy(KEY, minute_bucket(F.col(TS)).alias("_minute")).agg(F.count(F.lit(1)).alias("Cnt"))
    return keys.where("Cnt > 1").select(KEY, F.col("_minute").alias(TS), "Cnt")


def keep_last_per_minute(batch: DataFrame) -> DataFrame:
    """Within one download, the last tick of each minute stands for it."""
    values = [c for c in batch.columns if c not in (KEY, TS)]
    return (
        batch.groupBy(KEY, minute_bucket(F.col(TS)).alias("_minute"))
        .agg(F.max_by(F.struct(*values), F.struct(TS, *values)).alias("_row"))
        .select(KEY, F.col("_minute").alias(TS), "_row.*")
    )


def mark_exported(staging: DataFrame) -> DataFrame:
    return staging.withColumn("Exported", F.lit(1))


@dataclass(frozen=True)
class MergeResult:
    """Snapshots after a merge. Write `raw` and `staging` to new locations, then swap by name."""

    inserted: DataFrame
    raw: DataFrame
    staging: DataFrame
    summary: DataFrame


def merge_staging(staging: DataFrame, raw: DataFrame, check_hours: bool = True) -> MergeResult:
    """Pending ticks become raw bars: gate, dedup, insert new only, mark, dedup raw, count.

    Only the rows of this snapshot are marked. Running it again on the result inserts nothing.
    """
    if check_hours:
        require_market_hours(staging)
    inserted = new_only(stage_dedup(staging), raw)
    snapshot = raw_dedup(raw.select(RAW_COLUMNS).unionByName(inserted))
    return MergeResult(inserted, snapshot, mark_exported(staging), merge_summary(staging, raw, inserted, snapshot))


def merge_summary(staging: DataFrame, raw: DataFrame, inserted: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Per symbol: pending rows, those set aside, raw rows before and after, inserted rows.

    One grouped pass over the tables put on top of each other.
    """
    tables = {"PendingRows": pending(staging), "RejectedRows": rejected(staging), "RowsBefore": raw, "InsertedRows": inserted, "RowsAfter": snapshot}
    parts = [df.select(KEY, F.lit(name).alias("part")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).groupBy(KEY).agg(
        *[F.count_if(F.col("part") == name).alias(name) for name in tables]
    )


def ledger_summary(staging: DataFrame, days: DataFrame, inserted: DataFrame) -> DataFrame:
    """merge_summary with the raw rows from `days` (Symbol, Rows per day, before the merge) instead of a scan of raw."""
    tables = {"PendingRows": pending(staging), "RejectedRows": rejected(staging), "InsertedRows": inserted}
    parts = [df.select(KEY, F.lit(name).alias("part"), F.lit(1).cast("long").alias("n")) for name, df in tables.items()]
    parts.append(days.select(KEY, F.lit("RowsBefore"), F.col("Rows").cast("long")))
    sums = reduce(DataFrame.union, parts).groupBy(KEY).agg(*[F.coalesce(F.sum(F.when(F.col("part") == name, F.col("n"))), F.lit(0)).alias(name) for name in (*tables, "RowsBefore")])
    return sums.select(KEY, "PendingRows", "RejectedRows", "RowsBefore", "InsertedRows", (F.col("RowsBefore") + F.col("InsertedRows")).alias("RowsAfter"))


def recently_loaded(raw: DataFrame, asof, window_minutes: int = 10) -> DataFrame:
    """Rows per symbol loaded within the last minutes before `asof`."""
    start = naive(asof) - F.make_dt_interval(mins=F.lit(window_minutes))
    return raw.where(F.col("LoadTimestamp") >= start).groupBy(KEY).agg(F.count(F.lit(1)).alias("LoadedRows"))
