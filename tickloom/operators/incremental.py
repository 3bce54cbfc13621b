"""What is new: high-water marks per symbol or overall, and a ledger of the days that merges touched.

The ledger has a row for each symbol and day of a merge, thousands of times fewer than bars. From it
follow where each symbol has to be computed again (its first new bar, be it today's or a back-filled one),
which days hold the rows that are needed before, and so which partitions of the large tables are read.
"""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import naive
from tickloom.schemas import KEY, TRADE_DATE, TS

# Fixed value: a time before any bar.
BEGINNING = datetime(1900, 1, 1)


def symbol_cutoffs(stored: DataFrame, ts: str = TS, where: Column | str | None = None) -> DataFrame:
    """Symbol, LastTs. Restrict with `where`, e.g. exported staging rows or one label version."""
    rows = stored.where(where) if where is not None else stored
    return rows.groupBy(KEY).agg(F.max(ts).alias("LastTs"))


def global_cutoff(stored: DataFrame, ts: str = TS, where: Column | str | None = None) -> DataFrame:
    """One row; an empty table gives the beginning of time."""
    rows = stored.where(where) if where is not None else stored
    return rows.agg(F.coalesce(F.max(ts), naive(BEGINNING)).alias("LastTs"))


def with_cutoff(
    rows: DataFrame, stored: DataFrame, stored_ts: str = TS, per_symbol: bool = True, where: Column | str | None = None,
) -> DataFrame:
    """Add LastTs: the cutoff of the row's symbol, or the same one (a scalar subquery) for all."""
    if per_symbol:
        return rows.join(symbol_cutoffs(stored, stored_ts, where), KEY, "left")
    return rows.withColumn("LastTs", global_cutoff(stored, stored_ts, where).scalar())


def is_newer(ts: str = TS) -> Column:
    return F.col("LastTs").isNull() | (F.col(ts) > F.col("LastTs"))


def newer_rows(
    rows: DataFrame, stored: DataFrame, ts: str = TS, stored_ts: str = TS,
    per_symbol: bool = True, where: Column | str | None = None,
) -> DataFrame:
    """Rows later than the cutoff."""
    return with_cutoff(rows, stored, stored_ts, per_symbol, where).where(is_newer(ts)).drop("LastTs")


def newer_with_context(marked: DataFrame, before: int, ts: str = TS) -> DataFrame:
    """Rows after LastTs plus whole days that hold at least `before` earlier rows of the symbol.

    Row-count look-back has no fixed length in time, so the first day needed is found from
    counts per symbol and day; only those days go through the windows.
    """
    days = (
        marked.where(F.col(ts) <= F.col("LastTs"))
        .groupBy(KEY, F.to_date(ts).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    )
    later = Window.partitionBy(KEY).orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    first_day = (
        days.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0)))
        .where(F.col("_later") < before).groupBy(KEY).agg(F.min("_day").alias("_first"))
    )
    return (
        marked.join(first_day, KEY, "left")
        .where(F.col("_first").isNull() | (F.to_date(ts) >= F.col("_first"))).drop("_first")
    )


def day_ledger(inserted: DataFrame, raw: DataFrame, run: str, loaded: datetime) -> DataFrame:
    """Symbol, TradeDate, Rows, FirstTs, LastTs, Run, LoadTimestamp of the days that get `inserted` bars.

    Rows counts the day's bars in `raw` (partitioned by trade date) and the new ones, so a merge that died
    and runs again writes the same. Only the touched days of raw are read.
    """
    new = inserted.groupBy(KEY, F.to_date(TS).alias(TRADE_DATE)).agg(F.count(F.lit(1)).alias("_n"), F.min(TS).alias("FirstTs"), F.max(TS).alias("LastTs"))
    known = on_dates(raw, trade_dates(new)).groupBy(KEY, TRADE_DATE).agg(F.count(F.lit(1)).alias("_known"))
    return new.join(known, [KEY, TRADE_DATE], "left").select(
        KEY, TRADE_DATE, (F.col("_n") + F.coalesce("_known", F.lit(0))).alias("Rows"), "FirstTs", "LastTs", F.lit(run).alias("Run"), naive(loaded).alias("LoadTimestamp"),
    )


def day_rows(ledger: DataFrame) -> DataFrame:
    """Symbol, TradeDate, Rows as of the last merge that touched the day."""
    return ledger.groupBy(KEY, TRADE_DATE).agg(F.max_by("Rows", F.struct("LoadTimestamp", "Rows")).alias("Rows"))


def starts(ledger: DataFrame, runs: DataFrame, earlier_minutes: int = 0) -> DataFrame:
    """Symbol, FromTs: the first bar that the given runs brought, or some minutes before it."""
    first = F.min("FirstTs") - F.make_dt_interval(mins=F.lit(earlier_minutes))
    return ledger.join(runs, "Run", "left_semi").groupBy(KEY).agg(first.alias("FromTs"))


def days_needed(ledger: DataFrame, from_: DataFrame, before: int) -> DataFrame:
    """Symbol, TradeDate, FromTs: the days from FromTs on, and earlier ones until they hold `before` rows."""
    later = Window.partitionBy(KEY).orderBy(F.desc(TRADE_DATE)).rowsBetween(Window.unboundedPreceding, -1)
    first = F.to_date("FromTs")
    full = F.coalesce(F.sum(F.when(F.col(TRADE_DATE) < first, F.col("Rows"))).over(later), F.lit(0))
    marked = day_rows(ledger).join(from_, KEY).withColumn("_rows", full)
    return marked.where((F.col(TRADE_DATE) >= first) | (F.col("_rows") < before)).select(KEY, TRADE_DATE, "FromTs")


def days_since(ledger: DataFrame, from_: DataFrame, state: DataFrame) -> DataFrame:
    """Symbol, TradeDate of the symbols in `from_`: the days from a stored state's FromTs on, all days without one."""
    since = from_.select(KEY).join(state.select(KEY, F.to_date("FromTs").alias("_first")), KEY, "left")
    days = ledger.select(KEY, TRADE_DATE).distinct().join(since, KEY)
    return days.where(F.col("_first").isNull() | (F.col(TRADE_DATE) >= F.col("_first"))).drop("_first")


def trade_dates(rows: DataFrame) -> list[date]:
    """The distinct trade dates, on the driver: days of a calendar at most."""
    return sorted(r[0] for r in rows.select(TRADE_DATE).where(F.col(TRADE_DATE).isNotNull()).distinct().collect())


def on_dates(rows: DataFrame, dates: list[date]) -> DataFrame:
    """Rows of a table partitioned by trade date, from these partitions only."""
    return rows.where(F.col(TRADE_DATE).isin(dates))


def of_days(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """Rows (partitioned by trade date) of the needed symbols and days, with the columns of `needed`."""
    return on_dates(rows, trade_dates(needed)).join(needed, [KEY, TRADE_DATE])
