"""Long indicators to wide, joined to bars with calendar flags and counts."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import day_of_week, drop_nan, in_market_hours, naive, null_count, present_count, to_double
from tickloom.schemas import BAR_COLUMNS, CALENDAR_FIELDS, KEY, RUN_FIELDS, TS


def pivot_last(long: DataFrame, fields: list[str]) -> DataFrame:
    """(Symbol, time) x FieldName; of several values the latest added wins, then the higher id.

    `fields` comes from the definitions, so the pivot needs no pass to discover its columns.
    """
    latest = F.struct("addDateTime", "IndicatorId")
    return (
        long.where(F.col("IndicatorValue").isNotNull())
        .groupBy(KEY, TS).pivot("FieldName", fields).agg(F.max_by("IndicatorValue", latest))
    )


def indicator_columns(df: DataFrame) -> list[str]:
    """Every column that is neither bar, calendar flag nor run information."""
    known = {*BAR_COLUMNS, *CALENDAR_FIELDS, *RUN_FIELDS}
    return [c for c in df.columns if c not in known]


def with_calendar(df: DataFrame) -> DataFrame:
    regular = in_market_hours(F.col(TS))
    return df.withColumns({
        "DayOfWeek": day_of_week(F.col(TS)), "IsRegularSession": regular, "IsAfterHours": ~regular,
    })


def merge_indicators(bars: DataFrame, wide: DataFrame, run_id: str, run_ts: datetime) -> DataFrame:
    """Bars left-joined to the wide indicators; counts of present and missing indicators."""
    joined = bars.select(BAR_COLUMNS).join(wide, [KEY, TS], "left")
    fields = indicator_columns(joined)
    return (
        with_calendar(joined)
        .withColumns({"RunTimestamp": naive(run_ts), "MergeRunId": F.lit(run_id)})
        .withColumns({c: drop_nan(to_double(F.col(f"`{c}`"))) for c in fields})
        .withColumns({"SourceIndicatorCount": present_count(fields), "MissingIndicatorCount": null_count(fields)})
    )
