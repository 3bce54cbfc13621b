"""Scalar column helpers. All of them stay inside generated JVM code."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nz(x: Column) -> Column:
    """A divisor that turns zero into NULL, so a division never raises or gives infinity."""
    return F.when(x != 0, x)


def to_double(x: Column) -> Column:
    """Text or number to double; what cannot be read becomes NULL."""
    return x.try_cast("double")


def drop_nan(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def drop_infinite(x: Column) -> Column:
    """Infinity becomes NULL, every other value stays."""
    return F.when(F.abs(x) != float("inf"), x)


def finite(x: Column) -> Column:
    """NaN and both infinities become NULL (NaN sorts above infinity in Spark)."""
    return F.when(F.abs(x) < float("inf"), x)


def clip(x: Column, bound: float = 1e308) -> Column:
    """Limit to [-bound, bound]; NULL stays NULL (greatest and least alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(-bound), F.least(x, F.lit(bound))))


def to_timestamp(x: Column) -> Column:
    """Text to naive timestamp; what cannot be read becomes NULL."""
    return x.try_cast("timestamp_ntz")


def naive(moment: datetime) -> Column:
    """A wall-clock time as a column. Spelled as text: a datetime literal would be an instant and
    shift with the session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def exchange_time(ts: Column, source_zone: str = "UTC", zone: str = "America/New_York") -> Column:
    """Naive time in `source_zone` to naive exchange wall clock."""
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), ts)


def exchange_time_of_text(text: Column, source_zone: str | None = "UTC", zone: str = "America/New_York") -> Column:
    """Text to naive exchange wall clock; what cannot be read becomes NULL.

    A time that carries a zone (Z or an offset) is an instant and converted from that zone. Other times are
    in `source_zone`, or exchange time already when that is None.
    """
    plain = to_timestamp(text)
    aware = text.rlike(r"\d:\d\d.*(Z|[+-]\d{1,2}(:?\d{2})?)\s*$")
    since_epoch = F.make_dt_interval(secs=(F.unix_micros(text.try_cast("timestamp")) / 1_000_000).cast("decimal(18,6)"))
    in_utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since_epoch  # does not depend on the session zone
    return F.when(aware, exchange_time(in_utc, "UTC", zone)).otherwise(exchange_time(plain, source_zone, zone) if source_zone else plain)


def minute_bucket(ts: Column) -> Column:
    """Start of the minute. Interval arithmetic keeps naive time free of the session zone."""
    return ts - F.make_dt_interval(secs=F.date_part(F.lit("SECOND"), ts))


def hour_bucket(ts: Column) -> Column:
    return ts - F.make_dt_interval(mins=F.minute(ts), secs=F.date_part(F.lit("SECOND"), ts))


def minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def in_market_hours(ts: Column, first_hour: int = 9, last_hour: int = 16) -> Column:
    """True from first_hour:00 to last_hour:59."""
    return F.hour(ts).between(first_hour, last_hour)


def day_of_week(ts: Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(ts) + 1


def session_type(ts: Column) -> Column:
    """0 outside the session, 1 opening hour, 2 midday, 3 closing hour."""
    hour = F.hour(ts)
    return (
        F.when((hour < 9) | (hour >= 16), 0)
        .when(hour == 9, 1)
        .when(hour == 15, 3)
        .otherwise(2)
    )


def field_name(name: Column, param: Column) -> Column:
    return F.concat_ws("_", name, param)


def _count_true(tests: list[Column]) -> Column:
    return sum((test.cast("int") for test in tests), F.lit(0))


def null_count(columns: list[str]) -> Column:
    """Number of NULLs over the named columns of one row."""
    return _count_true([F.col(f"`{c}`").isNull() for c in columns])


def present_count(columns: list[str]) -> Column:
    return _count_true([F.col(f"`{c}`").isNotNull() for c in columns])


def days_from_text(days: Column, default: int = 7) -> Column:
    """'30 days' -> 30; text without digits gives the default."""
    digits = F.regexp_replace(F.upper(days.cast("string")), "[^0-9]", "")
    return F.coalesce(F.when(digits != "", digits), F.lit(str(default))).cast("int")


def run_day_prefix(prefix: str, asof: Column) -> Column:
    """Run-id prefix of one day, e.g. SIGNAL_20240131."""
    return F.concat(F.lit(prefix), F.date_format(asof, "yyyyMMdd"))


def clean_header(name: str) -> str:
    """' Adj Close ' -> 'Adjclose': trimmed, no spaces, first letter upper."""
    return name.strip().replace(" ", "").capitalize()


def clean_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(name) for name in df.columns])


def numeric_columns(df: DataFrame, exclude: list[str] | tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.FractionalType)]


def clean_infinities(df: DataFrame) -> DataFrame:
    """Infinity and NaN become NULL in every floating-point column."""
    return df.withColumns({name: finite(F.col(f"`{name}`")) for name in float_columns(df)})
