"""Writes. Every sink takes `write`; with write=False it returns what it would have written."""

from datetime import date, datetime
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import clip, finite, float_columns, naive, numeric_columns, to_double, to_timestamp
from tickloom.operators.incremental import trade_dates
from tickloom.schemas import BAR_COLUMNS, INDICATORS, KEY, MODEL_REGISTRY, SIGNAL_FEATURES, TRADE_DATE, TS
from tickloom.session import cut_lineage

FLOAT_LIMIT = 1e308


def run_id(prefix: str, started: datetime) -> str:
    """E.g. SIGNAL_20240131_093000."""
    return f"{prefix}_{started:%Y%m%d_%H%M%S}"


def _append(df: DataFrame, path: str, write: bool, partition_by: list[str] | None = None, mode: str = "append") -> DataFrame:
    if write:
        writer = df.write.mode(mode)
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df


def append_staging(
    bars: DataFrame, path: str, loaded: datetime, batch_id: str | None = None, write: bool = True
) -> DataFrame:
    """Stamp batch, load time and Exported = 0, then append. Partitioned by batch: a merge reads pending ones only."""
    stamped = bars.select(BAR_COLUMNS).withColumns({
        "BatchID": F.lit(batch_id or str(uuid4())),
        "LoadTimestamp": naive(loaded),
        "Exported": F.lit(0),
    })
    return _append(stamped, path, write, ["BatchID"])


def append_indicators(long: DataFrame, path: str, write: bool = True) -> DataFrame:
    """Partitioned by indicator, so a job that needs some indicators reads only those."""
    return _append(long.select([f.name for f in INDICATORS.fields]), path, write, ["IndicatorName"])


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to a fixed schema; unreadable numbers and times, NaN and infinity become NULL."""
    def one(f: T.StructField):
        x = F.col(f.name)
        if isinstance(f.dataType, T.NumericType):
            if isinstance(df.schema[f.name].dataType, T.BooleanType):
                x = x.cast("int")
            x = finite(to_double(x)).try_cast(f.dataType)
        elif isinstance(f.dataType, T.TimestampNTZType):
            x = to_timestamp(x)
        return x.alias(f.name)

    return df.select([one(f) for f in schema.fields])


def write_dated(dated: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Write by trade date: rows of a date go to a few files, however many tasks computed them."""
    dealt = dated.repartition(TRADE_DATE, F.pmod(F.hash(KEY), F.lit(32)))
    dealt.write.mode(mode).options(**options).partitionBy(TRADE_DATE).parquet(path)


def read_dates(spark: SparkSession, path: str, dates: list[date]) -> DataFrame | None:
    """Rows of some trade dates; no other file is listed or opened. None if there are none."""
    names = ",".join(f"{TRADE_DATE}={d:%Y-%m-%d}" for d in dates)
    try:
        return spark.read.option("basePath", path).option("mergeSchema", True).parquet(f"{path}/{{{names}}}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def replace_rows(fresh: DataFrame, path: str, keys: list[str], moment: str) -> None:
    """Put fresh rows in place of stored rows of the same keys, reading and rewriting only their trade dates.

    A job that dies before the dates are swapped leaves them as they were; run again it does the same.
    """
    dated = fresh.withColumn(TRADE_DATE, F.to_date(moment))
    dates = trade_dates(dated)
    if not dates:
        return
    stored = read_dates(fresh.sparkSession, path, dates)
    if stored is not None:
        kept = stored.join(dated.select(*keys), keys, "left_anti")
        dated = cut_lineage(kept.unionByName(dated, allowMissingColumns=True))  # read before the dates are replaced
    write_dated(dated, path, "overwrite", partitionOverwriteMode="dynamic")


def append_signals(frame: DataFrame, path: str, rebuild: bool = False, write: bool = True) -> DataFrame:
    """Append signal rows by trade date, or replace all of them with `rebuild`."""
    dated = coerce(frame, SIGNAL_FEATURES).withColumn(TRADE_DATE, F.to_date("FeatureTimestamp"))
    if write:
        write_dated(dated, path, "overwrite" if rebuild else "append")
    return dated.drop(TRADE_DATE)


def sanitise(df: DataFrame, limit: float = FLOAT_LIMIT) -> DataFrame:
    """Dynamic schema: infinity and NaN to NULL, then clip every floating-point column."""
    return df.withColumns({c: clip(finite(F.col(f"`{c}`")), limit) for c in float_columns(df)})


def append_labels(frame: DataFrame, path: str, rebuild: bool = False, write: bool = True) -> DataFrame:
    """Append labelled rows by trade date, or replace all of them with `rebuild`."""
    dated = sanitise(frame).withColumn(TRADE_DATE, F.to_date(TS))
    if write:
        write_dated(dated, path, "overwrite" if rebuild else "append")
    return dated.drop(TRADE_DATE)


def upsert(target: DataFrame, source: DataFrame, keys: tuple[str, ...] = (KEY, TS)) -> DataFrame:
    """New content of the target: matched rows take every source column, the rest is kept.

    The key pair is high-cardinality, so the anti-join spreads evenly. Source keys must be
    unique. Store the result with `commit_snapshot`; the path being read is never overwritten.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def prepare_merged(frame: DataFrame) -> DataFrame:
    """Merged features as stored: numbers finite, session flags 0/1."""
    flags = {f.name: F.col(f.name).cast("int") for f in frame.schema.fields if isinstance(f.dataType, T.BooleanType)}
    numbers = {c: finite(F.col(f"`{c}`")) for c in numeric_columns(frame) if c in float_columns(frame)}
    return frame.withColumns({**flags, **numbers})


def commit_snapshot(df: DataFrame, root: str, version: int, write: bool = True) -> DataFrame:
    """Write a full table version next to the others, then name it current.

    Readers see the old version until the last line; a job that dies before it changes nothing.
    """
    if write:
        df.write.mode("overwrite").parquet(f"{root}/data/version={version}")
        df.sparkSession.createDataFrame([(version,)], "version int").write.mode("append").parquet(f"{root}/versions")
    return df


def current_version(spark: SparkSession, root: str) -> int:
    return spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0]


def read_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/data/version={current_version(spark, root)}")


def register_model(spark: SparkSession, row: dict, path: str, write: bool = True) -> DataFrame:
    """One row of run metadata and metrics."""
    entry = spark.createDataFrame([tuple(row[f.name] for f in MODEL_REGISTRY.fields)], MODEL_REGISTRY)
    return _append(entry, path, write)
