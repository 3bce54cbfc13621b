"""Bars, staging rows and log lines derived from the sample tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import hour_bucket, minute_bucket
from tickloom.schemas import BAR_COLUMNS, KEY, TS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _volume():
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")


def event_bars(spark: SparkSession, sf_dir: str, unit: str = "hour") -> DataFrame:
    """One bar per event type and hour (or minute). The id breaks ties of equal time."""
    bucket = {"hour": hour_bucket, "minute": minute_bucket}[unit]
    order = F.struct("ts", "event_id")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias(KEY), bucket(F.col("ts")).alias(TS))
        .agg(
            F.min_by("value", order).alias("OpenPrice"),
            F.max("value").alias("HighPrice"),
            F.min("value").alias("LowPrice"),
            F.max_by("value", order).alias("ClosePrice"),
            F.sum(_volume()).alias("Volume"),
        )
    )


def shipping_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One daily unit-price bar per supplier; the volume data set."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey")
    return (
        table(spark, sf_dir, "lineitem").where("l_quantity > 0")
        .groupBy(F.col("l_suppkey").cast("string").alias(KEY), F.col("l_shipdate").alias(TS))
        .agg(
            F.min_by(price, order).alias("OpenPrice"),
            F.max(price).alias("HighPrice"),
            F.min(price).alias("LowPrice"),
            F.max_by(price, order).alias("ClosePrice"),
            F.sum("l_quantity").cast("bigint").alias("Volume"),
        )
        .select(BAR_COLUMNS)
    )


def event_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as staged ticks in seven batches, a quarter of them already exported."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias(KEY), F.col("ts").alias(TS),
        *[F.col("value").alias(c) for c in ("OpenPrice", "HighPrice", "LowPrice", "ClosePrice")],
        _volume().alias("Volume"),
        F.concat(F.lit("B"), (F.col("event_id") % 7).cast("string")).alias("BatchID"),
        F.col("ts").alias("LoadTimestamp"),
        F.when(F.col("event_id") % 4 == 0, 1).otherwise(0).alias("Exported"),
        F.col("event_id").alias("RowId"),
    )
