"""Scans of stored tables, with the columns and checks each job needs."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import naive
from tickloom.operators.incremental import newer_rows
from tickloom.operators.labels import REQUIRED, LabelSpec
from tickloom.schemas import BAR_COLUMNS, DEFINITIONS, INDICATORS, KEY, MERGED_SOURCE_COLUMNS, RAW_BARS, STAGING, TS


def read_raw_bars(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Raw bars; only the seven bar columns unless others are named."""
    return spark.read.schema(RAW_BARS).parquet(path).select(columns or BAR_COLUMNS)


def read_closes(spark: SparkSession, path: str) -> DataFrame:
    return read_raw_bars(spark, path, [KEY, TS, "ClosePrice"])


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGING).parquet(path)


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DEFINITIONS).parquet(path)


def read_indicators(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Long indicators. IndicatorName is the partition column of the stored table, so a filter on
    it reads only those indicators."""
    df = spark.read.schema(INDICATORS).parquet(path)
    return df.select(columns) if columns else df


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The 31 merged columns signal features are built from."""
    return spark.read.parquet(path).select(MERGED_SOURCE_COLUMNS)


def read_merged_since(spark: SparkSession, path: str, signals: DataFrame, per_symbol: bool = True) -> DataFrame:
    """Merged rows newer than the stored signal rows."""
    return newer_rows(read_merged(spark, path), signals, TS, "FeatureTimestamp", per_symbol)


def read_merged_all(spark: SparkSession, path: str) -> DataFrame:
    """Every merged column, whatever indicators it holds; fails without the required ones."""
    return require_columns(spark.read.parquet(path), REQUIRED)


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def read_labelled(spark: SparkSession, path: str, spec: LabelSpec) -> DataFrame:
    """Rows of one horizon, label type and pair of versions; the filter reaches the scan."""
    return labelled(spark, path).where(spec.matches())


def labelled(spark: SparkSession, path: str) -> DataFrame:
    """Labelled features of all runs; runs with other feature columns add theirs."""
    return spark.read.option("mergeSchema", True).parquet(path)


def in_date_range(bars: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """start <= time < end."""
    ts = F.col(TS)
    return bars.where((ts >= naive(start)) & (ts < naive(end)))


def first_rows(df: DataFrame, symbol: str, n: int = 2000, ts: str = TS) -> DataFrame:
    """The first n rows of one symbol in time order: a preview."""
    return df.where(F.col(KEY) == symbol).orderBy(ts).limit(n)


def empty_like(df: DataFrame) -> DataFrame:
    """Same columns, no rows."""
    return df.limit(0)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def column_report(df: DataFrame, table: str) -> DataFrame:
    """One row per column: name, position, type, length of text types and nullability."""
    rows = [
        (table, f.name, i, f.dataType.simpleString(), getattr(f.dataType, "length", None), f.nullable)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    schema = T.StructType([
        T.StructField("TableName", T.StringType()), T.StructField("ColumnName", T.StringType()),
        T.StructField("OrdinalPosition", T.IntegerType()), T.StructField("DataType", T.StringType()),
        T.StructField("MaximumLength", T.IntegerType()), T.StructField("IsNullable", T.BooleanType()),
    ])
    return df.sparkSession.createDataFrame(rows, schema)
