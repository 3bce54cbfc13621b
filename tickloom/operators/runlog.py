"""Metrics from run logs: many log files, one job.

Lines come as (run, line_no, value): one `run` per log, `line_no` anything that sorts in file
order.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.series import block_window, core_rows, with_blocks, with_row_index

# Phrases the pipeline logs write.
RUN_STARTED = "MASTER ORCHESTRATOR STARTED"
RUN_ENDED = "Completed: merge_feature.py"
ROWS_INGESTED = "Total rows inserted:"
SYMBOLS_INGESTED = "Total symbols processed:"
INGEST_SECONDS = "INGESTION COMPLETED in"
MERGED_INTO = ["Inserted", "tblRawPrices"]
MERGE_SECONDS = "MERGE COMPLETED in"
RAW_ROWS_AFTER = "Total rows in RawPrices after merge"
RAW_ROWS_BEFORE = r"Loaded [0-9,]+ price rows"
INDICATOR_ROWS = "Total computed indicator rows"
INDICATOR_SECONDS = "MASTER RUN COMPLETED in"
FEATURE_ROWS = "Merged dataset:"
FEATURE_SECONDS = "Insert step completed in"
FEATURE_SECONDS_NOT = "tblMergedFeatures"
SYMBOL_STARTED = r"Processing (\S+).*\(Backfill="
SYMBOL_DONE = "Ingestion completed in"
INDICATOR_DONE = r"Completed indicator (\S+)"
LINE_TIME = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})"

SLICE_LINES = 65_536


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """Log files as lines. Large files are read in splits: the split's offset orders the parts of
    a file, the increasing id the lines within a split."""
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"))
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("run"), place.alias("line_no"), "value")


def _slices(lines: DataFrame) -> Column:
    """Parts of a log in which lines are numbered: splits of a file, or ranges of line numbers."""
    split = isinstance(lines.schema["line_no"].dataType, T.StructType)
    return F.col("line_no.split") if split else F.expr(f"line_no div {SLICE_LINES}")


def line_time(value: Column) -> Column:
    text = F.regexp_extract(value, LINE_TIME, 1)
    return F.when(text != "", text).try_cast("timestamp_ntz")


def last_float(value: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(value, F.lit(r"\d+\.\d+"), F.lit(0)), F.lit(-1)).cast("double")


def last_integer(value: Column) -> Column:
    """Last whole number; thousands separators belong to the number."""
    found = F.regexp_extract_all(value, F.lit(r"\d+(?:,\d{3})*"), F.lit(0))
    return F.regexp_replace(F.try_element_at(found, F.lit(-1)), ",", "").cast("bigint")


def integer_before(value: Column, word: str) -> Column:
    """The number in front of a word: '1,234 rows, 56 columns' -> 1234 for 'rows'."""
    text = F.regexp_extract(value, rf"(\d+(?:,\d{{3}})*) {word}", 1)
    return F.when(text != "", F.regexp_replace(text, ",", "")).cast("bigint")


def parse_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumns({
        "ts": line_time(F.col("value")),
        "last_float": last_float(F.col("value")),
        "last_int": last_integer(F.col("value")),
    })


def _last(value: Column, condition: Column) -> Column:
    return F.max_by(value, F.when(condition, F.col("line_no")))


def stage_metrics(lines: DataFrame) -> DataFrame:
    """One row per run; of repeated phrases the last line counts. A single aggregation."""
    value = F.col("value")

    def has(*phrases: str) -> Column:
        tests = [value.contains(p) for p in phrases]
        return tests[0] if len(tests) == 1 else tests[0] & tests[1]

    whole, seconds = last_integer(value), last_float(value)
    return lines.groupBy("run").agg(
        F.coalesce(_last(whole, has(ROWS_INGESTED)), F.lit(0)).alias("ingest_rows"),
        F.coalesce(_last(whole, has(SYMBOLS_INGESTED)), F.lit(0)).alias("ingest_symbols"),
        _last(seconds, has(INGEST_SECONDS)).alias("ingest_runtime"),
        F.coalesce(_last(integer_before(value, "new rows"), has(*MERGED_INTO)), F.lit(0)).alias("merge_rows"),
        _last(seconds, has(MERGE_SECONDS)).alias("merge_runtime"),
        F.coalesce(_last(whole, has(INDICATOR_ROWS)), F.lit(0)).alias("indicator_rows"),
        _last(seconds, has(INDICATOR_SECONDS)).alias("indicator_runtime"),
        F.coalesce(_last(integer_before(value, "rows"), has(FEATURE_ROWS)), F.lit(0)).alias("feature_rows"),
        _last(seconds, has(FEATURE_SECONDS) & ~has(FEATURE_SECONDS_NOT)).alias("feature_runtime"),
        _last(integer_before(value, "price rows"), value.rlike(RAW_ROWS_BEFORE)).alias("raw_before"),
        _last(whole, has(RAW_ROWS_AFTER)).alias("raw_after"),
        F.timestamp_diff(
            "SECOND", _last(line_time(value), has(RUN_STARTED)), _last(line_time(value), has(RUN_ENDED))
        ).alias("total_runtime"),
    )


def symbol_durations(lines: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Ingest seconds per run and symbol.

    A done-line belongs to the start-line directly before it among the two kinds; the last
    start of a symbol decides. Only neighbouring markers matter, so long logs run in blocks.
    """
    symbol = F.regexp_extract("value", SYMBOL_STARTED, 1)
    done = F.col("value").contains(SYMBOL_DONE)
    markers = lines.select(
        "run", "line_no", F.when(symbol != "", symbol).alias("Symbol"),
        F.when(done, last_float(F.col("value"))).alias("seconds"), done.alias("done"),
    ).where(F.col("done") | F.col("Symbol").isNotNull())
    numbered = with_row_index(markers, "run", "line_no", _slices(lines))
    paired = with_blocks(numbered, after=1, rows=block_rows).withColumn(
        "duration", F.lead("seconds").over(block_window("run"))
    )
    return (
        core_rows(paired).where("Symbol IS NOT NULL").groupBy("run", "Symbol")
        .agg(F.max_by("duration", "line_no").alias("duration"))
    )


def indicator_runtimes(lines: DataFrame) -> DataFrame:
    """Mean seconds per run and indicator. The completion line names the indicator itself, so
    interleaved threads do not mix."""
    name = F.regexp_extract("value", INDICATOR_DONE, 1)
    done = lines.select("run", name.alias("IndicatorName"), last_float(F.col("value")).alias("seconds"))
    return done.where(F.col("IndicatorName") != "").groupBy("run", "IndicatorName").agg(
        F.count("seconds").alias("runs"), F.round(F.avg("seconds"), 2).alias("avg_seconds")
    )
