"""One query per operator group, each over whole tables."""

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import scalars as S
from tickloom.operators import incremental, labels, merged, quality, runlog, signals, staging, training
from tickloom.operators.engineered import add_engineered_features
from tickloom.operators.indicators import indicators, resume_indicators
from tickloom.operators.registry import indicator_long
from tickloom.plans.jobs import feature_frame
from tickloom.schemas import BAR_COLUMNS, DEFINITIONS, FEATURE_SET_MEMBERS, FEATURE_SETS, INDICATOR_FIELDS, KEY, TS
from tickloom.session import cut_lineage
from tickloom.sources import sinks, tables, vendor
from tickloom.sources.sample import event_bars, event_staging, shipping_bars, table

# Settings tables and times the SQL repeats.
DEFINITION_ROWS = [
    (1, "SMA", "20", 1), (2, "SMA", "200", 1), (3, "EMA", "9", 1), (4, "EMA", "20", 1), (5, "EMA", "50", 1),
    (6, "EMA", "200", 1), (7, "RSI", "14", 1), (8, "ATR", "14", 1), (9, "ADX", "14", 1), (10, "CCI", "20", 1),
    (11, "BBANDS_UPPER", "20", 1), (12, "BBANDS_MIDDLE", "20", 1), (13, "BBANDS_LOWER", "20", 1),
    (14, "STOCH_K", "14", 1), (15, "STOCH_D", "14", 1), (16, "BOLL_WIDTH", "20", 1), (17, "BOLL_PCTB", "20", 1),
    (18, "WILLIAMS_R", "14", 1), (19, "SUPERTREND", "10", 1), (20, "MACD", "0", 0), (21, "OBV", "0", 0),
    (22, "ROC", "12", 0), (23, "VWAP", "0", 0),
]
ACTIVE = [(name, int(param)) for _, name, param, active in DEFINITION_ROWS if active]
FEATURE_SET_ROWS = [(1, 0), (2, 1)]
MEMBER_ROWS = [
    (1, "SMA_20", 1), (2, "RSI_14", 1), (2, "Return_t_norm", 2), (2, "BBWidth_norm", 3), (2, "Volume_rel", 4),
    (2, "Not_There", 5),
]
ASOF = datetime(2024, 1, 16)
RUN_TS = datetime(2024, 1, 31)
SPEC = labels.LabelSpec(300, "DIRECTION_300M")
SHOWN_TABLES = ["customer", "events", "lineitem", "orders"]
JUMP_SPANS = [2, 3, 5, 20, 5000]
BLOCK = 512  # small blocks, so that the sample data spans several


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in S.float_columns(df)})


def definitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFINITION_ROWS, DEFINITIONS)


def feature_sets(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame(FEATURE_SET_ROWS, FEATURE_SETS), spark.createDataFrame(MEMBER_ROWS, FEATURE_SET_MEMBERS)


# --- derived tables -------------------------------------------------------------------------

def wide(spark, d) -> DataFrame:
    """Bars with every active indicator; they are already side by side, so no pivot is needed."""
    bars = event_bars(spark, d)
    return indicators(bars, ACTIVE, keep=BAR_COLUMNS, cut=True, gaps=False)


def with_flags(df: DataFrame) -> DataFrame:
    """The columns signals need beside bars and indicators, without a second join."""
    fields = merged.indicator_columns(df)
    return merged.with_calendar(df).withColumns({
        "SourceIndicatorCount": S.present_count(fields), "MissingIndicatorCount": S.null_count(fields),
    })


def raw_minutes(spark, d) -> DataFrame:
    """The raw table after earlier merges: exported ticks, one per minute."""
    return staging.newest_per_minute(event_staging(spark, d).where("Exported = 1"))


def market_staging(spark, d) -> DataFrame:
    """Staging of a vendor that only sends market hours."""
    return event_staging(spark, d).where(S.in_market_hours(F.col(TS)))


def vendor_download(spark, d) -> DataFrame:
    """Ticks as a vendor file: text columns and untidy headers."""
    text = F.col("value").cast("string")
    return table(spark, d, "events").select(
        F.col("event_type").alias(" symbol"), F.col("ts").cast("string").alias("Date time"),
        text.alias("open "), text.alias("high"), text.alias("low"), text.alias("Close"), text.alias("adj close"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("volume"),
    )


def symbol_text(spark, d) -> DataFrame:
    """Symbols with back-fill days as people type them."""
    size = F.length("event_type")
    days = F.when(size % 2 == 0, F.concat(size.cast("string"), F.lit(" d"))).otherwise("all")
    return table(spark, d, "events").select(F.col("event_type").alias(KEY), days.alias("Days")).distinct()


def exported_before_asof(spark, d) -> DataFrame:
    return event_staging(spark, d).where(F.col(TS) < S.naive(ASOF))


def labelled(spark, d) -> DataFrame:
    bars = event_bars(spark, d)
    return labels.label_frame(bars, bars, SPEC, "LABEL_20240131_000000", RUN_TS)


def scored(spark, d) -> DataFrame:
    """Labels with a rule as the classifier: the sign of the last return."""
    guess = F.coalesce(F.signum("Return_1"), F.lit(0)).cast("int").alias("Prediction")
    returns = signals.signal_metrics(event_bars(spark, d)).select(KEY, TS, guess)
    return labelled(spark, d).select(KEY, TS, "Label").join(returns, [KEY, TS])


def log_lines(spark, d) -> DataFrame:
    """One log line per event; each event type is a run."""
    value = F.format_string("%.2f", "value")
    user = F.concat(F.lit("U"), (F.col("user_id") % 7).cast("string"))
    kind = F.element_at(F.array(*map(F.lit, ["SMA", "EMA", "RSI", "ADX", "OBV"])), (F.col("user_id") % 5 + 1).cast("int"))
    number = F.regexp_extract("props", "([0-9]+)", 1)
    texts = [
        F.concat(F.lit("=== Processing "), user, F.lit(" (Backfill=7 days) ===")),
        F.concat(user, F.lit(": Ingestion completed in "), value, F.lit(" seconds.")),
        F.concat(F.lit("Completed indicator "), kind, F.lit(" with "), number, F.lit(" rows in "), value, F.lit(" seconds.")),
        F.concat(F.lit("Total rows inserted:     "), number),
        F.concat(F.lit("Inserted "), number, F.lit(" new rows into tblRawPrices.")),
        F.concat(F.lit("=== MERGE COMPLETED in "), value, F.lit(" seconds ===")),
        F.concat(F.lit("Merged dataset: 1,"), F.lpad(number, 3, "0"), F.lit(" rows, 56 columns.")),
        F.lit("=== MASTER ORCHESTRATOR STARTED ==="),
        F.lit("Completed: merge_feature.py"),
        F.concat(F.lit("Loaded 31,"), F.lpad(number, 3, "0"), F.lit(" price rows.")),
        F.concat(F.lit("Total rows in RawPrices after merge: "), number),
        F.concat(F.lit("Total computed indicator rows: "), number),
        F.concat(F.lit("Insert step completed in "), value, F.lit(" seconds.")),
    ]
    chosen = F.coalesce(*[F.when(F.col("event_id") % len(texts) == i, text) for i, text in enumerate(texts)])
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, d, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("line_no"),
        F.concat(stamp, F.lit(" [INFO] "), chosen).alias("value"),
    )


# --- queries --------------------------------------------------------------------------------

def _indicator(*wanted: tuple[str, int], unit: str = "hour", digits: int = 6, **options):
    def query(spark, d):
        return rounded(indicators(event_bars(spark, d, unit), wanted, gaps=False, **options), digits)

    return query


def ind_ema_gaps(spark, d):
    """Weighted means over closes some of which are missing: they repeat there, and weights fall over the gap."""
    close = F.when(F.col("Volume") % 7 != 3, F.col("ClosePrice"))
    bars = event_bars(spark, d, "minute").withColumn("ClosePrice", close)
    return rounded(indicators(bars, [("EMA", 2), ("EMA", 9), ("EMA", 200), ("MACD", 0), ("ATR", 14)], block_rows=BLOCK))


def ind_ema_jump(spark, d):
    """Means of any span after values that outweigh all others, as logarithms."""
    close = F.when(F.col("Volume") % 23 == 5, F.lit(1e30)).otherwise(F.col("ClosePrice"))
    wide_ = indicators(event_bars(spark, d, "minute").withColumn("ClosePrice", close), [("EMA", n) for n in JUMP_SPANS], block_rows=BLOCK)
    return wide_.select(KEY, TS, *[F.round(F.log(f"EMA_{n}"), 6).alias(f"LN_EMA_{n}") for n in JUMP_SPANS])


def bars_hourly(spark, d):
    return event_bars(spark, d)


def bars_minute(spark, d):
    return event_bars(spark, d, "minute")


def bars_daily(spark, d):
    return shipping_bars(spark, d)


def flagship(spark, d):
    """Moving average, bands, RSI and one-bar return in one blocked pass."""
    return rounded(indicators(
        event_bars(spark, d), [("SMA", 20), ("BBANDS_UPPER", 20), ("BBANDS_LOWER", 20), ("RSI", 14), ("ROC", 1)], ["ClosePrice"]
    ))


def ind_daily(spark, d):
    """Several indicators over the daily bars, the larger data set."""
    wanted = [("SMA", 20), ("SMA", 200), ("EMA", 20), ("RSI", 14), ("ATR", 14), ("WILLIAMS_R", 14)]
    return rounded(indicators(shipping_bars(spark, d), wanted, cut=True, gaps=False))


def ind_resumed(spark, d):
    """All active indicators: bars before a time in one run, the later ones in a second that starts from its state."""
    bars, late = event_bars(spark, d), F.col(TS) >= S.naive(ASOF)
    before, state = resume_indicators(bars.where(~late), ACTIVE, block_rows=BLOCK // 2, gaps=False)
    after, _ = resume_indicators(bars, ACTIVE, state, block_rows=BLOCK // 2, gaps=False)
    return rounded(before.unionByName(after.where(late)))


def ind_long_registry(spark, d):
    return rounded(indicator_long(event_bars(spark, d), definitions(spark), cut=True, gaps=False).drop("addDateTime"))


def ind_pivot_merge(spark, d):
    """Long table and back: pivot, join to bars, calendar flags, counts."""
    bars = event_bars(spark, d)
    long = indicator_long(bars, definitions(spark), added=RUN_TS, cut=True, gaps=False)
    wide_again = merged.pivot_last(long, INDICATOR_FIELDS)
    return rounded(merged.merge_indicators(bars, wide_again, "MERGE_20240131_000000", RUN_TS))


def _features(group: str, columns: list[str]):
    def query(spark, d):
        needs = [group] if group != "compression" else ["normalised", group]
        return rounded(add_engineered_features(wide(spark, d), needs, BLOCK).select(KEY, TS, *columns))

    return query


def feat_all(spark, d):
    """The merged feature frame from long indicators, every engineered column."""
    bars = event_bars(spark, d)
    long = indicator_long(bars, definitions(spark), added=RUN_TS, cut=True, gaps=False)
    return rounded(feature_frame(bars, long, INDICATOR_FIELDS, "MERGE_20240131_000000", RUN_TS))


def sig_features(spark, d):
    return rounded(signals.signal_frame(with_flags(wide(spark, d)), "SIGNAL_20240131_000000", RUN_TS))


def _signals_before_asof(spark, d) -> DataFrame:
    bars = event_bars(spark, d)
    return bars.where(F.col(TS) < S.naive(ASOF)).select(KEY, F.col(TS).alias("FeatureTimestamp"))


def sig_incremental(spark, d):
    source = with_flags(wide(spark, d))
    frame = signals.signal_incremental(source, _signals_before_asof(spark, d), "SIGNAL_20240131_000000", RUN_TS)
    return rounded(frame.select(KEY, "FeatureTimestamp", *signals.SIGNAL_METRICS, "Target", "MissingFeatureCount"))


def sig_incremental_global(spark, d):
    """Bars later than the newest stored signal of any symbol."""
    return incremental.newer_rows(event_bars(spark, d), _signals_before_asof(spark, d), TS, "FeatureTimestamp", False)


def sig_reopened(spark, d):
    """The newest stored bar per symbol, now with its Target."""
    frame = signals.reopen_last_bars(with_flags(wide(spark, d)), _signals_before_asof(spark, d), "SIGNAL_20240131_000000", RUN_TS)
    return rounded(frame.select(KEY, "FeatureTimestamp", "Return_20", "Volatility_20", "Target"))


def label_horizon(spark, d):
    return rounded(labelled(spark, d))


def label_minute(spark, d):
    """Sparse case: minute bars, most of which have no bar five minutes later."""
    return labels.future_close(event_bars(spark, d, "minute"), 5)


def label_incremental(spark, d):
    bars = event_bars(spark, d)
    stored = labelled(spark, d).where(F.col(TS) < S.naive(ASOF))
    frame = labels.label_incremental(bars, bars, stored, SPEC, "LABEL_20240131_000000", RUN_TS)
    return rounded(frame.select(KEY, TS, "Close_t", "FutureClose_tN", "Return_t_to_tN", "Label", "IsTrainableRow"))


def label_scan(spark, d):
    """Labels of one horizon, type and versions, by class."""
    return labelled(spark, d).where(SPEC.matches()).groupBy("Label").agg(F.count(F.lit(1)).alias("n"))


def stage_gate(spark, d):
    return staging.gate(event_staging(spark, d))


def stage_pending(spark, d):
    return staging.pending_per_symbol(event_staging(spark, d))


def stage_dedup(spark, d):
    return staging.stage_dedup(event_staging(spark, d))


def stage_insert_new(spark, d):
    return staging.new_only(staging.stage_dedup(event_staging(spark, d)), raw_minutes(spark, d))


def stage_merge_summary(spark, d):
    staged, raw = market_staging(spark, d), raw_minutes(spark, d)
    return staging.merge_staging(staged, raw).summary


def stage_merge_snapshot(spark, d):
    return staging.merge_staging(market_staging(spark, d), raw_minutes(spark, d)).raw


def stage_exported(spark, d):
    """Staging after the merge, counted by batch and mark."""
    after = staging.merge_staging(market_staging(spark, d), raw_minutes(spark, d)).staging
    return after.groupBy("BatchID", "Exported").agg(F.count(F.lit(1)).alias("n"))


def raw_dedup(spark, d):
    return staging.raw_dedup(event_staging(spark, d))


def stage_recent(spark, d):
    return staging.recently_loaded(event_staging(spark, d), ASOF, 24 * 60)


def upsert_features(spark, d):
    """Stored rows of the first half, new rows from the last days of it on with other values."""
    bars = event_bars(spark, d)
    start = S.naive(ASOF)
    target = bars.where(F.col(TS) < start)
    source = bars.where(F.col(TS) >= start - F.make_dt_interval(days=F.lit(3))).withColumn("ClosePrice", F.col("ClosePrice") + 1)
    return rounded(sinks.upsert(target, source))


def ingest_offsets(spark, d):
    """Vendor times with offsets, with Z and without zone, winter and summer, as exchange time."""
    utc = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    summer = F.date_format((F.col("ts") + F.make_dt_interval(days=F.lit(180))).cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    kind = F.col("event_id") % 4
    text = F.when(kind == 0, F.concat(utc, F.lit("+00:00"))).when(kind == 1, F.concat(summer, F.lit("-05:00"))).when(kind == 2, F.concat(summer, F.lit("Z"))).otherwise(utc)
    return table(spark, d, "events").select("event_id", S.exchange_time_of_text(text).alias("exchange_ts"))


def _with_faults(spark, d) -> DataFrame:
    """Staging in which some rows lack time, symbol or a price."""
    k = F.col("Volume") % 11
    return market_staging(spark, d).withColumns({
        TS: F.when(k != 3, F.col(TS)), KEY: F.when(k != 5, F.col(KEY)), "ClosePrice": F.when(k != 7, F.col("ClosePrice")),
    })


def stage_rejects(spark, d):
    staged = _with_faults(spark, d)
    return staging.merge_summary(staged, staged.limit(0), staging.stage_dedup(staged), staging.stage_dedup(staged))


def ingest_filter(spark, d):
    bars = vendor.vendor_bars(_vendor_named(spark, d))
    return vendor.ingest(bars, exported_before_asof(spark, d))


def _vendor_named(spark, d) -> DataFrame:
    return S.clean_headers(vendor_download(spark, d))


def ingest_backfill(spark, d):
    bars = vendor.vendor_bars(_vendor_named(spark, d))
    known = exported_before_asof(spark, d).where(F.length(KEY) > 5)
    return vendor.ingest(bars, known, vendor.symbol_days(symbol_text(spark, d)))


def ingest_range(spark, d):
    bars = vendor.vendor_bars(_vendor_named(spark, d))
    return vendor.ingest(bars, exported_before_asof(spark, d), date_range=(datetime(2024, 1, 5), datetime(2024, 1, 12)))


def ingest_summary(spark, d):
    return vendor.ingest_summary(event_bars(spark, d, "minute"))


def ingest_per_date(spark, d):
    return vendor.rows_per_date(event_bars(spark, d, "minute"))


def symbols_days(spark, d):
    text = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).otherwise(F.concat_ws(" ", "c_mktsegment", "c_nationkey"))
    return vendor.symbol_days(table(spark, d, "customer").select(F.col("c_name").alias(KEY), text.alias("Days")))


def dq_dupe_keys(spark, d):
    return quality.duplicate_keys(table(spark, d, "lineitem"), ["l_suppkey", "l_shipdate"], "lineitem")


def dq_dupe_indicators(spark, d):
    """Indicator keys of a table of all active definitions that got one of them twice."""
    bars, one = event_bars(spark, d), definitions(spark)
    long = indicator_long(bars, one, gaps=False).unionByName(indicator_long(bars, one.where("IndicatorId = 7"), gaps=False))
    return quality.duplicate_keys(long, [KEY, TS, "IndicatorId"], "indicators")


def dq_dupe_rows(spark, d):
    return quality.duplicate_rows(event_staging(spark, d))


def dq_dupe_rows_exported(spark, d):
    return quality.duplicate_rows(event_staging(spark, d), exported_only=True)


def dq_minute_dupes(spark, d):
    return quality.minute_duplicates(event_staging(spark, d))


def dq_daily(spark, d):
    return quality.rows_per_day(event_bars(spark, d))


def dq_daily_symbol(spark, d):
    return quality.rows_per_day_symbol(event_bars(spark, d))


def dq_low_coverage(spark, d):
    return quality.low_coverage(event_bars(spark, d), threshold=24)


def dq_inserted_today(spark, d):
    return quality.inserted_since(event_staging(spark, d), ASOF, "LoadTimestamp")


def dq_inserted_by_run(spark, d):
    runs = event_staging(spark, d).select(F.concat(F.lit("SIGNAL_"), F.date_format("LoadTimestamp", "yyyyMMdd_HHmmss")).alias("FeatureRunId"))
    return quality.inserted_by_run(runs, ASOF)


def dq_rows_between(spark, d):
    start = S.naive(ASOF)
    return quality.rows_between(event_staging(spark, d), start, start + F.make_dt_interval(days=F.lit(2)), "LoadTimestamp")


def dq_ranges(spark, d):
    """Counts over ticks whose price or volume is zero or below."""
    shifted = event_staging(spark, d).withColumns({c: F.col(c) - 5 for c in ("OpenPrice", "ClosePrice", "Volume")})
    return quality.range_violations(shifted)


def dq_nulls(spark, d):
    holes = event_staging(spark, d).withColumn("ClosePrice", F.when(F.col("ClosePrice") >= 1, F.col("ClosePrice")))
    return quality.null_counts(holes, BAR_COLUMNS)


def dq_rowcount(spark, d):
    return quality.row_count(event_bars(spark, d))


def _even_hours(bars: DataFrame) -> DataFrame:
    return bars.where(F.hour(TS) % 2 == 0)


def dq_orphans(spark, d):
    bars = event_bars(spark, d)
    return quality.orphan_count(indicator_long(bars, definitions(spark), gaps=False), _even_hours(bars))


def dq_table_counts(spark, d):
    bars = event_bars(spark, d)
    long = indicator_long(bars, definitions(spark), gaps=False)
    return quality.table_counts({
        "staging": (event_staging(spark, d), TS), "raw_bars": (raw_minutes(spark, d), TS), "indicators": (long, TS),
        "merged_features": (bars, TS), "signal_features": (_signals_before_asof(spark, d), "FeatureTimestamp"),
    }, ASOF)


def dq_report_missing(spark, d):
    """Raw bars are there, the indicator table is not."""
    return quality.quality_report(event_bars(spark, d), None)


def dq_report(spark, d):
    bars = event_bars(spark, d)
    long = indicator_long(bars, definitions(spark), gaps=False)
    return quality.quality_report(bars, long)


def sanitise_numeric(spark, d):
    """Text with unreadable, infinite and missing numbers, coerced and cleaned."""
    pick = (F.col("event_id") % 6).cast("int")
    text = F.element_at(F.array(F.col("value").cast("string"), *map(F.lit, ["abc", "Infinity", "-Infinity", "NaN", ""])), pick + 1)
    when = F.when(pick == 1, F.lit("yesterday")).otherwise(F.col("ts").cast("string"))
    number = S.to_double(text)
    return table(spark, d, "events").select(
        "event_id",
        S.drop_infinite(S.drop_nan(number)).alias("without_infinity"),
        S.finite(number).alias("clean"),
        S.clip(S.drop_nan(number), 100.0).alias("clipped"),
        S.to_timestamp(when).alias("at"),
        S.flag(number > 50).alias("above"),
        (F.col("value") > 50).cast("int").alias("as_int"),
    )


def calendar_fields(spark, d):
    ts = F.col("ts")
    return table(spark, d, "events").select(
        "event_id", S.minute_bucket(ts).alias("minute_start"), S.exchange_time(ts).alias("exchange_ts"),
        S.in_market_hours(ts).alias("regular"), S.day_of_week(ts).alias("day_of_week"),
        F.hour(ts).alias("hour_of_day"), F.minute(ts).alias("minute_of_hour"), S.session_type(ts).alias("session_type"),
        F.to_date(ts).alias("trade_date"), S.field_name(F.col("event_type"), F.col("user_id")).alias("field_name"),
    )


def schema_columns(spark, d):
    """Columns of stored tables: name, position, type, length and nullability."""
    return reduce(DataFrame.unionByName, [tables.column_report(table(spark, d, name), name) for name in SHOWN_TABLES])


def preview_top_n(spark, d):
    return tables.first_rows(event_bars(spark, d), "click", 2000)


def fs_active(spark, d):
    """Active features that exist, in order, with the number of rows that have a value."""
    frame = add_engineered_features(wide(spark, d), ["normalised", "compression", "volume"])
    sets, members = feature_sets(spark)
    training.active_feature_set(sets)
    names, _ = training.select_features(frame, training.feature_list(sets, members))
    counted = frame.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "FeatureName", "NonNullRows")
    return counted.join(training.active_features(sets, members), "FeatureName").select("FeatureName", "Ordinal", "NonNullRows")


def train_split(spark, d):
    return training.ordered_split(labelled(spark, d).select(KEY, TS, "Label"))


def train_split_symbol(spark, d):
    return training.ordered_split(labelled(spark, d).select(KEY, TS, "Label"), order="symbol")


def class_weights(spark, d):
    return rounded(training.class_weights(labelled(spark, d)))


def eval_accuracy(spark, d):
    split = training.ordered_split(scored(spark, d))
    return rounded(split.groupBy("is_train").agg(training.accuracy().alias("accuracy"), F.count(F.lit(1)).alias("n")))


def eval_confusion(spark, d):
    return training.confusion_matrix(scored(spark, d))


def eval_report(spark, d):
    return rounded(training.classification_report(scored(spark, d)))


def _training_rows(spark, d) -> tuple[DataFrame, list[str]]:
    frame = signals.signal_metrics(event_bars(spark, d))
    rows = labels.label_frame(frame, frame, SPEC, "TRAIN_20240131_000000", RUN_TS).where("IsTrainableRow = 1")
    features = ["Range_Pct", "Return_1", "Return_5", "Momentum_10", "Volatility_20"]
    return cut_lineage(training.ordered_split(rows.select(KEY, TS, "Label", *features))), features


def train_fit(spark, d):
    """A short boosted model (the full one is the default of TrainSettings), scored on the test rows."""
    rows, features = _training_rows(spark, d)
    model = training.fit(rows.where("is_train"), features, training.TrainSettings(rounds=3, depth=3))
    test = rows.where(~F.col("is_train"))
    return training.predict(model, test, features).select(KEY, TS, "Label", "Prediction")


def train_importance(spark, d):
    rows, features = _training_rows(spark, d)
    model = training.fit(rows.where("is_train"), features, training.TrainSettings(rounds=3, depth=3))
    return training.permutation_importance(model, rows.where(~F.col("is_train")), features)


def runlog_stages(spark, d):
    return runlog.stage_metrics(log_lines(spark, d))


def runlog_symbols(spark, d):
    return runlog.symbol_durations(log_lines(spark, d), BLOCK)


def runlog_indicators(spark, d):
    return runlog.indicator_runtimes(log_lines(spark, d))


NORMALISED = ["Return_t_norm", "CandleBody_norm", "Range_norm", "UpperWick_norm", "LowerWick_norm"]
TREND = ["EMA20_minus_EMA200", "EMA9_minus_EMA20", "SMA20_minus_SMA200", "Close_minus_EMA20", "Close_minus_EMA200"]
REGIME = ["Volatility_regime", "Trend_regime", "HourOfDay", "MinuteOfHour", "SessionType"]
COMPRESSION = ["BBWidth", "BBWidth_norm", "Range_vs_ATR", "RollingRangeCompression"]
MOMENTUM = ["Return_zscore", "WilliamsR_smoothed"]
VOLUME = ["Volume_rel", "Volume_spike", "Volume_percentile"]

QUERIES = {
    "bars_hourly": bars_hourly,
    "bars_minute": bars_minute,
    "bars_daily": bars_daily,
    "flagship": flagship,
    "ind_sma": _indicator(("SMA", 20), ("SMA", 200)),
    "ind_ema": _indicator(("EMA", 2), ("EMA", 9), ("EMA", 20), ("EMA", 50), ("EMA", 200), unit="minute", block_rows=BLOCK),
    "ind_ema_gaps": ind_ema_gaps,
    "ind_ema_jump": ind_ema_jump,
    "ind_rsi": _indicator(("RSI", 14), block_rows=BLOCK),
    "ind_atr": _indicator(("ATR", 14), unit="minute", block_rows=BLOCK),
    "ind_adx": _indicator(("ADX", 14), block_rows=BLOCK),
    "ind_macd": _indicator(("MACD", 0), unit="minute", block_rows=BLOCK),
    "ind_obv": _indicator(("OBV", 0), unit="minute", block_rows=BLOCK),
    "ind_roc": _indicator(("ROC", 12), block_rows=BLOCK),
    "ind_vwap": _indicator(("VWAP", 0), unit="minute", block_rows=BLOCK),
    "ind_cci": _indicator(("CCI", 20), block_rows=BLOCK),
    "ind_bbands": _indicator(("BBANDS_UPPER", 20), ("BBANDS_MIDDLE", 20), ("BBANDS_LOWER", 20), block_rows=BLOCK),
    "ind_stoch": _indicator(("STOCH_K", 14), ("STOCH_D", 14), block_rows=BLOCK),
    "ind_boll_width_pctb": _indicator(("BOLL_WIDTH", 20), ("BOLL_PCTB", 20), block_rows=BLOCK),
    "ind_williams": _indicator(("WILLIAMS_R", 14), block_rows=BLOCK),
    "ind_supertrend": _indicator(("SUPERTREND", 10), unit="minute", block_rows=BLOCK),
    "ind_daily": ind_daily,
    "ind_resumed": ind_resumed,
    "ind_long_registry": ind_long_registry,
    "ind_pivot_merge": ind_pivot_merge,
    "feat_normalised": _features("normalised", NORMALISED),
    "feat_trend": _features("trend", TREND),
    "feat_regime": _features("regime", REGIME),
    "feat_compression": _features("compression", COMPRESSION),
    "feat_momentum": _features("momentum", MOMENTUM),
    "feat_volume": _features("volume", VOLUME),
    "feat_all": feat_all,
    "sig_features": sig_features,
    "sig_incremental": sig_incremental,
    "sig_incremental_global": sig_incremental_global,
    "sig_reopened": sig_reopened,
    "label_horizon": label_horizon,
    "label_minute": label_minute,
    "label_incremental": label_incremental,
    "label_scan": label_scan,
    "stage_gate": stage_gate,
    "stage_pending": stage_pending,
    "stage_dedup": stage_dedup,
    "stage_insert_new": stage_insert_new,
    "stage_merge_summary": stage_merge_summary,
    "stage_merge_snapshot": stage_merge_snapshot,
    "stage_exported": stage_exported,
    "stage_recent": stage_recent,
    "raw_dedup": raw_dedup,
    "upsert_features": upsert_features,
    "ingest_filter": ingest_filter,
    "ingest_offsets": ingest_offsets,
    "stage_rejects": stage_rejects,
    "ingest_backfill": ingest_backfill,
    "ingest_range": ingest_range,
    "ingest_summary": ingest_summary,
    "ingest_per_date": ingest_per_date,
    "symbols_days": symbols_days,
    "dq_dupe_keys": dq_dupe_keys,
    "dq_dupe_indicators": dq_dupe_indicators,
    "dq_dupe_rows": dq_dupe_rows,
    "dq_dupe_rows_exported": dq_dupe_rows_exported,
    "dq_minute_dupes": dq_minute_dupes,
    "dq_daily": dq_daily,
    "dq_daily_symbol": dq_daily_symbol,
    "dq_low_coverage": dq_low_coverage,
    "dq_inserted_today": dq_inserted_today,
    "dq_inserted_by_run": dq_inserted_by_run,
    "dq_rows_between": dq_rows_between,
    "dq_ranges": dq_ranges,
    "dq_nulls": dq_nulls,
    "dq_rowcount": dq_rowcount,
    "dq_orphans": dq_orphans,
    "dq_table_counts": dq_table_counts,
    "dq_report": dq_report,
    "dq_report_missing": dq_report_missing,
    "sanitise_numeric": sanitise_numeric,
    "calendar_fields": calendar_fields,
    "schema_columns": schema_columns,
    "preview_top_n": preview_top_n,
    "fs_active": fs_active,
    "train_split": train_split,
    "train_split_symbol": train_split_symbol,
    "class_weights": class_weights,
    "eval_accuracy": eval_accuracy,
    "eval_confusion": eval_confusion,
    "eval_report": eval_report,
    "train_fit": train_fit,
    "train_importance": train_importance,
    "runlog_stages": runlog_stages,
    "runlog_symbols": runlog_symbols,
    "runlog_indicators": runlog_indicators,
}
