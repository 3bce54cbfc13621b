"""The jobs of the pipeline, from vendor files to a registered model.

A `Store` names the tables under one root. Staging is partitioned by batch, indicators by name, raw bars,
merged features, signals and labels by trade date. A merge writes down which days of which symbols it
touched; every later job takes the runs it has not done yet, computes each of their symbols from its first
new bar on (an old one, if a range was back-filled), reads the days needed for that and replaces rows on
them. Every job takes `write`; with write=False it computes and returns the same frames and leaves the
store as it is.
"""

from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import labels, merged, signals, staging, training
from tickloom.operators.engineered import add_engineered_features
from tickloom.operators.incremental import day_ledger, day_rows, days_needed, days_since, of_days, starts, trade_dates
from tickloom.operators.registry import field_names, resume_long, state_name
from tickloom.schemas import BAR_COLUMNS, BAR_DAYS, INDICATOR_STATE, KEY, PROGRESS, RAW_BARS, SIGNAL_FEATURES, STAGING, STAGING_MARKS, TRADE_DATE, TS
from tickloom.session import cut_lineage
from tickloom.sources import sinks, tables, vendor


#: Rows of a symbol that engineered features look back on, frames of frames included.
FEATURE_LOOKBACK = 200


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """The table, or None while nothing was written. With a schema no file is opened to infer it."""
        try:
            reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
            return reader.parquet(self.path(table))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # anything else is a fault, not a table yet to come
                raise
            return None

    def or_empty(self, table: str, schema: T.StructType) -> DataFrame:
        found = self.read(table, schema)
        return self.spark.createDataFrame([], schema) if found is None else found

    def raw_bars(self) -> DataFrame:
        return self.or_empty("raw_bars", RAW_BARS)

    def raw_by_date(self) -> DataFrame:
        """Raw bars with the trade date they are partitioned by."""
        return self.or_empty("raw_bars", T.StructType([*RAW_BARS.fields, BAR_DAYS[TRADE_DATE]]))

    def staging(self) -> DataFrame:
        """Staged rows. A batch is exported once its id is in the list of exported batches, so
        marking a batch appends one row and rewrites nothing."""
        rows = self.or_empty("staging", STAGING)
        done = self.or_empty("exported_batches", T.StructType([STAGING["BatchID"]])).distinct()
        marked = rows.drop("Exported").join(done.withColumn("_done", F.lit(1)), "BatchID", "left")
        return marked.withColumn("Exported", F.coalesce("_done", F.lit(0))).select(STAGING.fieldNames())

    def stage(self, bars: DataFrame, loaded: datetime, batch: str, write: bool = True) -> DataFrame:
        """Append a batch to staging; its name is listed first, so that no staged batch is overlooked."""
        if write:
            self.spark.createDataFrame([(batch,)], T.StructType([STAGING["BatchID"]])).write.mode("append").parquet(self.path("staged_batches"))
        return sinks.append_staging(bars, self.path("staging"), loaded, batch, write)

    def pending_staging(self) -> DataFrame:
        """Rows of batches that are not exported, from their partitions only."""
        names = T.StructType([STAGING["BatchID"]])
        open_ = self.or_empty("staged_batches", names).distinct().join(self.or_empty("exported_batches", names), "BatchID", "left_anti")
        ids = [r.BatchID for r in open_.collect()]  # batches since the last merge
        return self.or_empty("staging", STAGING).where(F.col("BatchID").isin(ids)).withColumn("Exported", F.lit(0))

    def exported_rows(self) -> DataFrame:
        """The newest exported time of each symbol, as the rows of staging that matter to an ingest."""
        marks = self.or_empty("staging_marks", STAGING_MARKS)
        return marks.groupBy(KEY).agg(F.max("LastTs").alias(TS)).withColumn("Exported", F.lit(1))

    def indicator_state(self) -> DataFrame:
        """Where indicators can resume: one row for each symbol and recipe."""
        if self.read("indicator_state/versions", T.StructType([T.StructField("version", T.IntegerType())])) is None:
            return self.spark.createDataFrame([], INDICATOR_STATE)
        return sinks.read_snapshot(self.spark, self.path("indicator_state"))

    def keep_states(self, states: DataFrame) -> None:
        path = self.path("indicator_state")
        stored = self.read("indicator_state/versions", T.StructType([T.StructField("version", T.IntegerType())])) is not None
        sinks.commit_snapshot(states, path, sinks.current_version(self.spark, path) + 1 if stored else 1)

    def ledger(self) -> DataFrame:
        return self.or_empty("bar_days", BAR_DAYS)

    def done(self, job: str) -> DataFrame:
        return self.or_empty("progress", PROGRESS).where(F.col("Job") == job).select("Run")

    def open_runs(self, job: str, after: str | None = None) -> DataFrame:
        """Merge runs that the job has not done, and the job before it has."""
        runs = self.ledger().select("Run").distinct()
        if after:
            runs = runs.join(self.done(after), "Run", "left_semi")
        return cut_lineage(runs.join(self.done(job), "Run", "left_anti"))  # one row for each merge

    def mark(self, job: str, runs: DataFrame, write: bool) -> None:
        if write:
            runs.select(F.lit(job).alias("Job"), "Run").write.mode("append").parquet(self.path("progress"))


def ingest_job(
    store: Store, vendor_path: str, now: datetime, symbols: DataFrame | None = None,
    date_range: tuple[datetime, datetime] | None = None, source_zone: str | None = "UTC", write: bool = True,
) -> DataFrame:
    """Vendor files to new staging rows, stamped with a batch of their own."""
    bars = vendor.read_vendor(store.spark, vendor_path, source_zone)
    fresh = vendor.ingest(bars, store.exported_rows(), symbols, date_range)
    return store.stage(fresh, now, sinks.run_id("BATCH", now), write)


def merge_job(store: Store, write: bool = True, now: datetime | None = None) -> staging.MergeResult:
    """Pending staging rows to raw bars; raises when one lies outside market hours.

    Rows that cannot be read go to the table `rejected`. New bars are appended by trade date, and the ledger
    gets a row for each symbol and day. The ledger is written first: a job that dies before the
    batches are marked is simply run again, and what it appended is known by then and not inserted twice.
    """
    staged, raw = store.pending_staging(), store.raw_by_date()
    result = staging.merge_staging(staged, raw)
    if not write:
        return result
    loaded = now or datetime.now()
    inserted = cut_lineage(result.inserted)
    days = cut_lineage(day_ledger(inserted, raw, f"MERGE_{uuid4().hex}", loaded))
    summary = cut_lineage(staging.ledger_summary(staged, day_rows(store.ledger()), inserted))
    aside = cut_lineage(staging.rejected(staged))
    batches = cut_lineage(staged.select("BatchID").distinct())
    marks = cut_lineage(staged.where(F.col(KEY).isNotNull() & F.col(TS).isNotNull()).groupBy(KEY).agg(F.max(TS).alias("LastTs")))
    days.write.mode("append").parquet(store.path("bar_days"))
    sinks.write_dated(inserted.withColumn(TRADE_DATE, F.to_date(TS)), store.path("raw_bars"))
    aside.write.mode("append").parquet(store.path("rejected"))
    marks.write.mode("append").parquet(store.path("staging_marks"))
    batches.write.mode("append").parquet(store.path("exported_batches"))
    return staging.MergeResult(inserted, store.raw_bars(), store.staging(), summary)


def repair_raw_job(store: Store, write: bool = True) -> DataFrame:
    """Remove duplicate minutes from raw bars, rewriting only the trade dates that have some."""
    raw = store.raw_bars().withColumn(TRADE_DATE, F.to_date(TS))
    dates = staging.duplicate_minutes(raw).select(F.to_date(TS).alias(TRADE_DATE)).distinct()
    repaired = staging.raw_dedup(raw.join(dates, TRADE_DATE, "left_semi")).withColumn(TRADE_DATE, F.to_date(TS))
    if write:
        repaired = cut_lineage(repaired)  # read everything before the first partition is replaced
        # rows of these symbols move up, so they start from their first bar next time
        store.keep_states(store.indicator_state().join(repaired.select(KEY), KEY, "left_anti"))
        (
            repaired.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(TRADE_DATE).parquet(store.path("raw_bars"))
        )
    return repaired


def indicator_job(
    store: Store, definitions: DataFrame, now: datetime, timeframe: str = "1m", only_new: bool = True,
    block_rows: int | None = None, write: bool = True,
) -> DataFrame:
    """All active indicators of new bars, appended to the long table.

    Each symbol resumes with the block it ended in, from the means, totals and bands stored for it, and only days
    from that block's look-back on are read. Where the first new bar lies before that block (a back-filled
    range), or nothing is stored for these definitions, the symbol is computed from its first bar.
    only_new=False gives every bar of every symbol a value, as after a change of definitions; the
    latest value counts. The state is stored before the runs are marked as done: a job that dies
    between is run again, and its runs count as new against that state.
    """
    runs = store.open_runs("indicators")
    known, recipe = store.indicator_state(), state_name(definitions, block_rows, gaps=False)
    if only_new:
        from_ = cut_lineage(starts(store.ledger(), runs))
        usable = known.where(F.col("Recipe") == recipe).join(from_.withColumnRenamed("FromTs", "_new"), KEY).where(F.col("_new") >= F.col("BlockTs")).drop("_new")
        needed = cut_lineage(days_since(store.ledger(), from_, usable))
        bars, state = of_days(store.raw_by_date(), needed).select(BAR_COLUMNS), usable
    else:
        bars, state = store.raw_bars().select(BAR_COLUMNS), None
    long, after = resume_long(bars, definitions, state, timeframe, now, block_rows, gaps=False)  # the merge lets no NULL in
    if only_new:
        long = long.join(from_, KEY).where(F.col(TS) >= F.col("FromTs")).drop("FromTs")
    out = sinks.append_indicators(long, store.path("indicators"), write)
    if write:
        store.keep_states(sinks.upsert(known, cut_lineage(after), (KEY, "Recipe")))
    store.mark("indicators", runs, write)
    return out


def feature_job(store: Store, definitions: DataFrame, now: datetime, rebuild: bool = False, write: bool = True) -> DataFrame:
    """Bars and pivoted indicators to merged features, by (Symbol, time): rows from the first new bar of a
    symbol on, or all with `rebuild` and where the definitions give other columns than are stored."""
    fields, run = field_names(definitions), sinks.run_id("MERGE", now)
    path, stored = store.path("merged_features"), store.read("merged_features")
    runs = store.open_runs("features", "indicators")
    long = tables.read_indicators(store.spark, store.path("indicators"))
    if rebuild or stored is None or not set(fields) <= set(stored.columns):
        frame = sinks.prepare_merged(feature_frame(store.raw_bars().select(BAR_COLUMNS), long, fields, run, now))
        if write:
            sinks.write_dated(frame.withColumn(TRADE_DATE, F.to_date(TS)), path, "overwrite")
            store.mark("features", runs, write)
        return frame
    needed = cut_lineage(days_needed(store.ledger(), starts(store.ledger(), runs), FEATURE_LOOKBACK))
    bars = of_days(store.raw_by_date(), needed)
    dates = trade_dates(needed)
    if dates:
        long = long.where(F.col(TS) >= F.lit(dates[0])).join(needed.select(KEY).distinct(), KEY, "left_semi")
    frame = feature_frame(bars.select(BAR_COLUMNS), long, fields, run, now)
    from_ = needed.groupBy(KEY).agg(F.min("FromTs").alias("FromTs"))
    fresh = sinks.prepare_merged(frame.join(from_, KEY).where(F.col(TS) >= F.col("FromTs")).drop("FromTs"))
    if write:
        fresh = cut_lineage(fresh)
        sinks.replace_rows(fresh, path, [KEY, TS], TS)
        store.mark("features", runs, write)
    return fresh


def feature_frame(bars: DataFrame, long: DataFrame, fields: list[str], run_id: str, run_ts: datetime) -> DataFrame:
    wide = merged.pivot_last(long, fields)
    return add_engineered_features(merged.merge_indicators(bars, wide, run_id, run_ts))


def signal_job(store: Store, now: datetime, rebuild: bool = False, version: int = 1, write: bool = True) -> DataFrame:
    """Signal features: everything with `rebuild`, else rows from the first new bar of a symbol on, and the
    bar before it, which now has a Target. Only trade dates with such rows are rewritten."""
    source, run, path = store.read("merged_features"), sinks.run_id("SIGNAL", now), store.path("signal_features")
    runs = store.open_runs(f"signals {version}", "features")
    if rebuild or store.read("signal_features", SIGNAL_FEATURES) is None:
        fresh = sinks.append_signals(signals.signal_frame(source.drop(TRADE_DATE), run, now, version), path, rebuild=True, write=write)
    else:
        needed = cut_lineage(days_needed(store.ledger(), starts(store.ledger(), runs), signals.LOOKBACK + 1))
        fresh = sinks.coerce(signals.signals_from(of_days(source, needed), run, now, version), SIGNAL_FEATURES)
        if write:
            fresh = cut_lineage(fresh)
            sinks.replace_rows(fresh, path, [KEY, "FeatureTimestamp", "SignalVersion"], "FeatureTimestamp")
    store.mark(f"signals {version}", runs, write)
    return fresh


def label_job(
    store: Store, now: datetime, spec: labels.LabelSpec = labels.LabelSpec(), rebuild: bool = False, write: bool = True
) -> DataFrame:
    """Horizon labels: everything with `rebuild`, else rows from the first new bar of a symbol on, and those
    before it that its horizon reaches. Only trade dates with such rows are rewritten."""
    features = tables.require_columns(store.read("merged_features"), labels.REQUIRED)
    run, path = sinks.run_id("LABEL", now), store.path("labelled_features")
    job = f"labels {spec.horizon} {spec.label_type} {spec.label_version} {spec.feature_version}"
    runs = store.open_runs(job, "features")
    first = store.read("labelled_features") is None
    if rebuild or first or store.done(job).isEmpty():  # nothing of this kind is stored yet
        fresh = labels.label_frame(features.drop(TRADE_DATE), store.raw_bars(), spec, run, now)
        if rebuild or first:
            fresh = sinks.append_labels(fresh, path, rebuild=True, write=write)
    else:
        needed = cut_lineage(days_needed(store.ledger(), starts(store.ledger(), runs, spec.horizon), 0))
        bars = of_days(store.raw_by_date(), needed)
        fresh = labels.labels_from(of_days(features, needed).drop(TRADE_DATE), bars, spec, run, now)
    if not (rebuild or first):
        fresh = sinks.sanitise(fresh)
        if write:
            fresh = cut_lineage(fresh)
            sinks.replace_rows(fresh, path, [KEY, TS, "HorizonMinutes", "LabelType", "LabelVersion", "FeatureVersion"], TS)
    store.mark(job, runs, write)
    return fresh


@dataclass(frozen=True)
class Training:
    model: object
    features: list[str]
    missing: list[str]
    metrics: DataFrame
    importance: DataFrame
    registry: DataFrame | None


def training_job(
    store: Store, now: datetime, sets: DataFrame | None = None, members: DataFrame | None = None,
    spec: labels.LabelSpec = labels.LabelSpec(), settings: training.TrainSettings = training.TrainSettings(),
    ratio: float = 0.8, order: str = "time", trainable_only: bool = True, repeats: int = 5, write: bool = False,
) -> Training:
    """Labelled rows to a model with metrics and importances; saved and registered with `write`.

    Without feature sets every numeric column that is not metadata is used.
    """
    data = tables.read_labelled(store.spark, store.path("labelled_features"), spec)
    if trainable_only:
        data = data.where("IsTrainableRow = 1")
    if sets is None or members is None:
        set_id, features, missing = None, training.automatic_features(data), []
    else:
        set_id = training.active_feature_set(sets)
        features, missing = training.select_features(data, training.feature_list(sets, members))
    placed = cut_lineage(training.ordered_split(data.select("Symbol", "PriceTimestamp", "Label", *features), ratio, order))
    train, test = placed.where("is_train"), placed.where(~F.col("is_train"))
    if train.isEmpty() or test.isEmpty():
        raise ValueError("the split leaves one side empty")
    model = training.fit(train, features, settings)
    metrics = training.metrics_json(training.predict(model, train, features), training.predict(model, test, features))
    importance = training.permutation_importance(model, test, features, repeats, settings.seed)
    registry = None
    if write:
        run = sinks.run_id("TRAIN", now)
        artifact = training.save_model(model, features, spec, run, now, store.path("models"))
        registry = sinks.register_model(store.spark, {
            "ModelName": training.model_name(spec), "RunID": run, "FeatureSetID": set_id, "LabelType": spec.label_type,
            "LabelVersion": spec.label_version, "HorizonMinutes": spec.horizon,
            "MetricsJson": metrics.first()["MetricsJson"], "ArtifactPath": artifact,
        }, store.path("model_registry"))
    return Training(model, features, missing, metrics, importance, registry)
