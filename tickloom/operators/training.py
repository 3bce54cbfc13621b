"""Feature selection, splits, boosted-tree training, evaluation and importance on MLlib."""

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import numeric_columns
from tickloom.operators.labels import LabelSpec
from tickloom.operators.series import with_row_index
from tickloom.schemas import KEY, TS

# Columns that describe a labelled row and never serve as features. The future
# close and return would give the label away.
NOT_FEATURES = [
    KEY, TS, "Label", "HorizonMinutes", "LabelType", "LabelVersion", "FeatureVersion", "IsTrainableRow", "IsOutlier",
    "RegimeTag", "MarketSession", "LoadTimestamp", "SourceRunID", "RunId", "RunTimestamp", "MergeRunId",
    "FutureClose_tN", "Return_t_to_tN",
]
LABELS = [-1, 0, 1]


# --- selection ------------------------------------------------------------------------------

def active_feature_set(sets: DataFrame) -> int:
    """Id of the one active set; none or several is an error."""
    ids = [r.FeatureSetID for r in sets.where("IsActive = 1").select("FeatureSetID").limit(2).collect()]
    if len(ids) != 1:
        raise ValueError("no active feature set" if not ids else "more than one active feature set")
    return ids[0]


def active_features(sets: DataFrame, members: DataFrame) -> DataFrame:
    """(FeatureName, Ordinal) of the active set."""
    return members.join(sets.where("IsActive = 1"), "FeatureSetID").select("FeatureName", "Ordinal")


def feature_list(sets: DataFrame, members: DataFrame) -> list[str]:
    """Names in order, on the driver: each is a column of the plan, which bounds their number."""
    rows = active_features(sets, members).groupBy("FeatureName").agg(F.min("Ordinal").alias("Ordinal")).orderBy("Ordinal").collect()
    if not rows:
        raise ValueError("the active feature set has no features")
    return [r.FeatureName for r in rows]


def select_features(df: DataFrame, names: Sequence[str]) -> tuple[list[str], list[str]]:
    """(available in the given order, missing)."""
    available = [n for n in names if n in df.columns]
    if not available:
        raise ValueError("none of the active features exist in the data")
    return available, [n for n in names if n not in df.columns]


def automatic_features(df: DataFrame) -> list[str]:
    """Every numeric column that is not metadata, label or a look into the future."""
    return numeric_columns(df, NOT_FEATURES)


# --- split and weights ----------------------------------------------------------------------

def with_position(df: DataFrame, order: str = "time") -> DataFrame:
    """Add `position`, 0-based over the whole table, in time or in (Symbol, time) order.

    Offsets come from counts per day and minute (or per symbol), so rows are only ranked among
    those of one minute (or one symbol-day); nothing sorts the table in one place. The windows
    without partition run over day or symbol counts.
    """
    before = (Window.unboundedPreceding, -1)
    if order == "symbol":
        starts = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"))
        starts = starts.select(KEY, F.coalesce(F.sum("_n").over(Window.orderBy(KEY).rowsBetween(*before)), F.lit(0)).alias("_start"))
        return with_row_index(df).join(starts, KEY).withColumn("position", F.col("_start") + F.col("rn")).drop("rn", "_start")
    if order != "time":
        raise ValueError("order is 'time' or 'symbol'")
    moments = df.groupBy(TS).agg(F.count(F.lit(1)).alias("_n")).withColumn("_day", F.to_date(TS))
    days = moments.groupBy("_day").agg(F.sum("_n").alias("_d"))
    days = days.select("_day", F.coalesce(F.sum("_d").over(Window.orderBy("_day").rowsBetween(*before)), F.lit(0)).alias("_day_start"))
    in_day = F.coalesce(F.sum("_n").over(Window.partitionBy("_day").orderBy(TS).rowsBetween(*before)), F.lit(0))
    starts = moments.withColumn("_in_day", in_day).join(days, "_day").select(TS, (F.col("_day_start") + F.col("_in_day")).alias("_start"))
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(TS).orderBy(KEY)))
    return ranked.join(starts, TS).withColumn("position", F.col("_start") + F.col("_rank") - 1).drop("_rank", "_start")


def ordered_split(df: DataFrame, ratio: float = 0.8, order: str = "time") -> DataFrame:
    """Add `position` and `is_train`: the first int(n * ratio) rows train, the rest test."""
    cut = df.agg(F.floor(F.count(F.lit(1)) * F.lit(ratio)).cast("bigint").alias("cut")).scalar()
    return with_position(df, order).withColumn("is_train", F.col("position") < cut)


def train_test(df: DataFrame, ratio: float = 0.8, order: str = "time") -> tuple[DataFrame, DataFrame]:
    split = ordered_split(df, ratio, order)
    return split.where("is_train"), split.where(~F.col("is_train"))


def class_weights(df: DataFrame, label: str = "Label") -> DataFrame:
    """Balanced weights n / (classes * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    classes = Window.partitionBy(F.lit(0))  # over one row per class
    weight = F.sum("n").over(classes) / (F.count("n").over(classes) * F.col("n"))
    return counts.select(label, "n", weight.alias("weight"))


# --- fit ------------------------------------------------------------------------------------

@dataclass(frozen=True)
class TrainSettings:
    rounds: int = 300
    depth: int = 6
    step: float = 0.05
    seed: int = 42
    checkpoint_every: int = 10


def _flag(name: str) -> str:
    return f"{name}__missing"


def with_missing_flags(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Doubles plus a 0/1 column per feature: MLlib takes no NULL, and being missing is information."""
    return df.withColumns({
        **{_flag(c): F.col(c).isNull().cast("double") for c in features},
        **{c: F.col(c).cast("double") for c in features},
    })


def fit(train: DataFrame, features: Sequence[str], settings: TrainSettings = TrainSettings()) -> PipelineModel:
    """Impute, assemble, and one boosted ensemble per class, weighted by class balance.

    A feature without any value in training is known by its missing flag alone.

    The weights, one per class, become literals; a join on so few keys would be all skew.
    """
    counts = train.agg(
        *[F.count_if(F.col("Label") == v).alias(f"n{i}") for i, v in enumerate(LABELS)], F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(c)).alias(f"has{i}") for i, c in enumerate(features)],
    ).first()
    sizes = {v: counts[f"n{i}"] for i, v in enumerate(LABELS) if counts[f"n{i}"]}
    if sum(sizes.values()) != counts["rows"]:
        raise ValueError(f"labels other than {LABELS}")
    weight = F.coalesce(*[F.when(F.col("Label") == v, F.lit(counts["rows"] / (len(sizes) * n))) for v, n in sizes.items()])
    with_values = [c for i, c in enumerate(features) if counts[f"has{i}"]]
    weighted = with_missing_flags(train, features).withColumns({
        "weight": weight, "class": (F.col("Label") + 1).cast("double"),
    })
    filled = [f"{c}__filled" for c in with_values]
    trees = GBTClassifier(
        maxIter=settings.rounds, maxDepth=settings.depth, stepSize=settings.step, seed=settings.seed,
        checkpointInterval=settings.checkpoint_every,
    )
    stages = [
        *([Imputer(inputCols=with_values, outputCols=filled, strategy="median")] if with_values else []),
        VectorAssembler(inputCols=[*filled, *map(_flag, features)], outputCol="features"),
        OneVsRest(classifier=trees, featuresCol="features", labelCol="class", weightCol="weight"),
    ]
    return Pipeline(stages=stages).fit(weighted)


def predict(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """df with an integer `Prediction` in {-1, 0, 1}."""
    scored = model.transform(with_missing_flags(df, features))
    return scored.select(*df.columns, (F.col("prediction").cast("int") - 1).alias("Prediction"))


# --- evaluation -----------------------------------------------------------------------------

def accuracy() -> Column:
    return F.avg((F.col("Label") == F.col("Prediction")).cast("double"))


def confusion_matrix(scored: DataFrame, labels: Sequence[int] = LABELS) -> DataFrame:
    """One row per true label, one column per predicted label: a row also for labels only predicted."""
    pairs = scored.select(F.col("Label"), F.col("Prediction"), F.lit(1).alias("n")).union(
        scored.groupBy("Prediction").agg(F.lit(0).alias("n")).select("Prediction", "Prediction", "n"))
    return (
        pairs.groupBy("Label").pivot("Prediction", list(labels)).agg(F.sum("n")).na.fill(0)
        .withColumnsRenamed({str(v): f"pred_{v}" for v in labels})
    )


def classification_report(scored: DataFrame, labels: Sequence[int] = LABELS) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy (as f1) and macro and weighted averages.

    Three counts per class from one pass over the predictions; the rest works on that one row.
    """
    true, guess = F.col("Label"), F.col("Prediction")
    counts = scored.agg(*[
        c.alias(f"{name}{i}")
        for i, v in enumerate(labels)
        for name, c in (
            ("hit", F.count_if((true == v) & (guess == v))), ("support", F.count_if(true == v)), ("guess", F.count_if(guess == v))
        )
    ])

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.when(whole != 0, whole), F.lit(0.0))

    per_class = counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(str(v)).alias("class"),
            share(F.col(f"hit{i}"), F.col(f"guess{i}")).alias("precision"),
            share(F.col(f"hit{i}"), F.col(f"support{i}")).alias("recall"),
            share(2 * F.col(f"hit{i}"), F.col(f"guess{i}") + F.col(f"support{i}")).alias("f1"),
            F.col(f"support{i}").alias("support"), F.col(f"guess{i}").alias("guess"), F.col(f"hit{i}").alias("hit"),
        )
        for i, v in enumerate(labels)
    ]))).where("support > 0 OR guess > 0").drop("guess")
    scores = ["precision", "recall", "f1"]
    averages = per_class.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in scores],
        *[share(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in scores],
        F.sum("support").alias("support"), share(F.sum("hit"), F.sum("support")).alias("accuracy"),
    ).select(F.inline(F.array(F.struct(F.lit("accuracy").alias("class"), *[F.lit(None).cast("double").alias(c) for c in scores[:2]], F.col("accuracy").alias("f1"), F.col("support")), *[
        F.struct(F.lit(f"{kind} avg").alias("class"), *[F.col(f"{kind}_{c}").alias(c) for c in scores], F.col("support"))
        for kind in ("macro", "weighted")
    ])))
    return per_class.drop("hit").unionByName(averages)


def metrics_json(train_scored: DataFrame, test_scored: DataFrame, labels: Sequence[int] = LABELS) -> DataFrame:
    """One row, one column MetricsJson."""
    matrix = confusion_matrix(test_scored, labels).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("confusion_matrix"))
    report = classification_report(test_scored, labels).agg(F.sort_array(F.collect_list(F.struct("*"))).alias("classification_report"))
    row = train_scored.agg(accuracy().alias("training_accuracy")).withColumns({
        "test_accuracy": test_scored.agg(accuracy().alias("a")).scalar(),
        "confusion_matrix": matrix.scalar(),
        "classification_report": report.scalar(),
    })
    return row.select(F.to_json(F.struct("*")).alias("MetricsJson"))


def permuted(df: DataFrame, columns: Sequence[str], repeats: int, seed: int, slices: int = 4096) -> DataFrame:
    """For each repeat, every row with the columns of another row beside it (`<column>__other`).

    Two numberings of the rows by different hashes are matched. Hashes of the key instead of
    rand() give the same permutation when a lost task is run again; rows are numbered within
    hash slices (a power of two), so no task sorts the table.
    """
    spread = df.withColumn("_repeat", F.explode(F.array(*[F.lit(r) for r in range(repeats)])))

    def numbered(rows: DataFrame, salt: int) -> DataFrame:
        hashed = rows.withColumn("_hash", F.xxhash64(KEY, TS, F.col("_repeat"), F.lit(salt)))
        ordered = hashed.withColumn("_order", F.struct("_hash", KEY, TS))
        return with_row_index(ordered, "_repeat", "_order", F.shiftright("_hash", 65 - slices.bit_length())).drop("_hash", "_order")

    left = numbered(spread, seed)
    right = numbered(spread.select(KEY, TS, "_repeat", *columns), seed + 1)
    right = right.select("_repeat", "rn", *[F.col(c).alias(f"{c}__other") for c in columns])
    return left.join(right, ["_repeat", "rn"]).drop("rn")


def permutation_importance(
    model: PipelineModel, test: DataFrame, features: Sequence[str], repeats: int = 5, seed: int = 42
) -> DataFrame:
    """Mean loss of accuracy when one feature is shuffled, largest first.

    All features and repeats are scored in one job: each row is unfolded into one copy per
    feature with that feature exchanged, plus an unchanged one as the baseline.
    """
    shuffled = permuted(test.select(KEY, TS, "Label", *features), features, repeats, seed)
    copies = [F.struct(F.lit("").alias("Feature"), *[F.col(c).alias(f"_{c}") for c in features])]
    copies += [
        F.struct(F.lit(one).alias("Feature"), *[(F.col(f"{c}__other") if c == one else F.col(c)).alias(f"_{c}") for c in features])
        for one in features
    ]
    unfolded = shuffled.select("_repeat", "Label", F.inline(F.array(*copies)))
    unfolded = unfolded.select("_repeat", "Label", "Feature", *[F.col(f"_{c}").alias(c) for c in features])
    scores = predict(model, unfolded, features).groupBy("_repeat", "Feature").agg(accuracy().alias("score"))
    base = scores.where("Feature = ''").select("_repeat", F.col("score").alias("base"))
    return (
        scores.where("Feature <> ''").join(base, "_repeat")
        .groupBy("Feature").agg(F.avg(F.col("base") - F.col("score")).alias("Importance"))
        .orderBy(F.desc("Importance"))
    )


# --- persistence and the whole run ----------------------------------------------------------

def model_name(spec: LabelSpec, family: str = "GBT") -> str:
    return f"{family}_{spec.label_type}_{spec.horizon}m_{spec.label_version}_{spec.feature_version}"


def artifact_name(spec: LabelSpec, run_id: str) -> str:
    return f"model_{spec.label_type}_{spec.horizon}m_{spec.label_version}_{spec.feature_version}_{run_id}"


def save_model(
    model: PipelineModel, features: Sequence[str], spec: LabelSpec, run_id: str, trained_at: datetime, folder: str
) -> str:
    """Pipeline plus a row of metadata; returns the artifact path."""
    path = f"{folder}/{artifact_name(spec, run_id)}"
    model.write().overwrite().save(f"{path}/pipeline")
    metadata = {
        "feature_columns": list(features), "label_type": spec.label_type, "label_version": spec.label_version,
        "feature_version": spec.feature_version, "horizon_minutes": spec.horizon, "trained_run_id": run_id,
        "trained_at": trained_at.isoformat(),
    }
    SparkSession.active().createDataFrame([(json.dumps(metadata),)], "value string").write.mode("overwrite").text(f"{path}/metadata")
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/pipeline")
