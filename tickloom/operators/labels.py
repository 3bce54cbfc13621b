"""Fixed-horizon direction labels."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import minutes, naive
from tickloom.operators.incremental import newer_rows
from tickloom.schemas import KEY, TS

REQUIRED = [KEY, TS, "ClosePrice"]


@dataclass(frozen=True)
class LabelSpec:
    """What identifies a set of labels."""

    horizon: int = 5
    label_type: str = "DIRECTION_5M"
    label_version: str = "v1"
    feature_version: str = "v1"

    def matches(self):
        return (
            (F.col("HorizonMinutes") == self.horizon) & (F.col("LabelType") == self.label_type)
            & (F.col("LabelVersion") == self.label_version) & (F.col("FeatureVersion") == self.feature_version)
        )


def future_close(bars: DataFrame, horizon: int) -> DataFrame:
    """Close exactly `horizon` minutes later; NULL where no bar stands at that time.

    An equi-join on (Symbol, time), so a busy symbol spreads over all tasks.
    """
    now = bars.select(KEY, TS, F.col("ClosePrice").alias("Close_t"))
    return now.join(shifted_closes(bars, horizon), [KEY, TS], "left").select(KEY, TS, "Close_t", "FutureClose_tN")


def shifted_closes(bars: DataFrame, horizon: int) -> DataFrame:
    """Every close under the time `horizon` minutes before it."""
    return bars.select(KEY, (F.col(TS) - minutes(horizon)).alias(TS), F.col("ClosePrice").alias("FutureClose_tN"))


def label_frame(features: DataFrame, bars: DataFrame, spec: LabelSpec, run_id: str, run_ts: datetime) -> DataFrame:
    """All feature columns (ClosePrice as Close_t) with future close, return, label and metadata."""
    missing = [c for c in REQUIRED if c not in features.columns]
    if missing:
        raise ValueError(f"feature table lacks required columns: {', '.join(missing)}")
    change = F.when(F.col("Close_t") != 0, F.col("FutureClose_tN") / F.col("Close_t") - 1)
    return (
        features.withColumnRenamed("ClosePrice", "Close_t").join(shifted_closes(bars, spec.horizon), [KEY, TS], "left")
        .withColumn("Return_t_to_tN", change)
        .withColumns({
            "Label": F.coalesce(F.signum("Return_t_to_tN"), F.lit(0)).cast("int"),
            "HorizonMinutes": F.lit(spec.horizon).cast("int"),
            "LabelType": F.lit(spec.label_type),
            "LabelVersion": F.lit(spec.label_version),
            "FeatureVersion": F.lit(spec.feature_version),
            "IsTrainableRow": F.col("Return_t_to_tN").isNotNull().cast("int"),
            "IsOutlier": F.lit(0),
            "RegimeTag": F.lit(None).cast("string"),
            "MarketSession": F.lit(None).cast("string"),
            "LoadTimestamp": naive(run_ts),
            "SourceRunID": F.lit(run_id),
            "RunId": F.lit(run_id),
        })
    )


def label_incremental(
    features: DataFrame, bars: DataFrame, existing: DataFrame, spec: LabelSpec, run_id: str, run_ts: datetime,
    per_symbol: bool = True,
) -> DataFrame:
    """Labels for feature rows newer than those stored for the same horizon, type and versions, and
    again for stored rows that lacked their future bar when they were written and have it now."""
    fresh = newer_rows(features, existing, per_symbol=per_symbol, where=spec.matches())
    again = features.join(reopened(existing, bars, spec), [KEY, TS], "left_semi")
    return label_frame(fresh.unionByName(again), bars, spec, run_id, run_ts)


def labels_from(features: DataFrame, bars: DataFrame, spec: LabelSpec, run_id: str, run_ts: datetime) -> DataFrame:
    """Labels of rows that new bars can change: FromTs lies the horizon before the first of them.

    Rows before that bar come only with the future close they may have lacked.
    """
    rows = features.where(F.col(TS) >= F.col("FromTs")).withColumn("_new", F.col(TS) >= F.col("FromTs") + minutes(spec.horizon))
    out = label_frame(rows.drop("FromTs"), bars, spec, run_id, run_ts)
    return out.where(F.col("_new") | F.col("FutureClose_tN").isNotNull()).drop("_new")


def reopened(existing: DataFrame, bars: DataFrame, spec: LabelSpec) -> DataFrame:
    """(Symbol, time) of stored rows that cannot be trained on although their future bar is there by now."""
    open_ = existing.where(spec.matches() & (F.col("IsTrainableRow") == 0) & F.col("FutureClose_tN").isNull()).select(KEY, TS)
    later = bars.where(F.col("ClosePrice").isNotNull()).select(KEY, (F.col(TS) - minutes(spec.horizon)).alias(TS))
    return open_.join(later, [KEY, TS], "left_semi")
