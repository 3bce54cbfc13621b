"""Indicator definitions in, long indicator table out."""

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.indicators import indicators, recipe_name, resume_indicators
from tickloom.schemas import KEY, TS


def active_definitions(definitions: DataFrame) -> DataFrame:
    return definitions.where("IsActive = 1").select("IndicatorId", "IndicatorName", "DefaultParams")


def definition_list(definitions: DataFrame) -> list[tuple[int, str, str]]:
    """Active definitions on the driver: each names a column of the plan, which bounds their number."""
    rows = active_definitions(definitions).distinct().orderBy("IndicatorId").collect()
    return [(r.IndicatorId, r.IndicatorName, r.DefaultParams) for r in rows]


# Parameters of indicators whose definition may leave them empty.
EMPTY_PARAMETER = {"MACD": 0, "OBV": 0, "VWAP": 0, "ROC": 12}


def parameter(name: str, text: str | None) -> int:
    """Parameter of a definition as a number; only some indicators may leave it empty."""
    if text is None or not text.strip():
        if name.upper() not in EMPTY_PARAMETER:
            raise ValueError(f"indicator {name} needs a parameter")
        return EMPTY_PARAMETER[name.upper()]
    return int(text)


def field_names(definitions: DataFrame) -> list[str]:
    """Wide column names the active definitions give."""
    return sorted({_field(name, param) for _, name, param in definition_list(definitions)})


def _field(name: str, param: str | None) -> str:
    return f"{name}_{parameter(name, param)}"


def indicator_long(
    bars: DataFrame,
    definitions: DataFrame,
    timeframe: str = "1m",
    added: datetime | None = None,
    cut: bool = False,
    gaps: bool = True,
) -> DataFrame:
    """One row per bar and active definition that has a value there.

    All definitions are computed side by side and unfolded afterwards, so the bars are
    shuffled once, not once per definition. An unknown name raises.
    """
    listed = definition_list(definitions)
    return _unfold(indicators(bars, _wanted(listed), cut=cut, gaps=gaps), listed, timeframe, added)


def resume_long(
    bars: DataFrame,
    definitions: DataFrame,
    state: DataFrame | None = None,
    timeframe: str = "1m",
    added: datetime | None = None,
    block_rows: int | None = None,
    gaps: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The same rows from each symbol's stored block on, and the state for the next run."""
    listed = definition_list(definitions)
    wide, after = resume_indicators(bars, _wanted(listed), state, block_rows=block_rows, gaps=gaps)
    return _unfold(wide, listed, timeframe, added), after


def state_name(definitions: DataFrame, block_rows: int | None = None, gaps: bool = True) -> str:
    """Recipe of the states that the active definitions can resume with."""
    return recipe_name(_wanted(definition_list(definitions)), block_rows, gaps)


def _wanted(listed: list[tuple[int, str, str]]) -> list[tuple[str, int]]:
    return list(dict.fromkeys((name, parameter(name, param)) for _, name, param in listed))


def _unfold(wide: DataFrame, listed: list[tuple[int, str, str]], timeframe: str, added: datetime | None) -> DataFrame:
    entries = [
        F.struct(
            F.lit(id_).cast("int").alias("IndicatorId"),
            F.lit(name).alias("IndicatorName"),
            F.lit(str(parameter(name, param))).alias("IndicatorParams"),
            F.col(_field(name, param)).alias("IndicatorValue"),
            F.lit(_field(name, param)).alias("FieldName"),
        )
        for id_, name, param in listed
    ]
    stamp = F.current_timestamp() if added is None else F.lit(added).cast("timestamp")
    return (
        wide.select(KEY, TS, F.inline(F.array(*entries)))
        .where(F.col("IndicatorValue").isNotNull())
        .select(
            KEY, TS, F.lit(timeframe).alias("Timeframe"), "IndicatorId", "IndicatorName", "IndicatorParams",
            "IndicatorValue", "FieldName", stamp.alias("addDateTime"),
        )
    )
