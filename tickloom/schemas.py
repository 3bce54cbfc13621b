"""Table schemas and the fixed names the rest of the package agrees on."""

from pyspark.sql import types as T

KEY = "Symbol"
TS = "PriceTimestamp"
TRADE_DATE = "TradeDate"  # partition column of stored raw bars, merged features, signals and labels
PRICES = ["OpenPrice", "HighPrice", "LowPrice", "ClosePrice"]
BAR_COLUMNS = [KEY, TS, *PRICES, "Volume"]


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_NTZ, _TZ = T.TimestampNTZType(), T.TimestampType()

BARS = _struct(Symbol=_S, PriceTimestamp=_NTZ, OpenPrice=_D, HighPrice=_D, LowPrice=_D, ClosePrice=_D, Volume=_L)
RAW_BARS = T.StructType(BARS.fields + _struct(BatchID=_S, LoadTimestamp=_NTZ).fields)
STAGING = T.StructType(RAW_BARS.fields + _struct(Exported=_I).fields)

# What merges brought in, per symbol and day: bars the day then had, the first new one, the last one.
BAR_DAYS = _struct(Symbol=_S, TradeDate=T.DateType(), Rows=_L, FirstTs=_NTZ, LastTs=_NTZ, Run=_S, LoadTimestamp=_NTZ)
PROGRESS = _struct(Job=_S, Run=_S)
STAGING_MARKS = _struct(Symbol=_S, LastTs=_NTZ)

# Where indicators of a symbol can resume: its last block, the first bar to read for it, and what earlier blocks hand over.
INDICATOR_STATE = _struct(
    Symbol=_S, Recipe=_S, Block=_L, BlockTs=_NTZ, FromTs=_NTZ, FromRow=_L, Carried=T.MapType(_S, _D),
)

DEFINITIONS = _struct(IndicatorId=_I, IndicatorName=_S, DefaultParams=_S, IsActive=_I)
INDICATORS = _struct(
    Symbol=_S, PriceTimestamp=_NTZ, Timeframe=_S, IndicatorId=_I, IndicatorName=_S,
    IndicatorParams=_S, IndicatorValue=_D, FieldName=_S, addDateTime=_TZ,
)

FEATURE_SETS = _struct(FeatureSetID=_I, IsActive=_I)
FEATURE_SET_MEMBERS = _struct(FeatureSetID=_I, FeatureName=_S, Ordinal=_I)
MODEL_REGISTRY = _struct(
    ModelName=_S, RunID=_S, FeatureSetID=_I, LabelType=_S, LabelVersion=_S,
    HorizonMinutes=_I, MetricsJson=_S, ArtifactPath=_S,
)

# Output column names other jobs read by name.
INDICATOR_FIELDS = [
    "ADX_14", "ATR_14", "BBANDS_LOWER_20", "BBANDS_MIDDLE_20", "BBANDS_UPPER_20",
    "BOLL_PCTB_20", "BOLL_WIDTH_20", "CCI_20", "EMA_9", "EMA_20", "EMA_50", "EMA_200",
    "RSI_14", "SMA_20", "SMA_200", "STOCH_K_14", "STOCH_D_14", "SUPERTREND_10", "WILLIAMS_R_14",
]
CALENDAR_FIELDS = ["DayOfWeek", "IsRegularSession", "IsAfterHours"]
RUN_FIELDS = ["RunTimestamp", "MergeRunId"]
MERGED_SOURCE_COLUMNS = [
    *BAR_COLUMNS, *INDICATOR_FIELDS, *CALENDAR_FIELDS, "SourceIndicatorCount", "MissingIndicatorCount",
]
SIGNAL_METRICS = ["Return_1", "Return_5", "Return_20", "Volatility_20", "Momentum_10", "Range_Pct", "Body_Pct"]
SIGNAL_COLUMNS = [
    KEY, "FeatureTimestamp", *PRICES, "Volume", *INDICATOR_FIELDS, *CALENDAR_FIELDS, *SIGNAL_METRICS,
    "Target", "SignalVersion", "FeatureRunId", "RunDateTime", "MissingFeatureCount", "SourceIndicatorCount",
]

SIGNAL_FEATURES = T.StructType([
    T.StructField(name, {
        KEY: _S, "FeatureTimestamp": _NTZ, "Volume": _L, "DayOfWeek": _I, "IsRegularSession": _I,
        "IsAfterHours": _I, "SignalVersion": _I, "FeatureRunId": _S, "RunDateTime": _NTZ,
        "MissingFeatureCount": _I, "SourceIndicatorCount": _I,
    }.get(name, _D))
    for name in SIGNAL_COLUMNS
])
