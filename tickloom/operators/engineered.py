"""Features derived from merged bars and indicators, per symbol in time order."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rolling import long_parts, long_roll, percent_rank_last, roll, zscore_last
from tickloom.functions.scalars import clean_infinities, flag, nz, session_type
from tickloom.operators.series import block_window, core_rows, with_blocks, with_row_index
from tickloom.schemas import TS

# Frame lengths in bars.
RETURN_LAG = 1
REGIME_ROWS = 100
COMPRESSION_ROWS = 50
ZSCORE_ROWS = 50
SMOOTH_ROWS = 5
VOLUME_ROWS = 20
VOLUME_RANK_ROWS = 100
LOOKBACK = RETURN_LAG + max(REGIME_ROWS, COMPRESSION_ROWS, ZSCORE_ROWS, SMOOTH_ROWS, VOLUME_ROWS, VOLUME_RANK_ROWS)
SPIKE = 2

_C = F.col


def normalised() -> dict[str, Column]:
    """Moves and candle parts in units of the average true range."""
    scale, body_top, body_low = nz(_C("ATR_14")), F.greatest("OpenPrice", "ClosePrice"), F.least("OpenPrice", "ClosePrice")
    return {
        "Return_t_norm": (_C("ClosePrice") - _C("_last_close")) / scale,
        "CandleBody_norm": (_C("ClosePrice") - _C("OpenPrice")) / scale,
        "Range_norm": (_C("HighPrice") - _C("LowPrice")) / scale,
        "UpperWick_norm": (_C("HighPrice") - body_top) / scale,
        "LowerWick_norm": (body_low - _C("LowPrice")) / scale,
    }


def trend() -> dict[str, Column]:
    return {
        "EMA20_minus_EMA200": _C("EMA_20") - _C("EMA_200"),
        "EMA9_minus_EMA20": _C("EMA_9") - _C("EMA_20"),
        "SMA20_minus_SMA200": _C("SMA_20") - _C("SMA_200"),
        "Close_minus_EMA20": _C("ClosePrice") - _C("EMA_20"),
        "Close_minus_EMA200": _C("ClosePrice") - _C("EMA_200"),
    }


def regime() -> dict[str, Column]:
    return {
        "Volatility_regime": _C("ATR_14") / nz(long_roll("avg", "ATR_14", REGIME_ROWS, block_window())),
        "Trend_regime": flag(_C("EMA_20") > _C("EMA_200")),
        "HourOfDay": F.hour(TS),
        "MinuteOfHour": F.minute(TS),
        "SessionType": session_type(_C(TS)),
    }


def compression() -> dict[str, Column]:
    width = _C("BBANDS_UPPER_20") - _C("BBANDS_LOWER_20")
    return {
        "BBWidth": width,
        "BBWidth_norm": width / nz(_C("ATR_14")),
        "Range_vs_ATR": (_C("HighPrice") - _C("LowPrice")) / nz(_C("ATR_14")),
        "RollingRangeCompression": _C("Range_norm") / nz(roll(F.avg, _C("Range_norm"), COMPRESSION_ROWS, block_window())),
    }


def momentum() -> dict[str, Column]:
    return {
        "Return_zscore": zscore_last(_C("_return"), ZSCORE_ROWS, block_window()),
        "WilliamsR_smoothed": roll(F.avg, _C("WILLIAMS_R_14"), SMOOTH_ROWS, block_window()),
    }


def volume() -> dict[str, Column]:
    relative = _C("Volume") / nz(roll(F.avg, _C("Volume"), VOLUME_ROWS, block_window()))
    return {
        "Volume_rel": relative,
        "Volume_spike": flag(relative > SPIKE),
        "Volume_percentile": percent_rank_last(_C("Volume"), VOLUME_RANK_ROWS, block_window()),
    }


GROUPS = {
    "normalised": normalised,
    "trend": trend,
    "regime": regime,
    "compression": compression,
    "momentum": momentum,
    "volume": volume,
}


def add_engineered_features(merged: DataFrame, groups: list[str] | None = None, block_rows: int | None = None) -> DataFrame:
    """Append the engineered columns of the chosen groups (all by default).

    Needs bars, ATR_14, EMA_9/20/200, SMA_20/200, both outer Bollinger bands and WILLIAMS_R_14,
    as far as the groups use them. One numbering and one blocked pass serve every window.
    """
    groups = list(GROUPS) if groups is None else groups
    if "compression" in groups and "normalised" not in groups:
        raise ValueError("the compression group reads Range_norm: add the normalised group")
    w = block_window()
    last = F.lag("ClosePrice", RETURN_LAG).over(w)
    df = with_blocks(with_row_index(merged), before=LOOKBACK, rows=block_rows).withColumns({
        "_last_close": last,
        "_return": F.coalesce(_C("ClosePrice") / nz(last) - 1, F.lit(0.0)),
    })
    parts = long_parts("avg", "ATR_14", REGIME_ROWS, w) if "regime" in groups else {}
    df = df.withColumns(parts)
    for name in GROUPS:
        if name in groups:
            df = df.withColumns(GROUPS[name]())
    return clean_infinities(core_rows(df).drop("rn", "blk", "core", "_last_close", "_return", *parts))
