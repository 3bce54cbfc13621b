"""Indicators: blocks, first values, edge frames, and values against independent computations."""

from datetime import timedelta

import numpy as np
import pandas as pd
import pytest
from helpers import START, bar_rows, collect, frame, recursive_mean, supertrend, true_range, walk
from pyspark.sql import functions as F

from tickloom.operators.indicators import RECIPES, indicators, resume_indicators
from tickloom.schemas import BAR_COLUMNS, BARS

EVERY = [
    ("SMA", 20), ("SMA", 200), ("EMA", 2), ("EMA", 9), ("EMA", 200), ("RSI", 14), ("ATR", 14), ("ADX", 14), ("MACD", 0),
    ("OBV", 0), ("ROC", 12), ("VWAP", 0), ("CCI", 20), ("BBANDS_UPPER", 20), ("BBANDS_MIDDLE", 20), ("BBANDS_LOWER", 20),
    ("STOCH_K", 14), ("STOCH_D", 14), ("BOLL_WIDTH", 20), ("BOLL_PCTB", 20), ("WILLIAMS_R", 14), ("SUPERTREND", 10),
]
FIRST = {
    "SMA_20": 19, "SMA_200": 199, "EMA_2": 0, "EMA_9": 0, "EMA_200": 0, "RSI_14": 14, "ATR_14": 0, "ADX_14": 26, "MACD_0": 0,
    "OBV_0": 0, "ROC_12": 12, "VWAP_0": 0, "CCI_20": 38, "BBANDS_UPPER_20": 19, "BBANDS_MIDDLE_20": 19, "BBANDS_LOWER_20": 19,
    "STOCH_K_14": 13, "STOCH_D_14": 15, "BOLL_WIDTH_20": 19, "BOLL_PCTB_20": 19, "WILLIAMS_R_14": 13, "SUPERTREND_10": 0,
}


@pytest.fixture(scope="module")
def bars(spark):
    """One symbol holds most rows; two others are interleaved with it."""
    return frame(spark, walk("BIG", 1500, 1), walk("MID", 330, 2, step=7), walk("ONE", 1, 3)).cache()


@pytest.fixture(scope="module")
def wide(bars):
    return collect(indicators(bars, EVERY, keep=BAR_COLUMNS))


def test_one_row_per_bar(bars, wide):
    assert len(wide) == bars.count()


@pytest.mark.parametrize("rows", [256, 300])
def test_small_blocks_change_nothing(bars, wide, rows):
    small = collect(indicators(bars, EVERY, keep=BAR_COLUMNS, block_rows=rows))
    for name in FIRST:
        np.testing.assert_allclose(small[name], wide[name], rtol=1e-9, atol=1e-9, err_msg=name)


def test_cut_changes_nothing(bars, wide):
    again = collect(indicators(bars, EVERY, cut=True, block_rows=400))
    for name in FIRST:
        np.testing.assert_allclose(again[name], wide[name], rtol=1e-9, atol=1e-9, err_msg=name)


@pytest.mark.parametrize("name", FIRST)
def test_first_value_and_no_gaps_after(wide, name):
    values = wide[wide.Symbol == "BIG"][name].reset_index(drop=True)
    assert values.notna().idxmax() == FIRST[name]
    assert values[FIRST[name]:].notna().all()


@pytest.mark.parametrize("symbol", ["BIG", "MID", "ONE"])
def test_weighted_means_and_totals(wide, symbol):
    rows = wide[wide.Symbol == symbol].reset_index(drop=True)
    for span in (2, 9, 200):
        np.testing.assert_allclose(rows[f"EMA_{span}"], recursive_mean(rows.ClosePrice, 2 / (span + 1)), rtol=1e-10)
    np.testing.assert_allclose(rows.ATR_14, recursive_mean(true_range(rows), 1 / 14), rtol=1e-10)
    np.testing.assert_allclose(
        rows.MACD_0, recursive_mean(rows.ClosePrice, 2 / 13) - recursive_mean(rows.ClosePrice, 2 / 27), atol=1e-9)
    np.testing.assert_allclose(rows.OBV_0, (np.sign(rows.ClosePrice.diff().fillna(0)) * rows.Volume).cumsum())
    price = (rows.HighPrice + rows.LowPrice + rows.ClosePrice) / 3
    np.testing.assert_allclose(rows.VWAP_0, (price * rows.Volume).cumsum() / rows.Volume.cumsum(), rtol=1e-10)


@pytest.mark.parametrize("symbol", ["BIG", "MID", "ONE"])
def test_supertrend(wide, symbol):
    rows = wide[wide.Symbol == symbol].reset_index(drop=True)
    np.testing.assert_allclose(rows.SUPERTREND_10, supertrend(rows, 10), rtol=1e-9)


def test_long_mean_from_parts(wide):
    rows = wide[wide.Symbol == "BIG"].reset_index(drop=True)
    np.testing.assert_allclose(rows.SMA_200, rows.ClosePrice.rolling(200).mean(), rtol=1e-10)


def test_bounds(wide):
    k = wide.STOCH_K_14.dropna()
    assert k.between(-1e-9, 100 + 1e-9).all()
    assert wide.RSI_14.dropna().between(0, 100).all()
    assert wide.ADX_14.dropna().between(0, 100 + 1e-9).all()


def test_symbols_do_not_mix(spark, bars, wide):
    alone = collect(indicators(bars.where("Symbol = 'MID'"), EVERY))
    both = wide[wide.Symbol == "MID"].reset_index(drop=True)
    for name in FIRST:
        np.testing.assert_allclose(alone[name], both[name], rtol=1e-10, atol=1e-10, err_msg=name)


def test_constant_price_has_no_ratio(spark):
    flat = frame(spark, bar_rows("F", [5.0] * 60, [5.0] * 60, [5.0] * 60))
    out = collect(indicators(flat, [("RSI", 14), ("STOCH_K", 14), ("WILLIAMS_R", 14), ("CCI", 20), ("ADX", 14), ("BOLL_PCTB", 20), ("BOLL_WIDTH", 20), ("ATR", 14)]))
    for name in ("RSI_14", "STOCH_K_14", "WILLIAMS_R_14", "CCI_20", "ADX_14", "BOLL_PCTB_20"):
        assert out[name].isna().all(), name
    assert (out.BOLL_WIDTH_20.dropna() == 0).all() and (out.ATR_14 == 0).all()


def test_only_gains_give_no_rsi(spark):
    out = collect(indicators(frame(spark, bar_rows("UP", list(range(1, 40)))), [("RSI", 14)]))
    assert out.RSI_14.isna().all()


def test_zero_volume(spark):
    out = collect(indicators(frame(spark, bar_rows("Z", [1, 2, 3], volumes=[0, 0, 10])), [("VWAP", 0), ("OBV", 0)]))
    assert out.VWAP_0.isna().tolist() == [True, True, False]
    assert out.OBV_0.tolist() == [0.0, 0.0, 10.0]


def test_equal_moves_count_as_down(spark):
    """High rises and low falls by the same amount each bar: all movement is downward."""
    highs, lows = [10.0 + i for i in range(30)], [9.0 - i for i in range(30)]
    out = collect(indicators(frame(spark, bar_rows("T", [9.5] * 30, highs, lows)), [("ADX", 5)]))
    assert np.allclose(out.ADX_5.dropna(), 100.0) and out.ADX_5.notna().sum() == 30 - 8


def test_null_close_empties_the_frames_that_hold_it(spark):
    rows = bar_rows("N", [float(i) for i in range(1, 31)])
    rows[10] = (*rows[10][:5], None, rows[10][6])
    out = collect(indicators(frame(spark, rows), [("SMA", 5)]))
    assert out.SMA_5.isna().to_numpy().nonzero()[0].tolist() == [0, 1, 2, 3, 10, 11, 12, 13, 14]


def test_names_are_case_insensitive_and_unknown_raises(spark):
    small = frame(spark, bar_rows("A", [1, 2, 3]))
    assert "sma_2" in indicators(small, [("sma", 2)]).columns
    with pytest.raises(ValueError, match="unknown indicator"):
        indicators(small, [("NOPE", 1)])


def test_registry_is_complete():
    assert len(RECIPES) == 20 and RECIPES["SUPER_TREND"] is RECIPES["SUPERTREND"]


def test_empty_input(spark):
    assert indicators(frame(spark), EVERY).count() == 0


@pytest.mark.parametrize("rows", [64, 512, 2048])
def test_means_over_gaps_and_jumps(spark, rows):
    """Against pandas: missing closes at the start, single and by the hundred, a value of 1e30, spans from 1 to 5000."""
    data = walk("A", 3000, 1) + walk("B", 700, 2)
    holed = [
        (*r[:5], None if r[0] == "A" and (k < 4 or k % 7 == 3 or 900 < k < 1500) else 1e30 if k == 60 else r[5], *r[6:]) for k, r in enumerate(data)
    ]
    spans = (1, 2, 3, 9, 200, 5000)
    got = collect(indicators(frame(spark, holed), [("EMA", n) for n in spans] + [("ATR", 2), ("ATR", 14)], block_rows=rows))
    for symbol, bars in pd.DataFrame(holed, columns=BARS.fieldNames()).groupby("Symbol"):
        own, bars = got[got.Symbol == symbol].reset_index(drop=True), bars.reset_index(drop=True)
        for n in spans:
            np.testing.assert_allclose(own[f"EMA_{n}"], bars.ClosePrice.ewm(span=n, adjust=False).mean(), rtol=1e-9)
        for n in (2, 14):
            np.testing.assert_allclose(own[f"ATR_{n}"], true_range(bars).ewm(alpha=1 / n, adjust=False).mean(), rtol=1e-9)


@pytest.mark.parametrize("rows", [64, 2048])
def test_means_of_series_known_to_have_no_gaps(spark, rows):
    bars = frame(spark, walk("A", 1500, 3) + walk("B", 64, 4))
    wanted = [("EMA", 1), ("EMA", 2), ("EMA", 50), ("ATR", 14), ("MACD", 0), ("OBV", 0)]
    one, other = (collect(indicators(bars, wanted, block_rows=rows, gaps=g)) for g in (True, False))
    pd.testing.assert_frame_equal(one, other, rtol=1e-10)


@pytest.mark.parametrize("gaps", [True, False])
def test_resumed_runs_equal_a_full_one(spark, gaps):
    """Three runs; the second adds a symbol, and each reads no bar before the block it resumes with."""
    rows = walk("BIG", 1500, 1) + walk("MID", 330, 2, step=7) + walk("LATE", 40, 4, start=START + timedelta(minutes=900))
    if gaps:
        rows = [(*r[:5], None if i % 11 == 3 else r[5], r[6]) for i, r in enumerate(rows)]
    all_bars = frame(spark, rows).cache()
    choice = [("SMA", 200), ("RSI", 14), ("EMA", 1), ("EMA", 2), ("EMA", 200), ("ATR", 14), ("OBV", 0), ("VWAP", 0)]
    choice += [] if gaps else [("SUPERTREND", 10), ("CCI", 20)]  # bands need a close in every bar
    full = collect(indicators(all_bars, choice, block_rows=256, gaps=gaps))
    state, seen = None, START
    for end in (START + timedelta(minutes=700), START + timedelta(minutes=1100), START + timedelta(days=3)):
        bars = all_bars.where(F.col("PriceTimestamp") < end)
        if state is not None:
            since = state.select("Symbol", "FromTs")
            bars = bars.join(since, "Symbol", "left").where("FromTs IS NULL OR PriceTimestamp >= FromTs").drop("FromTs")
            assert bars.where("Symbol = 'BIG'").count() <= 256 + 256 + 400
        values, state = resume_indicators(bars, choice, state, block_rows=256, gaps=gaps)
        got = collect(values.where(F.col("PriceTimestamp") >= seen))
        want = full[(full.PriceTimestamp >= seen) & (full.PriceTimestamp < end)].reset_index(drop=True)
        assert got.Symbol.tolist() == want.Symbol.tolist() and got.PriceTimestamp.tolist() == want.PriceTimestamp.tolist()
        for name, param in choice:
            np.testing.assert_allclose(got[f"{name}_{param}"], want[f"{name}_{param}"], rtol=1e-9, atol=1e-9, err_msg=f"{name} {end}")
        seen = end
    assert {r.Symbol: r.Block for r in state.collect()} == {"BIG": 5, "MID": 1, "LATE": 0}


def test_states_of_other_recipes_are_not_used(spark):
    bars = frame(spark, walk("AAA", 600, 1))
    _, state = resume_indicators(bars, [("EMA", 9)], block_rows=64)
    wide = collect(resume_indicators(bars, [("EMA", 20)], state, block_rows=64)[0])
    assert len(wide) == 600
    empty, none = resume_indicators(bars.limit(0), [("EMA", 9), ("SUPERTREND", 10)], state.limit(0), block_rows=64)
    assert empty.count() == 0 and none.count() == 0
