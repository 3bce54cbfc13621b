"""Small frames and independent computations for the tests."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd

from tickloom.schemas import BARS

START = datetime(2024, 3, 4, 9, 0)


def bar_rows(symbol: str, closes, highs=None, lows=None, opens=None, volumes=None, start=START, step=1):
    """Bar tuples, one per `step` minutes."""
    n = len(closes)
    highs = [c + 1.0 for c in closes] if highs is None else highs
    lows = [c - 1.0 for c in closes] if lows is None else lows
    opens = closes if opens is None else opens
    volumes = [100] * n if volumes is None else volumes
    return [
        (symbol, start + timedelta(minutes=step * i), float(opens[i]), float(highs[i]), float(lows[i]), float(closes[i]), int(volumes[i]))
        for i in range(n)
    ]


def frame(spark, *groups):
    return spark.createDataFrame([row for rows in groups for row in rows], BARS)


def walk(symbol: str, n: int, seed: int, step: int = 1, start=START):
    rng = np.random.default_rng(seed)
    close = np.round(100 + np.cumsum(rng.normal(0, 1, n)), 2)
    spread = np.round(rng.uniform(0.05, 2, (2, n)), 2)
    opens = np.round(close + rng.normal(0, 0.3, n), 2)
    high, low = np.maximum(opens, close) + spread[0], np.minimum(opens, close) - spread[1]
    return bar_rows(symbol, close, high, low, opens, rng.integers(1, 5000, n), start, step)


def collect(df) -> pd.DataFrame:
    return df.toPandas().sort_values(["Symbol", "PriceTimestamp"]).reset_index(drop=True)


def true_range(bars: pd.DataFrame) -> pd.Series:
    last = bars.ClosePrice.shift()
    return pd.concat([
        bars.HighPrice - bars.LowPrice, (bars.HighPrice - last).abs(), (bars.LowPrice - last).abs(),
    ], axis=1).max(axis=1)


def recursive_mean(x, alpha: float) -> np.ndarray:
    out, y = [], None
    for v in x:
        y = v if y is None else y + alpha * (v - y)
        out.append(y)
    return np.array(out)


def supertrend(bars: pd.DataFrame, n: int, multiplier: float = 3.0) -> np.ndarray:
    """The definition, one bar after the other."""
    middle, reach = (bars.HighPrice + bars.LowPrice) / 2, multiplier * recursive_mean(true_range(bars), 1 / n)
    upper, lower, close = (middle + reach).to_numpy(), (middle - reach).to_numpy(), bars.ClosePrice.to_numpy()
    up, down, rising, line = upper[0], lower[0], True, [lower[0]]
    for top, bottom, before, now in zip(upper[1:], lower[1:], close[:-1], close[1:]):
        up = min(top, up) if before <= up else top
        down = max(bottom, down) if before >= down else bottom
        rising = True if now > up else False if now < down else rising
        line.append(down if rising else up)
    return np.array(line)
