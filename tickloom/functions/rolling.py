"""Rolling windows in row counts, with the minimum-observation rule.

`w` is an ordered window; blocks.py supplies one whose partitions are bounded.
"""

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def roll(agg: Callable[[Column], Column], x: Column, n: int, w: WindowSpec) -> Column:
    """agg over the last n rows; NULL until the frame holds n non-null values."""
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(x).over(frame) == n, agg(x).over(frame))


LONG_FRAME = 64
_PART = {"avg": ("sum", F.sum), "sum": ("sum", F.sum), "min": ("min", F.min), "max": ("max", F.max)}


def is_long(agg: str, n: int) -> bool:
    return agg in _PART and n >= LONG_FRAME


def _part_sizes(n: int) -> tuple[int, int]:
    """Part length near sqrt(n), dividing n where a divisor is close, and the remainder."""
    root = math.isqrt(n)
    size = next((m for m in range(root, root // 2, -1) if n % m == 0), root)
    return size, n % size


def long_parts(agg: str, x: str, n: int, w: WindowSpec) -> dict[str, Column]:
    """Short frames a long frame is put together from: Spark recomputes a sliding frame for every
    row, so n values cost n steps per row; parts of sqrt(n) rows cost about 2 sqrt(n)."""
    kind, fn = _PART[agg]
    return {f"_{kind}_{x.lstrip('_')}_{m}": roll(fn, F.col(x), m, w) for m in _part_sizes(n) if m}


def long_roll(agg: str, x: str, n: int, w: WindowSpec) -> Column:
    """roll(agg, x, n) from the columns of long_parts, which must exist before."""
    kind, _ = _PART[agg]
    size, rest = _part_sizes(n)
    name = f"_{kind}_{x.lstrip('_')}_{{}}".format
    parts = [F.lag(name(size), back).over(w) if back else F.col(name(size)) for back in range(0, n - rest, size)]
    if rest:
        parts.append(F.lag(name(rest), n - rest).over(w))
    if kind == "sum":
        total = reduce(lambda a, b: a + b, parts)
        return total / n if agg == "avg" else total
    complete = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(complete, F.greatest(*parts) if kind == "max" else F.least(*parts))


def pct_change(x: Column, n: int, w: WindowSpec) -> Column:
    before = F.lag(x, n).over(w)
    return x / F.when(before != 0, before) - 1


def diff(x: Column, n: int, w: WindowSpec) -> Column:
    return x - F.lag(x, n).over(w)


def cumulative(x: Column, w: WindowSpec) -> Column:
    return F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def zscore_last(x: Column, n: int, w: WindowSpec) -> Column:
    """Distance of the last value from the mean of its n-row frame, in deviations."""
    return (x - roll(F.avg, x, n, w)) / (roll(F.stddev_samp, x, n, w) + 1e-9)


def percent_rank_last(x: Column, n: int, w: WindowSpec) -> Column:
    """Average rank of the last value within its n-row frame, divided by n."""
    frame = F.collect_list(x).over(w.rowsBetween(1 - n, 0))
    less = F.size(F.filter(frame, lambda v: v < x))
    equal = F.size(F.filter(frame, lambda v: v == x))
    return F.when(F.size(frame) == n, (less + (equal + 1) / 2) / n)
