"""Exponentially weighted means and running totals over blocked series.

y = x at the first value; a value that comes d rows after the one before it gives

    y' = a y + (1 - a) x,   a = q^d / (q^d + alpha),   q = 1 - alpha

which is (1 - alpha) y + alpha x without gaps; rows without a value repeat y. Steps are affine, so any run
of them is one pair: an exponent e (what is kept of the state before it is exp(-e)) and a sum.

1. Rows of a block: e grows from 0 at the block's first value. Scaled by exp(e), the sum is a running
   one; as exp(e) overflows in the end, there is a running sum for each era of ERA in e.
2. Blocks of a symbol: each is one pair, and the pairs are summed in the same way, era by era of
   the symbol's exponent. What lies two eras back weighs exp(-ERA) at most and is the last that is added.
3. Every block takes the mean before it, and resumes.

Nothing is cut off but weights below exp(-2 ERA), which no double tells from zero.

A run that resumes brings the mean before its first block as one more block, whose only value that mean is.

Where series are known to have no gaps (`gaps=False`, as with bars that the staging merge let in), places and
exponents follow from row numbers, and a block's pair is a plain aggregate.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.series import block_window
from tickloom.schemas import KEY

ERA = 500.0  # exp(500) leaves a double room for values up to 1e90

_BEGIN = Window.unboundedPreceding


def span_alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def decay(alpha: float) -> float:
    return -math.log(1.0 - alpha)


def eras(alpha: float, rows: int) -> int:
    """Eras that the exponent of a block passes through."""
    return int(decay(alpha) * rows / ERA) + 1


def is_fill(alpha: float) -> bool:
    """A mean that keeps nothing: the last value."""
    return alpha >= 1.0


def _of(x: str, what: str) -> str:
    return f"_ewm_{x.lstrip('_')}__{what}"


def _value(x: str) -> Column:
    """Values of the block itself. Context rows do not count."""
    return F.when(F.col("core"), F.col(x))


def _share(alpha: float, gap: Column) -> Column:
    """Weight of a value that comes `gap` rows after the one before it."""
    return F.when(gap == 1, F.lit(alpha)).otherwise(alpha / (F.exp(gap * -decay(alpha)) + alpha))


def _damping(alpha: float, gap: Column) -> Column:
    """-ln a of the step to such a value."""
    return gap * decay(alpha) + F.when(gap == 1, F.lit(0.0)).otherwise(F.log(F.exp(gap * -decay(alpha)) + alpha))


def places(x: str) -> dict[str, Column]:
    """Rows of the block's first and last value up to here, of the value before, and the first value."""
    row = F.when(_value(x).isNotNull(), F.col("rn"))
    now, earlier = block_window().rowsBetween(_BEGIN, 0), block_window().rowsBetween(_BEGIN, -1)
    return {
        _of(x, "first"): F.min(row).over(now), _of(x, "last"): F.max(row).over(now), _of(x, "before"): F.max(row).over(earlier),
        _of(x, "value"): F.first(_value(x), ignorenulls=True).over(now),
    }


def _gap(x: str) -> Column:
    """Rows from the value before to this one; NULL at the block's first value and where there is none."""
    return F.when(_value(x).isNotNull(), F.col("rn") - F.col(_of(x, "before")))


def corrections(name: str, x: str, alpha: float) -> dict[str, Column]:
    """What gaps take off the exponent."""
    gap = _gap(x)
    return {_of(name, "off"): F.sum(F.when(gap > 1, _damping(alpha, gap) - gap * decay(alpha))).over(block_window().rowsBetween(_BEGIN, 0))}


def exponent(name: str, x: str, alpha: float, rows: int, gaps: bool) -> dict[str, Column]:
    if not gaps:
        return {_of(name, "e"): _pos(rows) * decay(alpha)}
    since = F.col(_of(x, "last")) - F.col(_of(x, "first"))
    return {_of(name, "e"): since * decay(alpha) + F.coalesce(_of(name, "off"), F.lit(0.0))}


def _pos(rows: int) -> Column:
    return (F.col("rn") % rows).cast("double")


def sums(name: str, x: str, alpha: float, rows: int, gaps: bool) -> dict[str, Column]:
    """Running sums of the scaled values after the block's first, one for each era."""
    e, now = F.col(_of(name, "e")), block_window().rowsBetween(_BEGIN, 0)
    share, counts = (_share(alpha, _gap(x)), _gap(x).isNotNull()) if gaps else (F.lit(alpha), F.col("core") & (_pos(rows) > 0))
    n = eras(alpha, rows)
    return {
        _of(name, f"sum{k}"): F.sum(F.when(counts & (F.floor(e / ERA) == k) if n > 1 else counts, share * F.col(x) * F.exp(e - ERA * k))).over(now)
        for k in range(n)
    }


def local_mean(name: str, alpha: float, rows: int) -> Column:
    """The part of the mean that comes from values after the block's first."""
    total = F.lit(0.0)
    for k in range(eras(alpha, rows)):
        part = F.col(_of(name, f"sum{k}"))
        total = total + F.when(part.isNotNull(), part * F.exp(ERA * k - F.col(_of(name, "e")))).otherwise(0.0)
    return total


def local_fill(x: str) -> Column:
    return F.last(_value(x), ignorenulls=True).over(block_window().rowsBetween(_BEGIN, 0))


def resume_mean(name: str, x: str, gaps: bool) -> Column:
    since = F.exp(-F.col(_of(name, "e"))) * F.col(f"{name}_first") + F.col(name)
    return F.when(F.col(_of(x, "first")).isNull(), F.col(f"{name}_in")).otherwise(since) if gaps else since


def resume_fill(name: str) -> Column:
    return F.coalesce(name, f"{name}_in")


def local_total(x: str) -> Column:
    return F.coalesce(F.sum(_value(x)).over(block_window().rowsBetween(_BEGIN, 0)), F.lit(0.0))


def _block_ends(framed: DataFrame, means: dict[str, tuple[str, float]], fills: dict[str, str], totals: dict[str, str]) -> DataFrame:
    """Places, exponents and sums at the last row of each block, and its totals."""
    last = [*(_of(x, c) for x in sorted({x for x, _ in means.values()}) for c in ("first", "last", "value")), *(c for k in means for c in (_of(k, "e"), k)), *fills]
    return framed.where("core").groupBy(KEY, "blk").agg(
        *([F.max_by(F.struct(*last), "rn").alias("end")] if last else []), *[F.sum(x).alias(name) for name, x in totals.items()],
    ).select(KEY, "blk", *[f"end.{c}" for c in last], *totals)


def _full_block_ends(staged: DataFrame, means: dict[str, tuple[str, float]], fills: dict[str, str], totals: dict[str, str], rows: int) -> DataFrame:
    """The same without gaps: plain aggregates. A symbol's last block may be shorter, but hands nothing over."""
    pos, end = _pos(rows), rows - 1
    later = {k: F.sum(F.when(pos > 0, alpha * F.col(x) * F.exp((pos - end) * decay(alpha)))) for k, (x, alpha) in means.items()}
    ends = staged.where("core").groupBy(KEY, "blk").agg(
        *[F.max(F.when(pos == 0, F.col(x))).alias(_of(x, "value")) for x in sorted({x for x, _ in means.values()})],
        *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in later.items()],
        *[F.max(F.when(pos == end, F.col(x))).alias(k) for k, x in fills.items()], *[F.sum(x).alias(name) for name, x in totals.items()],
    )
    places_ = {_of(x, c): F.col("blk") * rows + at for x, _ in means.values() for c, at in (("first", 0), ("last", end))}
    return ends.withColumns({**places_, **{_of(k, "e"): F.lit(decay(alpha) * end) for k, (_, alpha) in means.items()}})


def last_row(x: str) -> str:
    """Column of the carry table: row of the last value of `x` before the block."""
    return _of(x, "last_in")


def stored_ends(state: DataFrame, means: dict[str, tuple[str, float]], fills: dict[str, str], totals: dict[str, str]) -> DataFrame:
    """What a state hands over, as the end of the block before the one to resume with."""
    sources = sorted({x for x, _ in means.values()})
    return state.where("Block > 0").select(
        KEY, (F.col("Block") - 1).alias("blk"),
        *[F.col("Carried")[last_row(x)].cast("long").alias(_of(x, c)) for x in sources for c in ("first", "last")],
        *[F.lit(0.0).alias(_of(x, "value")) for x in sources], *[F.lit(0.0).alias(_of(k, "e")) for k in means],
        *[F.col("Carried")[k].alias(k) for k in (*means, *fills, *totals)],
    )


def carried(means: dict[str, tuple[str, float]], fills: dict[str, str], totals: dict[str, str]) -> dict[str, str]:
    """Names in a state and the columns of the carry table they come from."""
    return {**{last_row(x): last_row(x) for x, _ in means.values()}, **{k: f"{k}_in" for k in (*means, *fills, *totals)}}


def carry_table(
    rows_: DataFrame, means: dict[str, tuple[str, float]], fills: dict[str, str], totals: dict[str, str], rows: int, gaps: bool,
    state: DataFrame | None = None,
) -> DataFrame:
    """One row per (Symbol, blk): what all earlier blocks hand over. Pre-aggregated per block."""
    sources = sorted({x for x, _ in means.values()})
    ends = _block_ends(rows_, means, fills, totals) if gaps else _full_block_ends(rows_, means, fills, totals, rows)
    if state is not None:
        ends = ends.unionByName(stored_ends(state, means, fills, totals))
    blocks = Window.partitionBy(KEY).orderBy("blk")
    now, earlier = blocks.rowsBetween(_BEGIN, 0), blocks.rowsBetween(_BEGIN, -1)
    gap = {x: F.col(_of(x, "gap")) for x in sources}
    ends = ends.withColumns({_of(x, "gap"): F.col(_of(x, "first")) - F.max(_of(x, "last")).over(earlier) for x in sources})
    ends = ends.withColumns({_of(x, "seen"): F.max(_of(x, "last")).over(earlier).isNotNull() for x in sources})
    steps = {}
    for k, (x, alpha) in means.items():
        e, first = F.col(_of(k, "e")), F.col(_of(x, "first"))
        share = F.when(gap[x].isNull(), F.lit(1.0)).otherwise(_share(alpha, gap[x]))
        steps[_of(k, "step")] = F.when(first.isNull() | gap[x].isNull(), F.lit(0.0)).otherwise(e + _damping(alpha, gap[x]))
        steps[_of(k, "adds")] = F.when(first.isNull(), F.lit(0.0)).otherwise(F.exp(-e) * share * F.col(_of(x, "value")) + F.col(k))
    ends = ends.withColumns(steps).withColumns({_of(k, "c"): F.sum(_of(k, "step")).over(now) for k in means})
    ends = ends.withColumns({_of(k, "era"): F.floor(F.col(_of(k, "c")) / ERA) for k in means})
    within = {}
    for k in means:
        inside = F.col(_of(k, "c")) - ERA * F.col(_of(k, "era"))
        era = Window.partitionBy(KEY, _of(k, "era")).orderBy("blk").rowsBetween(_BEGIN, 0)
        within[_of(k, "y0")] = F.exp(-inside) * F.sum(F.col(_of(k, "adds")) * F.exp(inside)).over(era)
    ends = ends.withColumns(within).withColumns({_of(k, "closes"): F.coalesce(F.lead(_of(k, "era")).over(blocks) != F.col(_of(k, "era")), F.lit(False)) for k in means})
    for n in (0, 1):  # the era before, and the one before that
        before = {_of(k, f"p{n}"): F.last(F.when(F.col(_of(k, "closes")), F.struct(F.col(_of(k, "c")).alias("c"), F.col(_of(k, f"y{n}")).alias("y"))), ignorenulls=True).over(earlier) for k in means}
        ends = ends.withColumns(before).withColumns({
            _of(k, f"y{n + 1}"): F.col(_of(k, "y0")) + F.coalesce(F.exp(F.col(_of(k, f"p{n}"))["c"] - F.col(_of(k, "c"))) * F.col(_of(k, f"p{n}"))["y"], F.lit(0.0)) for k in means
        })
    ends = ends.withColumns({f"{k}_in": F.when(F.col(_of(x, "seen")), F.lag(_of(k, "y2")).over(blocks)) for k, (x, _) in means.items()})
    first = {}
    for k, (x, alpha) in means.items():
        share = _share(alpha, gap[x])
        first[f"{k}_first"] = F.when(gap[x].isNull(), F.col(_of(x, "value"))).otherwise((1 - share) * F.col(f"{k}_in") + share * F.col(_of(x, "value")))
    return ends.withColumns(first).select(
        KEY, "blk", *[f"{k}_{c}" for k in means for c in ("in", "first")],
        *[F.max(_of(x, "last")).over(earlier).alias(last_row(x)) for x in sources],
        *[F.last(k, ignorenulls=True).over(earlier).alias(f"{k}_in") for k in fills],
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0.0)).alias(f"{name}_in") for name in totals],
    )
