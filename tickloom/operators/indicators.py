"""Technical indicators over OHLCV bars, many at once in one pass.

A recipe asks a `Workbench` for the columns it needs (lags, pointwise terms, rolling frames,
weighted means, running totals) and returns the expression of its value. Terms are shared by
name, so the three Bollinger lines, their width and %b cost one mean and one deviation. All
recipes of a run are then evaluated over the same blocks: one shuffle of the bars, stacked
windows over one ordering, and one join with the small table of block carries.
"""

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.rolling import is_long, long_parts, long_roll, roll
from tickloom.functions.scalars import nz
from tickloom.operators import ewm
from tickloom.operators.series import block_rows_for, block_window, core_rows, with_blocks, with_row_index
from tickloom.operators.supertrend import carried as supertrend_carried
from tickloom.operators.supertrend import supertrend_lines
from tickloom.schemas import KEY, TS
from tickloom.session import cut_lineage

OPEN_TO_CLOSE = {"high": "HighPrice", "low": "LowPrice", "close": "ClosePrice", "volume": "Volume"}
AGGREGATES = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "std": F.stddev_samp}


@dataclass
class Workbench:
    """Columns the requested recipes share, by the step that computes them."""

    prices: set[str] = field(default_factory=set)
    lags: dict[str, Column] = field(default_factory=dict)
    terms: dict[str, Column] = field(default_factory=dict)
    frames: dict[str, tuple[str, str, int]] = field(default_factory=dict)
    derived: dict[str, Column] = field(default_factory=dict)
    derived_frames: dict[str, tuple[str, str, int]] = field(default_factory=dict)
    means: dict[str, tuple[str, float]] = field(default_factory=dict)
    totals: dict[str, str] = field(default_factory=dict)
    trends: dict[str, tuple[str, float]] = field(default_factory=dict)
    lag_rows: int = 0
    reach: dict[str, int] = field(default_factory=dict)

    def price(self, short: str) -> str:
        self.prices.add(OPEN_TO_CLOSE[short])
        return OPEN_TO_CLOSE[short]

    def lag(self, short: str, n: int = 1) -> Column:
        name = f"_{short}_lag{n}"
        self.lags[name] = F.lag(self.price(short), n).over(block_window())
        self.lag_rows = max(self.lag_rows, n)
        return F.col(name)

    def bar(self, short: str) -> Column:
        return F.col(self.price(short))

    def term(self, name: str, value: Column) -> str:
        self.terms[name] = value
        return name

    def derive(self, name: str, value: Column, inner: int) -> str:
        """A value built from rolling frames that itself gets rolled; `inner` rows feed it."""
        self.derived[name] = value
        self.reach[name] = inner
        return name

    def roll(self, agg: str, x: str, n: int) -> Column:
        name = f"_{agg}_{x.lstrip('_')}_{n}"
        target = self.derived_frames if x in self.derived else self.frames
        target[name] = (agg, x, n)
        self.reach[name] = n + self.reach.get(x, 0)
        return F.col(name)

    def mean_name(self, x: str, alpha: float) -> str:
        name = f"_ewm_{x.lstrip('_')}_{alpha:.12g}".replace(".", "p")
        self.means[name] = (x, alpha)
        return name

    def mean(self, x: str, alpha: float) -> Column:
        return F.col(self.mean_name(x, alpha))

    def total(self, x: str) -> Column:
        name = f"_total_{x.lstrip('_')}"
        self.totals[name] = x
        return F.col(name)

    def before(self) -> int:
        return self.lag_rows + max(self.reach.values(), default=0)


# --- shared terms ---------------------------------------------------------------------------

def true_range(b: Workbench) -> str:
    high, low, last = b.bar("high"), b.bar("low"), b.lag("close")
    return b.term("_tr", F.greatest(high - low, F.abs(high - last), F.abs(low - last)))


def typical_price(b: Workbench) -> str:
    return b.term("_tp", (b.bar("high") + b.bar("low") + b.bar("close")) / 3)


def _channel(b: Workbench, n: int) -> tuple[Column, Column]:
    return b.roll("max", b.price("high"), n), b.roll("min", b.price("low"), n)


def _bands(b: Workbench, n: int) -> tuple[Column, Column, Column]:
    mid, std = b.roll("avg", b.price("close"), n), b.roll("std", b.price("close"), n)
    return mid + 2 * std, mid, mid - 2 * std


# --- recipes --------------------------------------------------------------------------------

def sma(b: Workbench, n: int) -> Column:
    return b.roll("avg", b.price("close"), n)


def ema(b: Workbench, n: int) -> Column:
    return b.mean(b.price("close"), ewm.span_alpha(n))


def rsi(b: Workbench, n: int) -> Column:
    """Simple rolling means of gains and losses; NULL while there is no loss in the frame."""
    change = b.bar("close") - b.lag("close")
    gain = b.term("_gain", F.when(change.isNotNull(), F.greatest(change, F.lit(0.0))))
    loss = b.term("_loss", F.when(change.isNotNull(), F.greatest(-change, F.lit(0.0))))
    strength = b.roll("avg", gain, n) / nz(b.roll("avg", loss, n))
    return 100 - 100 / (1 + strength)


def atr(b: Workbench, n: int) -> Column:
    """Wilder smoothing of the true range, seeded by the first one."""
    return b.mean(true_range(b), 1.0 / n)


def adx(b: Workbench, n: int) -> Column:
    """Rolling-sum variant. Equal up and down moves count as down."""
    up, down = b.bar("high") - b.lag("high"), b.lag("low") - b.bar("low")
    rise = F.when((up > down) & (up > 0), up).otherwise(0.0)
    plus = b.term("_plus_dm", rise)
    minus = b.term("_minus_dm", F.when((down > rise) & (down > 0), down).otherwise(0.0))
    span = nz(b.roll("sum", true_range(b), n))
    plus_di, minus_di = 100 * (b.roll("sum", plus, n) / span), 100 * (b.roll("sum", minus, n) / span)
    index = F.abs(plus_di - minus_di) / nz(plus_di + minus_di) * 100
    return b.roll("avg", b.derive(f"_dx_{n}", index, n), n)


def macd(b: Workbench, n: int) -> Column:
    """12/26 line only; the parameter has no effect."""
    return ema(b, 12) - ema(b, 26)


def obv(b: Workbench, n: int) -> Column:
    direction = F.coalesce(F.signum(b.bar("close") - b.lag("close")), F.lit(0.0))
    return b.total(b.term("_signed_volume", direction * b.bar("volume")))


def roc(b: Workbench, n: int) -> Column:
    return (b.bar("close") / nz(b.lag("close", n)) - 1) * 100


def vwap(b: Workbench, n: int) -> Column:
    """Over the whole history of the symbol."""
    turnover = b.term("_turnover", b.terms[typical_price(b)] * b.bar("volume"))
    traded = b.term("_traded", b.bar("volume").cast("double"))
    return b.total(turnover) / nz(b.total(traded))


def cci(b: Workbench, n: int) -> Column:
    """The mean deviation averages each row's distance from its own moving average."""
    tp = typical_price(b)
    off = F.col(tp) - b.roll("avg", tp, n)
    spread = b.roll("avg", b.derive(f"_tp_off_{n}", F.abs(off), n), n)
    return off / (0.015 * nz(spread))


def bbands_upper(b: Workbench, n: int) -> Column:
    return _bands(b, n)[0]


def bbands_middle(b: Workbench, n: int) -> Column:
    return _bands(b, n)[1]


def bbands_lower(b: Workbench, n: int) -> Column:
    return _bands(b, n)[2]


def boll_width(b: Workbench, n: int) -> Column:
    upper, mid, lower = _bands(b, n)
    return (upper - lower) / nz(mid)


def boll_pctb(b: Workbench, n: int) -> Column:
    upper, _, lower = _bands(b, n)
    return (b.bar("close") - lower) / nz(upper - lower)


def stoch_k(b: Workbench, n: int) -> Column:
    high, low = _channel(b, n)
    return 100 * (b.bar("close") - low) / nz(high - low)


def stoch_d(b: Workbench, n: int) -> Column:
    return b.roll("avg", b.derive(f"_k_{n}", stoch_k(b, n), n), 3)


def williams_r(b: Workbench, n: int) -> Column:
    high, low = _channel(b, n)
    return -100 * (high - b.bar("close")) / nz(high - low)


def supertrend(b: Workbench, n: int, multiplier: float = 3.0) -> tuple[str, float]:
    """Not a column but an order for the fold in supertrend.py: range column and multiplier."""
    b.lag("close")
    return b.mean_name(true_range(b), 1.0 / n), multiplier


# The indicator names a definitions table may use.
RECIPES: dict[str, Callable[[Workbench, int], Column | tuple[str, float]]] = {
    "SMA": sma,
    "EMA": ema,
    "RSI": rsi,
    "ATR": atr,
    "ADX": adx,
    "MACD": macd,
    "OBV": obv,
    "ROC": roc,
    "VWAP": vwap,
    "CCI": cci,
    "BBANDS_UPPER": bbands_upper,
    "BBANDS_MIDDLE": bbands_middle,
    "BBANDS_LOWER": bbands_lower,
    "STOCH_K": stoch_k,
    "STOCH_D": stoch_d,
    "BOLL_WIDTH": boll_width,
    "BOLL_PCTB": boll_pctb,
    "WILLIAMS_R": williams_r,
    "SUPER_TREND": supertrend,
    "SUPERTREND": supertrend,
}


def recipe(name: str) -> Callable[[Workbench, int], Column | tuple[str, float]]:
    found = RECIPES.get(name.upper())
    if found is None:
        raise ValueError(f"unknown indicator {name!r}; known: {', '.join(RECIPES)}")
    return found


def indicators(
    bars: DataFrame,
    wanted: Iterable[tuple[str, int]],
    keep: Iterable[str] = (),
    block_rows: int | None = None,
    cut: bool = False,
    gaps: bool = True,
) -> DataFrame:
    """Wide frame: Symbol, PriceTimestamp, `keep` columns and one NAME_param column per pair.

    Every bar gives one row; values are NULL until a window has filled. Carried state and
    SuperTrend read their input twice: `cut` writes it to the checkpoint folder first, which
    pays on large tables and when `bars` is itself costly to compute. Prices may be NULL; where they
    cannot be, as in bars that the staging merge let in, `gaps=False` saves two passes for means.
    """
    return _evaluate(bars, wanted, keep, block_rows, cut, gaps)[0]


def recipe_name(wanted: Iterable[tuple[str, int]], block_rows: int | None = None, gaps: bool = True) -> str:
    """What a stored state was made by; another choice of indicators or blocks starts from the first bar."""
    names = sorted({f"{name}_{int(param)}" for name, param in wanted})
    return " ".join([*names, f"blocks {block_rows or 'auto'}", "gaps" if gaps else "no gaps"])


def resume_indicators(
    bars: DataFrame,
    wanted: Iterable[tuple[str, int]],
    state: DataFrame | None = None,
    keep: Iterable[str] = (),
    block_rows: int | None = None,
    gaps: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """As `indicators`, but each symbol in `state` starts with its stored block; returns values and the next state.

    A state has one row per symbol (INDICATOR_STATE): the last block, its first time, the first bar to read (the
    block's look-back included) and the means, totals and bands before the block. `bars` may leave out what
    lies before FromTs; rows from BlockTs on get values, the same as from all bars. It holds as long as no
    bar before BlockTs changes. Symbols without a state start from their first bar. Rows of other recipes
    in `state` are not looked at.
    """
    wanted = list(wanted)
    known = None
    if state is not None:
        known = state.where(F.col("Recipe") == recipe_name(wanted, block_rows, gaps))
        since = known.select(KEY, F.col("FromTs").alias("_from_ts"), F.col("FromRow").alias("_from_row"), F.col("Block").alias("_from_blk"))
        bars = bars.join(since, KEY, "left").where(F.col("_from_ts").isNull() | (F.col(TS) >= F.col("_from_ts")))
    values, after = _evaluate(bars, wanted, keep, block_rows, True, gaps, known, hand_over=True)
    return values, after


def _next_state(numbered: DataFrame, tables: list[tuple[DataFrame, dict[str, str]]], before: int, rows: int, recipe_: str) -> DataFrame:
    """Each symbol's last block, and what the tables (Symbol, blk, …) hand over to it."""
    blocks = numbered.groupBy(KEY, F.expr(f"rn div {rows}").alias("blk")).agg(
        F.min(TS).alias("BlockTs"), F.min(F.when(F.col("rn") % rows >= rows - before, F.col(TS))).alias("_tail"),
    )
    in_order = Window.partitionBy(KEY).orderBy("blk")
    last = (
        blocks.withColumn("FromTs", F.coalesce(F.lag("_tail").over(in_order), F.col("BlockTs")))
        .groupBy(KEY).agg(F.max_by(F.struct("blk", "BlockTs", "FromTs"), "blk").alias("last")).select(KEY, "last.*")
    )
    entries = []
    for table, names in tables:
        last = last.join(table.select(KEY, "blk", *[F.col(c).alias(f"_{len(entries) + i}") for i, c in enumerate(names.values())]), [KEY, "blk"], "left")
        entries += [(F.lit(name), F.col(f"_{len(entries) + i}").cast("double")) for i, name in enumerate(names)]
    carried = F.create_map(*[x for pair in entries for x in pair]) if entries else F.create_map()
    return last.select(
        KEY, F.lit(recipe_).alias("Recipe"), F.col("blk").alias("Block"), "BlockTs", "FromTs",
        F.greatest(F.col("blk") * rows - before, F.lit(0)).cast("long").alias("FromRow"), carried.cast("map<string,double>").alias("Carried"),
    )


def _evaluate(
    bars: DataFrame, wanted: Iterable[tuple[str, int]], keep: Iterable[str], block_rows: int | None, cut: bool, gaps: bool,
    state: DataFrame | None = None, hand_over: bool = False,
) -> tuple[DataFrame, DataFrame | None]:
    wanted = list(wanted)
    b, values = Workbench(), {}
    for name, param in wanted:
        value = recipe(name)(b, int(param))
        if isinstance(value, Column):
            values[f"{name}_{param}"] = value
        else:
            values[f"{name}_{param}"] = None
            b.trends[f"{name}_{param}"] = value
    keep = [c for c in keep if c not in (KEY, TS)]
    needed = sorted(b.prices | set(keep))
    rows = block_rows or block_rows_for(b.before())
    means = {k: v for k, v in b.means.items() if not ewm.is_fill(v[1])}
    fills = {k: x for k, (x, _) in b.means.items() if k not in means}

    resumes = ["_from_row", "_from_blk"] if state is not None else []
    numbered = with_row_index(bars.select(KEY, TS, *needed, *resumes))
    if resumes:
        numbered = numbered.withColumn("rn", F.col("rn") + F.coalesce("_from_row", F.lit(0)))
    if cut and (hand_over or b.means or b.totals or b.trends):
        numbered = cut_lineage(numbered)
    blocked = with_blocks(numbered, before=b.before(), rows=rows)
    if resumes:  # rows before the first block are look-back only
        blocked = blocked.where(F.col("blk") >= F.coalesce("_from_blk", F.lit(0))).drop(*resumes)
    w = block_window()
    staged = blocked.withColumns(b.lags).withColumns(b.terms)
    long = {k: f for k, f in b.frames.items() if is_long(f[0], f[2])}
    framed = staged.withColumns({
        **{k: roll(AGGREGATES[agg], F.col(x), n, w) for k, (agg, x, n) in b.frames.items() if k not in long},
        **{k: part for agg, x, n in long.values() for k, part in long_parts(agg, x, n, w).items()},
        **{k: place for x in sorted({x for x, _ in means.values()}) if gaps for k, place in ewm.places(x).items()},
        **{k: ewm.local_fill(x) for k, x in fills.items()},
        **{k: ewm.local_total(x) for k, x in b.totals.items()},
    })
    framed = framed.withColumns({k: long_roll(agg, x, n, w) for k, (agg, x, n) in long.items()})
    stages = [ewm.corrections] if gaps else []
    stages += [lambda *m: ewm.exponent(*m, rows, gaps), lambda *m: ewm.sums(*m, rows, gaps), lambda k, x, alpha: {k: ewm.local_mean(k, alpha, rows)}]
    for stage in stages if means else ():
        framed = framed.withColumns({n: c for k, (x, alpha) in means.items() for n, c in stage(k, x, alpha).items()})
    resumed = framed if gaps else staged
    if b.derived:
        framed = framed.withColumns(b.derived)
        framed = framed.withColumns({k: roll(AGGREGATES[agg], F.col(x), n, w) for k, (agg, x, n) in b.derived_frames.items()})
    out = core_rows(framed)
    tables = []
    if b.means or b.totals:
        carry = ewm.carry_table(resumed, means, fills, b.totals, rows, gaps, state)
        if hand_over:
            carry = cut_lineage(carry)
        tables.append((carry, ewm.carried(means, fills, b.totals)))
        out = out.join(carry, [KEY, "blk"], "left").withColumns({
            **{k: ewm.resume_mean(k, x, gaps) for k, (x, _) in means.items()},
            **{k: ewm.resume_fill(k) for k in fills},
            **{k: F.col(k) + F.col(f"{k}_in") for k in b.totals},
        })
    plain = {k: v.cast("double") for k, v in values.items() if k not in b.trends}
    if b.trends:
        ranges = {atr_column for atr_column, _ in b.trends.values()}
        out = out.select(KEY, TS, "blk", "rn", *needed, "_close_lag1", *ranges, *[v.alias(k) for k, v in plain.items()])
        if cut:
            out = cut_lineage(out)
        for name, (atr_column, multiplier) in b.trends.items():
            out, entering = supertrend_lines(out, name, atr_column, multiplier, state, hand_over)
            tables.append((entering, supertrend_carried(name)))
        out = out.select(KEY, TS, *keep, *values)
    else:
        out = out.select(KEY, TS, *keep, *[v.alias(k) for k, v in plain.items()])
    return out, _next_state(numbered, tables, b.before(), rows, recipe_name(wanted, block_rows, gaps)) if hand_over else None
