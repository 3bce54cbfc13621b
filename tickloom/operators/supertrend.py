"""SuperTrend as a blocked fold.

A band either stays where it is or jumps to its basic value:

    upper' = basic  if basic < upper or last close > upper  else upper

so one step keeps the old value exactly when it lies in [last close, basic]. Chained over a
block, a step can only narrow that interval, and every value that leaves it at one row
continues alike. A block is therefore described by its exits (interval edges and the band at
the block end after that exit): a short table that does not need the state before the block.
Three passes, none of which sees a whole symbol's bars: describe each block, fold the block
table per symbol to get the state entering each block, follow each block from its state.
The lower band is the same rule on negated prices.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.series import block_window
from tickloom.schemas import KEY
from tickloom.session import cut_lineage

_EXIT_COLUMNS = ["below", "above", "level", "crossed_below", "crossed_above"]


def block_exits(last: np.ndarray, close: np.ndarray, basic: np.ndarray) -> dict[str, list[float]]:
    """Exits of one block for the upper band, in row order.

    Entering values < below or > above leave at that row; `level` is the band at the block end
    from then on and crossed_* the last row (or -1) where the close stood above the band.
    """
    last, close, basic = last.tolist(), close.tolist(), basic.tolist()
    exits: list[tuple[float, float, int, int]] = []  # below, above, path, row crossed on leaving
    paths: list[list[float]] = []  # level, last crossing row, path it merged into
    live: list[int] = []
    low, high, open_ = -np.inf, np.inf, True
    i = 0
    while i < len(close) and (open_ or len(live) > 1):
        edge, top = last[i], basic[i]
        jumping = [p for p in live if top < paths[p][0] or edge > paths[p][0]]
        leaves = open_ and (edge > low or top < high)
        if jumping or leaves:
            new = len(paths)
            paths.append([top, -1, -1])
            for p in jumping:
                paths[p][2] = new
            live = [p for p in live if p not in jumping] + [new]
            if leaves:
                exits.append((edge if edge > low else -np.inf, top if top < high else np.inf, new, i - 1))
                low, high = edge if edge > low else low, top if top < high else high
                open_ = low <= high
        for p in live:
            if close[i] > paths[p][0]:
                paths[p][1] = i
        i += 1
    if i < len(close):  # every entering value is on one path by now
        path = paths[live[0]]
        level, crossed, _ = path
        for row in range(i, len(close)):
            top = basic[row]
            if top < level or last[row] > level:
                level = top
            if close[row] > level:
                crossed = row
        path[0], path[1] = level, crossed

    table: dict[str, list[float]] = {name: [] for name in _EXIT_COLUMNS}
    for below, above, path, row in exits:
        crossed = -1
        while True:
            level, at, merged = paths[path]
            crossed = max(crossed, int(at))
            if merged < 0:
                break
            path = int(merged)
        for name, value in zip(_EXIT_COLUMNS, (below, above, level, max(row, crossed), crossed)):
            table[name].append(float(value))
    return table


def leave_block(value: float, exits: dict[str, Iterable[float]], final_close: float, rows: int) -> tuple[float, int]:
    """Band at the block end and last crossing row, for the value entering the block."""
    below, above = np.asarray(exits["below"]), np.asarray(exits["above"])
    out = np.flatnonzero((value < below) | (value > above))
    if len(out):
        k = out[0]
        crossed = exits["crossed_below"][k] if value < below[k] else exits["crossed_above"][k]
        return float(exits["level"][k]), int(crossed)
    return value, rows - 1 if final_close > value else -1


def _floats(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    """Columns as float arrays, NULL as NaN."""
    return [np.asarray(batch.column(n).to_numpy(zero_copy_only=False), dtype=float) for n in names]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole blocks in order to one row per block. Holds one block at a time."""
    parts: list[np.ndarray] = []
    name: tuple = ()

    def finish() -> dict:
        last, close, upper, lower = np.concatenate(parts, axis=1)
        row = {KEY: name[0], "blk": name[1], "rows": len(close), "close": float(close[-1])}
        for side, exits in (("up", block_exits(last, close, upper)), ("down", block_exits(-last, -close, -lower))):
            row.update({f"{side}_{c}": exits[c] for c in _EXIT_COLUMNS})
        return row

    for batch in batches:
        data = np.stack(_floats(batch, "last", "close", "upper", "lower"))
        starts = np.flatnonzero(np.asarray(batch.column("at").to_numpy()) == 1)
        rows, begin = [], 0
        for start in [*starts, batch.num_rows]:
            if start > begin:
                parts.append(data[:, begin:start])
            if start < batch.num_rows:
                if parts:
                    rows.append(finish())
                parts, name = [], (batch.column(KEY)[int(start)].as_py(), batch.column("blk")[int(start)].as_py())
            begin = start
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _block_schema(batch))
        shape = batch
    if parts:
        yield pa.RecordBatch.from_pylist([finish()], _block_schema(shape))


def _block_schema(batch: pa.RecordBatch) -> pa.Schema:
    exits = [(f"{side}_{c}", pa.list_(pa.float64())) for side in ("up", "down") for c in _EXIT_COLUMNS]
    return pa.schema([(KEY, batch.schema.field(KEY).type), ("blk", pa.int64()), ("rows", pa.int64()), ("close", pa.float64()), *exits])


def _enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each symbol in order to the state entering them. Holds the running state only.

    Before the first row both bands are wide open, unless a stored state says where they were (*_0). The
    first bar never turns the trend.
    """
    state, trend = {}, 1
    for batch in batches:
        out = []
        for block in batch.to_pylist():
            if block["at"] == 1:
                resumed = block["trend_0"] is not None
                state = {"up": block["up_0"], "down": block["down_0"]} if resumed else {"up": np.inf, "down": np.inf}
                trend = int(block["trend_0"]) if resumed else 1
            out.append((state["up"], state["down"], trend))
            crossed = {}
            for side, sign in (("up", 1), ("down", -1)):
                exits = {name: block[f"{side}_{name}"] for name in _EXIT_COLUMNS}
                state[side], crossed[side] = leave_block(state[side], exits, sign * block["close"], block["rows"])
                if block["blk"] == 0 and crossed[side] == 0:
                    crossed[side] = -1
            if max(crossed.values()) >= 0:
                trend = 1 if crossed["up"] >= crossed["down"] else -1
        up, down, turn = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column(KEY), batch.column("blk"), pa.array(up, pa.float64()), pa.array(down, pa.float64()), pa.array(turn, pa.int64())],
            names=[KEY, "blk", "up_in", "down_in", "trend_in"],
        )


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow both bands and the trend row by row; every other column passes through untouched."""
    up = low = trend = None
    for batch in batches:
        line = np.empty(batch.num_rows)
        columns = _floats(batch, "at", "rn", "last", "close", "upper", "lower", "up_in", "down_in", "trend_in")
        for i, (at, rn, last, close, top, bottom, up_in, down_in, trend_in) in enumerate(zip(*[c.tolist() for c in columns])):
            if at == 1:
                up, low, trend = up_in, -down_in, trend_in
            if top < up or last > up:
                up = top
            if bottom > low or last < low:
                low = bottom
            if rn == 0:
                trend = 1
            elif close > up:
                trend = 1
            elif close < low:
                trend = -1
            line[i] = low if trend == 1 else up
        yield batch.append_column("line", pa.array(line))


def carried(name: str) -> dict[str, str]:
    """Names in a state and the columns of the state table they come from."""
    return {f"{name} {c}": f"{c}_in" for c in ("up", "down", "trend")}


def supertrend_lines(
    blocked: DataFrame, name: str, atr: str, multiplier: float, state: DataFrame | None = None, keep: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Add column `name` to core rows carrying rn, blk, prices, the lagged close and `atr`.

    `at`, a row number over the block window, brings the rows of a block together and in order
    before they stream through Python, and marks where a block (or a symbol) begins. Also returns the state that
    enters each block; `keep` writes that table to the checkpoint folder.
    """
    middle = (F.col("HighPrice") + F.col("LowPrice")) / 2
    bands = blocked.withColumns({
        "close": F.col("ClosePrice"), "last": F.col("_close_lag1"),
        "upper": middle + multiplier * F.col(atr), "lower": middle - multiplier * F.col(atr),
    })
    block_key = [T.StructField(KEY, blocked.schema[KEY].dataType), T.StructField("blk", T.LongType())]
    described = T.StructType(
        block_key + [T.StructField("rows", T.LongType()), T.StructField("close", T.DoubleType())]
        + [T.StructField(f"{side}_{c}", T.ArrayType(T.DoubleType())) for side in ("up", "down") for c in _EXIT_COLUMNS]
    )
    entering = [T.StructField("up_in", T.DoubleType()), T.StructField("down_in", T.DoubleType()), T.StructField("trend_in", T.LongType())]
    at = F.row_number().over(block_window())
    blocks = bands.select(KEY, "blk", "rn", "close", "last", "upper", "lower").withColumn("at", at).mapInArrow(_describe, described)
    if state is None:
        blocks = blocks.withColumns({f"{c}_0": F.lit(None).cast("double") for c in ("up", "down", "trend")})
    else:
        stored = state.where("Block > 0").select(KEY, *[F.col("Carried")[f"{name} {c}"].alias(f"{c}_0") for c in ("up", "down", "trend")])
        blocks = blocks.join(stored, KEY, "left")
    in_symbol = F.row_number().over(Window.partitionBy(KEY).orderBy("blk"))
    states = blocks.withColumn("at", in_symbol).mapInArrow(_enter, T.StructType(block_key + entering))
    if keep:
        states = cut_lineage(states)
    entered = bands.join(states, [KEY, "blk"]).withColumn("at", at)
    lines = entered.mapInArrow(_trace, T.StructType(entered.schema.fields + [T.StructField("line", T.DoubleType())]))
    return lines.select(*blocked.columns, F.col("line").alias(name)), states
