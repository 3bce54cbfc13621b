"""Row numbers and bounded blocks for long per-symbol series.

A window partitioned by Symbol alone puts the whole history of a symbol into one task,
and one symbol may hold a third of all bars. So every ordered operator here works on
blocks: rows of a symbol are numbered without sorting the symbol in one place, the number
gives the block, and rows near a block edge are copied into the neighbouring block as
context. Windows then run per (Symbol, block), and each task sees at most
`rows + before + after` rows of a block whatever the size of the symbol.
"""

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.schemas import KEY, TS

BLOCK_ROWS = 2048


def with_row_index(bars: DataFrame, key: str = KEY, ts: str = TS, slices: Column | None = None) -> DataFrame:
    """Add `rn`, the 0-based position of a row in its symbol, ordered by time.

    Months are counted first (partial aggregation, one row per symbol and month), their running
    total gives each month its offset, and rows are numbered only within their month. The widest
    sort is one symbol-month, at most 44,640 minute bars; the per-symbol window sees one row per
    calendar month. Key and time must be non-null and unique together, as the staging merge
    leaves them. `slices` replaces the month for orderings that are not dates; it must grow
    with `ts`.
    """
    sliced = bars.withColumn("_slice", F.trunc(F.to_date(ts), "month") if slices is None else slices)
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    in_slice = F.row_number().over(Window.partitionBy(key, "_slice").orderBy(ts))
    return (
        sliced.withColumn("_in_slice", in_slice)
        .join(offsets, [key, "_slice"])
        .withColumn("rn", F.col("_offset") + F.col("_in_slice") - 1)
        .drop("_slice", "_in_slice", "_offset")
    )


def block_rows_for(before: int, after: int = 0) -> int:
    """Block size: the context of a block must fit into its direct neighbours."""
    return max(BLOCK_ROWS, before, after)


def with_blocks(indexed: DataFrame, before: int = 0, after: int = 0, rows: int | None = None) -> DataFrame:
    """Add `blk` and `core`; copy edge rows so that each block carries its context.

    `before` rows precede a block and `after` rows follow it. Copies have core = false and are
    removed by `core_rows` once the windows are done.
    """
    rows = rows or block_rows_for(before, after)
    if max(before, after) > rows:
        raise ValueError(f"context of {max(before, after)} rows does not fit into blocks of {rows}")
    home = F.expr(f"rn div {rows}")
    pos = F.col("rn") % rows
    targets = [home]
    if before:
        targets.append(F.when(pos >= rows - before, home + 1))
    if after:
        targets.append(F.when((pos < after) & (home > 0), home - 1))
    blocks = F.explode(F.array_compact(F.array(*targets))) if len(targets) > 1 else home
    return indexed.withColumn("blk", blocks).withColumn("core", F.expr(f"rn div {rows}") == F.col("blk"))


def block_window(key: str = KEY) -> WindowSpec:
    return Window.partitionBy(key, "blk").orderBy("rn")


def core_rows(blocked: DataFrame) -> DataFrame:
    return blocked.where("core")
