"""Row order and windows on series of any length.

A plain window brings all rows of a key into one task.  Here the rows are sorted by
range over all tasks and numbered; every ``block`` consecutive rows make a block,
which also gets the last ``halo`` rows before it.  A window then runs within (block,
key), and the halo rows are left out of its result: the values are those of the plain
window, whatever share of the rows one key holds.

The sorted rows are written once to the shared folder; the driver sees one number,
the row count, for each part written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import scratch_path

BLOCK = 1_000_000
INDEX, IN_BLOCK = "__index", "__block"
_PLACES = (1 << 33) - 1      # a row's place within its part: the low bits of its id


def _quoted(columns) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def indexed(df: DataFrame, order_by, name: str = "series") -> DataFrame:
    """``df`` with the row's number (from 0) in the order of ``order_by``: column names or
    sort expressions.  Ties go by a hash of the row, then as they come; equal rows are
    spread over tasks like others."""
    spark = df.sparkSession
    order = [F.col(f"`{c}`").asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    tie = "__tie"
    ids = df.withColumn(tie, F.monotonically_increasing_id())
    rows = (ids.orderBy(*order, F.xxhash64(*_quoted(df.columns)), tie).drop(tie)
            .withColumn(INDEX, F.monotonically_increasing_id()))
    path = scratch_path(spark, name)
    rows.write.parquet(path)
    shape = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    rows = spark.read.schema(shape).parquet(path)
    part = F.shiftright(INDEX, 33)
    before, seen = [], 0
    for number, size in sorted(rows.groupBy(part).count().collect()):
        before.append((number, seen))
        seen += size
    starts = spark.createDataFrame(before, "__part long, __before long")
    # One row for each part written by the sort.
    return (rows.join(F.broadcast(starts), part == F.col("__part"))
            .withColumn(INDEX, F.col("__before") + F.col(INDEX).bitwiseAND(F.lit(_PLACES)))
            .drop("__part", "__before"))


def over_blocks(df: DataFrame, keys, order_by, halo: int,
                windowed: Callable[[DataFrame, Window], DataFrame], block: int = BLOCK) -> DataFrame:
    """``windowed(rows, window)`` where the window is partitioned by key, in order, and its
    frames reach at most ``halo`` rows back."""
    if halo >= block:
        raise ValueError(f"a block of {block} rows cannot hand on {halo} rows")
    keys = list(keys)
    here = F.expr(f"{INDEX} div {block}")
    tail = F.pmod(F.col(INDEX), F.lit(block)) >= block - halo
    rows = indexed(df, [*keys, *order_by]).withColumn(
        IN_BLOCK, F.explode(F.when(tail, F.array(here, here + 1)).otherwise(F.array(here))))
    window = Window.partitionBy(IN_BLOCK, *_quoted(keys)).orderBy(INDEX)
    return windowed(rows, window).filter(F.col(IN_BLOCK) == here).drop(IN_BLOCK, INDEX)


def row_delta_long(df: DataFrame, keys, order_col: str, value_cols, suffix: str = "_diff",
                   block: int = BLOCK) -> DataFrame:
    """``deltas.row_delta`` for series of any length."""
    return over_blocks(df, keys, [order_col], 1, lambda rows, w: rows.withColumns(
        {v + suffix: F.col(v) - F.lag(v).over(w) for v in value_cols}), block)


def trailing_mean_long(df: DataFrame, keys, order_col: str, value_cols, k: int = 7,
                       suffix: str = "_avg", block: int = BLOCK) -> DataFrame:
    """``rolling.trailing_mean`` for series of any length."""
    def mean(rows: DataFrame, w) -> DataFrame:
        w = w.rowsBetween(1 - k, Window.currentRow)
        return rows.withColumns({v + suffix: F.when(
            F.count(v).over(w) == k, F.sum(v).over(w).cast("double") / F.lit(float(k)))
            for v in value_cols})
    return over_blocks(df, keys, [order_col], k - 1, mean, block)


def numbered(df: DataFrame, group, order_by, into: str = "number", block: int = BLOCK) -> DataFrame:
    """``df`` with each row's number (from 1) in its group; a group may hold any share of
    the rows.  NULLs make a group like other values."""
    group = list(group)
    here = F.expr(f"{INDEX} div {block}")
    rows = indexed(df, [*group, *order_by]).withColumn(IN_BLOCK, here)
    # Only a group that goes on from the block before is not numbered from 1.
    counts = rows.groupBy(IN_BLOCK, *_quoted(group)).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*_quoted(group)).orderBy(IN_BLOCK).rowsBetween(
        Window.unboundedPreceding, -1)
    carried = (counts.withColumn("__before", F.sum("__n").over(earlier)).filter("__before > 0")
               .select(F.col(IN_BLOCK).alias("__b"), *[F.col(f"`{g}`").alias(f"__g_{g}") for g in group],
                       "__before"))
    same = F.col(IN_BLOCK) == F.col("__b")
    for g in group:
        same &= F.col(f"`{g}`").eqNullSafe(F.col(f"`__g_{g}`"))
    in_block = F.row_number().over(Window.partitionBy(IN_BLOCK, *_quoted(group)).orderBy(INDEX))
    return (rows.withColumn(into, in_block.cast("long")).join(carried, same, "left")
            .withColumn(into, F.col(into) + F.coalesce("__before", F.lit(0)))
            .select(*_quoted(df.columns), into))
