"""Keyed differences between snapshots and between consecutive rows.

All deltas are keyed: rows are paired by key and date, never by position, so
a ragged panel (a key missing on one date) yields a NULL delta instead of a
mis-paired one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from .series import numbered
from .snapshots import latest_or, two_snapshots


def _key_match(left: DataFrame, right: DataFrame, keys) -> "F.Column":
    # NULL keys pair with each other (NULL <=> NULL), like the tracked program.
    return reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(right[f"__r_{k}"]) for k in keys])


def snapshot_delta(df: DataFrame, keys, value_cols, date_col: str = "Date",
                   days: int = 7, suffix: str = "_delta",
                   keep_cols=None, where=None, latest=None) -> DataFrame:
    """Rows of the latest snapshot with ``value - value(days earlier)``.

    Two pruned scans (latest and latest - days) joined on the keys.  A key
    missing on the older date gets a NULL delta; if the older snapshot is
    absent altogether every delta is NULL.  The dates are chosen on the whole
    input (or given as ``latest``); ``where`` (a row predicate) is applied
    after that choice.
    """
    keys = list(keys)
    mx = latest_or(df, date_col, latest)
    newer = df.filter(F.col(date_col) == mx)
    older = df.filter(F.col(date_col) == F.date_sub(mx, days))
    if where is not None:
        newer, older = newer.filter(where), older.filter(where)
    if keep_cols is not None:
        newer = newer.select(*dict.fromkeys([*keys, date_col, *keep_cols, *value_cols]))
    older = (older.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                       *[F.col(v).alias(f"__prev_{v}") for v in value_cols]))
    j = newer.join(older, _key_match(newer, older, keys), "left")
    return j.select(*newer.columns,
                    *[(F.col(v) - F.col(f"__prev_{v}")).alias(v + suffix)
                      for v in value_cols])


def snapshot_pairs(df: DataFrame, keys, carry, value_cols, date_col: str = "Date",
                   days: int = 7, suffix: str = "_delta", latest=None,
                   block: int | None = None) -> DataFrame:
    """``snapshot_delta`` in one scan: keys, ``carry`` columns, values and deltas.

    Both snapshots are read together and shuffled once by key (NULL keys pair with each
    other).  Every row of the latest snapshot comes out: where a key has several rows of
    a date, they are numbered in the order of the carried columns and the values, and
    rows of equal key and number are paired.  Keys of which one may hold a large share of
    a snapshot are numbered in blocks of ``block`` rows (see ``series``), so that no task
    holds all its rows.
    """
    keys = list(keys)
    mx = latest_or(df, date_col, latest)
    cols = [c for c in dict.fromkeys([*carry, *value_cols]) if c not in keys]
    two = two_snapshots(df.select(*keys, date_col, *cols), date_col, days, latest)
    if block is None:
        # Both windows work on the one partitioning by key.
        of_date = Window.partitionBy(*keys, date_col).orderBy(*[c for c in cols if c != date_col])
        two = two.repartition(*keys).withColumn("__number", F.row_number().over(of_date))
    else:
        two = numbered(two, [*keys, date_col], [c for c in cols if c != date_col], "__number", block)
    pair = Window.partitionBy(*keys, "__number").orderBy(date_col)
    return (two.withColumns({v + suffix: F.col(v) - F.lag(v).over(pair) for v in value_cols})
            .filter(F.col(date_col) == mx)
            .select(*keys, *cols, *[v + suffix for v in value_cols]))


def period_delta(df: DataFrame, keys, value_cols, date_col: str = "Date",
                 days: int = 7, suffix: str = "_delta") -> DataFrame:
    """For every (key, date): ``value - value at date - days`` (NULL if absent).

    One per-key window whose frame is the single day ``days`` back (a RANGE
    frame on the day number), so the input is read and shuffled once.  Meant
    for panels (one row per key and date): a key's window partition holds at
    most one row per day, however many raw rows the key owned before the
    panel was aggregated.
    """
    day = F.unix_date(F.col(date_col))
    w = (Window.partitionBy(*keys).orderBy(day)
         .rangeBetween(-days, -days))
    return df.withColumns({v + suffix: F.col(v) - F.first(v).over(w) for v in value_cols})


def row_delta(df: DataFrame, keys, order_col: str, value_cols,
              suffix: str = "_diff") -> DataFrame:
    """``value - value of the previous row`` within each key, in date order.

    Meant for panels (one row per key and date), where a key holds at most one
    row per date, so a window partition is bounded by the number of dates.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc())
    return df.withColumns({v + suffix: F.col(v) - F.lag(v).over(w)
                           for v in value_cols})


def pct_change(df: DataFrame, keys, value_cols, date_col: str = "Date",
               days: int = 7, suffix: str = "_pct_chg", latest=None) -> DataFrame:
    """(value - old) / old over ``days`` on the latest snapshot; NULL on 0 old."""
    d = snapshot_delta(df, keys, value_cols, date_col, days, suffix="__d", latest=latest)
    return d.select(*df.columns,
                    *[F.try_divide(F.col(v + "__d").cast("double"),
                                   F.col(v) - F.col(v + "__d")).alias(v + suffix)
                      for v in value_cols])
