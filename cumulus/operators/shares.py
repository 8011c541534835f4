"""Group totals, shares of a group, and share tables pivoted by category."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def group_total(df: DataFrame, group_cols, value_col: str,
                out_col: str = "group_total") -> DataFrame:
    """Attach Σ value over each group to every row of the group.

    Totals are aggregated first (map-side partial sums, one row per group) and
    joined back, a NULL group with its own total; AQE broadcasts the totals
    when they are measured small and splits a hot group's partition otherwise.
    No window has to buffer a whole group in one task.
    """
    group_cols = list(group_cols)
    totals = df.groupBy(*[F.col(g).alias(f"__g_{g}") for g in group_cols]).agg(
        F.sum(value_col).alias(out_col))
    same = reduce(lambda a, b: a & b,
                  [df[g].eqNullSafe(totals[f"__g_{g}"]) for g in group_cols])
    return df.join(totals, same, "left").drop(*[f"__g_{g}" for g in group_cols])


def group_share(df: DataFrame, group_cols, value_col: str, scale: float = 100.0,
                out_col: str = "share", total_col: str = "group_total") -> DataFrame:
    """(value / Σ value of the group) * scale; NULL when the total is 0."""
    t = group_total(df, group_cols, value_col, total_col)
    return t.withColumn(out_col, F.try_divide(F.col(value_col).cast("double"),
                                              F.col(total_col)) * F.lit(scale))


def label_from_pattern(name: str, pattern: str) -> str:
    """Column label = first match of ``pattern`` in ``name``; 'NA' if none."""
    m = re.search(pattern, name)
    return m.group(0) if m else "NA"


def share_pivot(df: DataFrame, id_col: str, category_col: str, value_col: str,
                categories, scale: float = 100.0, label_pattern: str | None = None,
                id_alias: str | None = None) -> DataFrame:
    """One row per id with each category's share of the id's total.

    A single grouped aggregation over a declared category list (fixed schema,
    one pass, partial aggregation before the shuffle); the total is the row-wise
    sum of the category sums, so no window or second join is needed.
    Categories outside the list are ignored, as is a missing category (NULL).
    """
    cats = list(categories)
    wide = (df.filter(F.col(category_col).isin(cats))
              .groupBy(id_col).pivot(category_col, cats).agg(F.sum(value_col)))
    total = None
    for c in cats:
        term = F.coalesce(F.col(f"`{c}`"), F.lit(0))
        total = term if total is None else total + term
    out = [F.col(id_col).alias(id_alias or id_col)]
    for c in cats:
        label = label_from_pattern(c, label_pattern) if label_pattern else c
        out.append((F.try_divide(F.col(f"`{c}`").cast("double"), total)
                    * F.lit(scale)).alias(label))
    return wide.select(*out)
