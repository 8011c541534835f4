"""Deterministic sorts: every sort names a unique tie-breaker, NULLs last."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sort_by(df: DataFrame, *keys) -> DataFrame:
    """``keys`` are names (ascending) or ``("name", "desc")`` pairs; NULLs go
    last either way.  Spark's sort is a range-partitioned distributed sort."""
    exprs = []
    for k in keys:
        name, order = (k, "asc") if isinstance(k, str) else k
        c = F.col(f"`{name}`")
        exprs.append(c.desc_nulls_last() if order == "desc" else c.asc_nulls_last())
    return df.orderBy(*exprs)
