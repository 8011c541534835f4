"""Trailing means over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def trailing_mean(df: DataFrame, keys, order_col: str, value_cols, k: int = 7,
                  suffix: str = "_avg") -> DataFrame:
    """Mean of this row and the k-1 older rows of the same key.

    The frame counts rows, not days (a missing day widens the span).  The mean
    is NULL unless all k rows exist and are non-NULL.  Computed as
    sum / k so the value is an exact integer sum divided once.
    """
    w = (Window.partitionBy(*keys).orderBy(F.col(order_col).asc())
         .rowsBetween(-(k - 1), Window.currentRow))
    return df.withColumns({
        v + suffix: F.when(F.count(v).over(w) == k,
                           F.sum(v).over(w).cast("double") / F.lit(float(k)))
        for v in value_cols})
