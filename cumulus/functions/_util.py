from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c) -> Column:
    """Column name or Column → Column; other Python values → literal."""
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)
