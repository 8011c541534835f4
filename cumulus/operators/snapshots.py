"""Selecting snapshots out of a date-stacked history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def latest_date(df: DataFrame, date_col: str = "Date") -> Column:
    """max(date) of ``df`` as a scalar subquery (NULLs ignored); never collected."""
    return df.select(F.max(date_col)).scalar()


def resolve_latest(df: DataFrame, date_col: str = "Date"):
    """max(date) as a Python value: one aggregate job returning one value.

    Used once per report so that every later snapshot filter is a literal
    partition filter (static pruning) instead of a nested subquery.
    """
    return df.agg(F.max(date_col)).first()[0]


def latest_or(df: DataFrame, date_col: str, latest) -> Column:
    """``latest`` as a Column (literal date or given Column); the lazy scalar
    subquery over ``df`` when None."""
    if latest is None:
        return latest_date(df, date_col)
    return latest if isinstance(latest, Column) else F.lit(latest)


def two_snapshots(df: DataFrame, date_col: str = "Date", days: int = 7,
                  latest=None) -> DataFrame:
    """Rows dated max(date) or max(date) - days.

    The date column is compared with two values, so with a given latest date
    the filter is pushed to the scan, and on a history partitioned by date
    only the two snapshot folders are read; without one they come from a scalar
    subquery.
    """
    mx = latest_or(df, date_col, latest)
    return df.filter(F.col(date_col).isin(mx, F.date_sub(mx, days)))


def newer_than(df: DataFrame, ref: DataFrame, date_col: str = "Date",
               ref_col: str | None = None) -> DataFrame:
    """Rows of ``df`` strictly newer than the latest date of ``ref``.

    An empty ``ref`` (NULL max) keeps every dated row.
    """
    mx = latest_date(ref, ref_col or date_col)
    return df.filter(F.col(date_col).isNotNull()
                     & (mx.isNull() | (F.col(date_col) > mx)))


def distinct_dates(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """Distinct dates of ``df`` (partial aggregation before the shuffle)."""
    return df.select(date_col).distinct()


def single_date(df: DataFrame, date_col: str = "Date") -> DataFrame:
    """The one date a snapshot carries.  Evaluating it raises if the snapshot
    holds several dates (``raise_error`` inside the plan, no collect)."""
    agg = df.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    return agg.select(
        F.when(F.col("lo") == F.col("hi"), F.col("lo"))
         .when(F.col("lo").isNull(), F.lit(None).cast("date"))
         .otherwise(F.raise_error(F.lit("snapshot holds more than one date")).cast("date"))
         .alias(date_col))
