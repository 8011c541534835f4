"""The snapshot history, stored as Parquet partitioned by date.

A daily snapshot is appended whole, once per date (``store_snapshot``); rows
that land in several files are appended as they come, each once
(``append_rows``).  Either looks only at the snapshot's own dates in the
history, so an append costs the same however long the history is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.joins import rows_at_most
from ..operators.snapshots import newer_than
from ..operators.totals import check_same_types, union_by_name
from .files import EmptyInput, path_exists


# A history holds one row per day in its date list; beyond this many days the
# anti-join falls back to a shuffle join.
MAX_BROADCAST_DAYS = 1_000_000


def _without_known_dates(snapshot: DataFrame, history: DataFrame, date_col: str) -> DataFrame:
    """Snapshot rows whose date the history lacks.

    The anti-join side is the history's distinct dates (one row per day,
    partial aggregation first).  It is broadcast after a bounded size check,
    so the snapshot — all of one date, the hottest key there is — is never
    shuffled onto a single date partition.
    """
    dates = history.select(date_col).distinct()
    if rows_at_most(dates, MAX_BROADCAST_DAYS):
        dates = F.broadcast(dates)
    return snapshot.join(dates, on=date_col, how="left_anti")


def append_by_date(history: DataFrame, snapshot: DataFrame,
                   date_col: str = "Date") -> DataFrame:
    """history ∪ (snapshot rows whose date the history lacks)."""
    check_same_types(history, snapshot)
    return union_by_name(history, _without_known_dates(snapshot, history, date_col))


def append_if_newer(history: DataFrame, feed: DataFrame, date_col: str = "Date",
                    feed_date_col: str | None = None) -> DataFrame:
    """history ∪ (feed rows strictly newer than the history's latest date)."""
    fresh = newer_than(feed, history, feed_date_col or date_col, date_col)
    return union_by_name(history, fresh)


def read_history(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet") -> DataFrame:
    """Read the history with its declared schema: the date-partitioned Parquet
    table (default), or a history kept as one header CSV (``fmt="csv"``)."""
    if fmt == "csv":
        from .files import read_csv_typed
        return read_csv_typed(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


class BadSnapshot(ValueError):
    """A snapshot with a NULL date, or with several dates where one is due."""


def _as_schema(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order; a column the rows lack is NULL."""
    declared = rows.sparkSession.createDataFrame([], schema)
    check_same_types(declared, rows)
    return rows.select(*[F.col(f"`{f.name}`") if f.name in rows.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def _dates_of(rows: DataFrame, date_col: str, what: str):
    """(first, last) date; raises on no rows and on a NULL date.  One aggregate."""
    r = rows.agg(F.count(F.lit(1)).alias("n"), F.count(date_col).alias("dated"),
                 F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    if not r["n"]:
        raise EmptyInput(f"no data to parse in {what}")
    if r["dated"] < r["n"]:
        raise BadSnapshot(f"{r['n'] - r['dated']} rows without a date in {what}")
    return r["lo"], r["hi"]


def _between(history: DataFrame, date_col: str, lo, hi) -> DataFrame:
    """The history's rows of these dates: other date folders are not opened."""
    return history.filter(F.col(date_col).between(F.lit(lo), F.lit(hi)))


def _write(rows: DataFrame, path: str, date_col: str, max_records_per_file: int,
           spread: bool, overwrite: bool) -> None:
    """Into the date folders.  ``spread``: many dates, so rows are first brought
    together by date (AQE splits a large date and merges small ones); the rows
    of a single date are written where they are."""
    if spread:
        rows = rows.hint("rebalance", date_col)
    # Dynamic overwrite is set on the write itself: under the session default
    # (static) an overwrite would drop every other date folder.
    (rows.write.mode("overwrite" if overwrite else "append")
         .option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max_records_per_file)
         .partitionBy(date_col).parquet(path))


def store_snapshot(spark: SparkSession, snapshot: DataFrame, path: str,
                   schema: T.StructType, date_col: str = "Date",
                   max_records_per_file: int = 5_000_000, backfill: bool = False,
                   keys=()) -> int:
    """Append ``snapshot`` to the history at ``path``; returns rows written.

    A date that is complete in the history is not appended again, so a rerun is a no-op;
    one of which only a part has landed is completed, and rows that cannot be stored are
    put in quarantine (see ``landing``).  Columns the snapshot lacks become NULL.  Raises,
    the history unchanged, on an empty snapshot, a type clash, a NULL date, and on several
    dates unless ``backfill`` says that many are meant.
    """
    from .landing import land_snapshot
    return land_snapshot(spark, snapshot, path, schema, date_col, keys, max_records_per_file,
                         backfill).written


def append_rows(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType,
                keys, date_col: str = "Date", max_records_per_file: int = 5_000_000) -> int:
    """Append the rows that the history lacks; returns rows written.

    For snapshots that land in several files, at several times: a later file of
    a known date adds its rows, and the same rows again add none.  A row of a known
    date and key with other values is put in quarantine.  Raises on a NULL date or a
    type clash.
    """
    from .landing import land_rows
    return land_rows(spark, rows, path, schema, keys, date_col, max_records_per_file).written
