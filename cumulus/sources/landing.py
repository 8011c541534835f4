"""Landing rows in the history so that every one is stored, known or reported.

Beside the date folders a history keeps two hidden tables, which its readers skip:

* ``_landed``: one mark per date whose snapshot is complete, with the snapshot's row
  count and digest, written after the rows.  A date without a mark, left by a lost
  driver or begun by a stream, is completed by the next landing of its snapshot: what
  is missing is added, as often as the snapshot has it.  A marked date is left alone.
* ``_quarantine``: rows that could not be stored, with the reason.  ``clash``: the
  history holds other rows of this date and key.  ``closed``: the date is complete and
  lacks this key.

Rows are compared whole, by a digest of all columns.  A NULL in a key names nothing, so
such rows never clash.  Landing the same rows again stores and reports nothing twice.
One writer at a time is assumed, as the marks are no lock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.joins import fits_broadcast
from ..session import scratch_path
from .files import TS_FORMAT, path_exists
from .history import (BadSnapshot, _as_schema, _between, _dates_of, _write, read_history)

MARKS, QUARANTINE = "_landed", "_quarantine"
DIGEST, REASON = "__digest", "reason"


@dataclass(frozen=True)
class Landed:
    """Rows written to the history, and rows newly put in quarantine."""
    written: int
    quarantined: int = 0


def row_digest(columns) -> Column:
    """sha256 over all columns, NULL and empty text told apart."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]),
                     {"ignoreNullFields": "false", "timestampFormat": TS_FORMAT,
                      "timestampNTZFormat": TS_FORMAT})
    return F.unhex(F.sha2(text, 256))


def _digested(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.withColumn(DIGEST, row_digest(schema.fieldNames()))


def _sums(rows: DataFrame, date_col: str) -> DataFrame:
    """(date, rows, digest): one row per date; the digest is that of the rows in any order."""
    return rows.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(DIGEST).cast("decimal(38,0)")).cast("string").alias("digest"))


def _marks_schema(schema: T.StructType, date_col: str) -> T.StructType:
    return T.StructType([T.StructField("rows", T.LongType()), T.StructField("digest", T.StringType()),
                         T.StructField(date_col, schema[date_col].dataType)])


def read_marks(spark: SparkSession, path: str, schema: T.StructType, date_col: str = "Date",
               lo=None, hi=None) -> DataFrame:
    """(rows, digest, date) of the complete dates, of all or of those from lo to hi."""
    marks, shape = f"{path}/{MARKS}", _marks_schema(schema, date_col)
    if lo is not None and lo == hi:      # one date: its folder alone is opened
        one = f"{marks}/{date_col}={lo}"
        if not path_exists(spark, one):
            return spark.createDataFrame([], shape)
        return spark.read.schema(shape).option("basePath", marks).parquet(one)
    if not path_exists(spark, marks):
        return spark.createDataFrame([], shape)
    found = spark.read.schema(shape).parquet(marks)
    return found if lo is None else _between(found, date_col, lo, hi)


def read_quarantine(spark: SparkSession, path: str, schema: T.StructType,
                    date_col: str = "Date") -> DataFrame:
    """The rows in quarantine, all columns of the history and ``reason``."""
    shape = T.StructType([f for f in schema.fields if f.name != date_col] + [
        T.StructField(REASON, T.StringType()), T.StructField(DIGEST, T.BinaryType()),
        schema[date_col]])
    place = f"{path}/{QUARANTINE}"
    found = (spark.read.schema(shape).parquet(place) if path_exists(spark, place)
             else spark.createDataFrame([], shape))
    return found.select(*schema.fieldNames(), REASON, DIGEST)


def _untouched(spark: SparkSession, path: str, date_col: str, lo, hi) -> bool:
    """True where the history cannot hold rows of these dates, told by its folders alone."""
    if not path_exists(spark, path):
        return True
    one_day = lo == hi and type(lo) is dt.date
    return one_day and not path_exists(spark, f"{path}/{date_col}={lo}")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def missing_rows(rows: DataFrame, old: DataFrame, date_col: str, once: bool) -> DataFrame:
    """Rows that ``old`` lacks.  ``once``: a row equal to a stored one is known, and equal
    rows are one; otherwise a row is missing as often as it occurs more often than in
    ``old``; its ``__equal`` tells whether that has it at all.  Equal rows are counted
    before they are shuffled."""
    want = rows.groupBy(date_col, DIGEST).agg(
        F.count(F.lit(1)).alias("__n"),
        F.first(F.struct(*[f"`{c}`" for c in rows.columns if c not in (date_col, DIGEST)]))
        .alias("__row"))
    have = old.groupBy(date_col, DIGEST).agg(F.count(F.lit(1)).alias("__have"))
    both = want.join(have, [date_col, DIGEST], "left")
    if once:
        lacks = both.filter("__have IS NULL")
    else:
        lacks = (both.withColumn("__more", F.col("__n") - F.coalesce("__have", F.lit(0)))
                 .filter("__more > 0").withColumn("__i", F.explode(F.expr("sequence(1, __more)"))))
    return lacks.select(date_col, DIGEST, "__row.*", F.col("__have").isNotNull().alias("__equal")) \
        .select(*rows.columns, "__equal")


def _stored(rows: DataFrame) -> DataFrame:
    """``rows`` written once to the shared folder: what follows reads them several times and
    does not carry their plan along."""
    path = scratch_path(rows.sparkSession, "landing")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _split(rows: DataFrame, old: DataFrame, date_col: str, keys):
    """(rows to store, clashing rows) of the missing ones: rows clash whose date and key
    ``old`` has, but no row like them."""
    rows = _stored(rows)
    if not keys or rows.isEmpty():
        return rows, None
    known = _small(old.select(date_col, *keys).distinct())
    on, equal = [date_col, *keys], F.col("__equal")
    return (rows.filter(equal).unionByName(rows.filter(~equal).join(known, on, "left_anti")),
            rows.filter(~equal).join(known, on, "left_semi"))


def _quarantine(spark: SparkSession, path: str, schema: T.StructType, date_col: str, parts) -> int:
    """Adds (rows, reason) parts that the quarantine lacks; returns how many rows."""
    listed = None
    for rows, reason in parts:
        if rows is not None and not rows.isEmpty():
            rows = rows.select(*schema.fieldNames(), F.lit(reason).alias(REASON), DIGEST)
            listed = rows if listed is None else listed.unionByName(rows)
    if listed is None:
        return 0
    if path_exists(spark, f"{path}/{QUARANTINE}"):
        known = read_quarantine(spark, path, schema, date_col).select(date_col, DIGEST).distinct()
        listed = listed.join(known, [date_col, DIGEST], "left_anti")
    listed = listed.persist()
    try:
        n = listed.count()
        if n:
            listed.write.mode("append").partitionBy(date_col).parquet(f"{path}/{QUARANTINE}")
        return n
    finally:
        listed.unpersist()


def land_snapshot(spark: SparkSession, snapshot: DataFrame, path: str, schema: T.StructType,
                  date_col: str = "Date", keys=(), max_records_per_file: int = 5_000_000,
                  backfill: bool = False) -> Landed:
    """Land whole snapshots, one date or (``backfill``) several.

    A date without rows is written; one with rows but no mark is completed; a marked date
    stays as it is, and rows by which the snapshot differs from it go to quarantine.  With
    ``keys``, so do rows that would complete a date but clash with its rows.
    """
    rows = _digested(_as_schema(snapshot, schema), schema).persist()
    fresh = None
    try:
        lo, hi = _dates_of(rows, date_col, "snapshot")
        if lo != hi and not backfill:
            raise BadSnapshot(f"snapshot holds more than one date: {lo} to {hi}")
        sums, todo, old, bad = _sums(rows, date_col), rows, None, []
        if not _untouched(spark, path, date_col, lo, hi):
            marks = read_marks(spark, path, schema, date_col, lo, hi)
            hist = _between(read_history(spark, path, schema), date_col, lo, hi)
            if not marks.isEmpty():
                todo = rows.join(_small(marks.select(date_col)), date_col, "left_anti")
                same = marks.select(date_col, "rows", "digest")
                other = (sums.join(same, [date_col, "rows", "digest"], "left_anti")
                         .join(marks.select(date_col), date_col, "left_semi").select(date_col))
                if not other.isEmpty():
                    late = rows.join(other, date_col, "left_semi").select(*rows.columns)
                    stored = _digested(hist.join(other, date_col, "left_semi")
                                       .select(*schema.fieldNames()), schema)
                    new, clash = _split(missing_rows(late, stored, date_col, once=False), stored,
                                        date_col, keys)
                    bad += [(new, "closed"), (clash, "clash")]
                if todo.isEmpty():
                    return Landed(0, _quarantine(spark, path, schema, date_col, bad))
                hist = hist.join(_small(marks.select(date_col)), date_col, "left_anti")
            if not hist.isEmpty():
                old = _digested(hist.select(*schema.fieldNames()), schema)
        fresh = todo
        if old is not None:
            fresh, clash = _split(missing_rows(todo, old, date_col, once=False), old, date_col, keys)
            bad.append((clash, "clash"))
        fresh = fresh.select(*schema.fieldNames()).persist()
        n, held = fresh.count(), _quarantine(spark, path, schema, date_col, bad)
        if n:
            # A date that has rows already keeps them: only an untouched one is overwritten.
            _write(fresh, path, date_col, max_records_per_file, lo != hi, overwrite=old is None)
        done = sums if todo is rows else sums.join(todo.select(date_col).distinct(), date_col,
                                                   "left_semi")
        (done.select("rows", "digest", date_col).coalesce(1).write.mode("append")
         .partitionBy(date_col).parquet(f"{path}/{MARKS}"))
        return Landed(n, held)
    finally:
        if fresh is not None:
            fresh.unpersist()
        rows.unpersist()


def land_rows(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType, keys,
              date_col: str = "Date", max_records_per_file: int = 5_000_000) -> Landed:
    """Land rows of snapshots that come in several files, at several times.

    A row that the history has is known.  Rows of a date and key that it lacks are stored,
    all of them where the key has several; rows of a key that it has with other values go
    to quarantine.  Marks are neither read nor written: a late row still finds its date.
    """
    rows = _digested(_as_schema(rows, schema), schema).persist()
    fresh = None
    try:
        lo, hi = _dates_of(rows, date_col, "rows to append")
        new, clash = rows.dropDuplicates([date_col, DIGEST]), None
        if not _untouched(spark, path, date_col, lo, hi):
            old = _digested(_between(read_history(spark, path, schema), date_col, lo, hi)
                            .select(*schema.fieldNames()), schema)
            new, clash = _split(missing_rows(rows, old, date_col, once=True), old, date_col, keys)
        fresh = new.select(*schema.fieldNames()).persist()
        n = fresh.count()
        held = _quarantine(spark, path, schema, date_col, [(clash, "clash")])
        if n:
            _write(fresh, path, date_col, max_records_per_file, lo != hi, overwrite=False)
        return Landed(n, held)
    finally:
        if fresh is not None:
            fresh.unpersist()
        rows.unpersist()
