"""One large JSON document read by many tasks.

A document ``{…, "field": [record, record, …], …}`` has no line ends to split at.  It is
split at every ``}`` instead (Spark's text source cuts a file into byte ranges at any
separator), and a small automaton tells which of them end a record: it knows whether a
place lies in a string and how many brackets are open.  What a piece does to that state is
worked out for both cases, begun inside and outside a string; pieces, then whole byte
ranges, are composed, so each range learns its state at the start from one row per range.
Everything is built-in functions; the text is shuffled once, by byte range.

Passes: quotes and brackets per range; record ends and the field's bounds per range; then
the records.  A record that lies in one range is put together where it is, only the pieces
at the ranges' borders are brought together by record number.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from .files import TS_FORMAT

KEY = "\x01"                # stands for the field's name where it is a key
RANGE = ("file", "block")   # a byte range: its file and first byte


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _net(text: Column) -> Column:
    """Brackets opened less those closed (a piece holds no closing brace)."""
    return _count(text, "{[") - _count(text, "]")


def _pieces_until(last: int):
    """The pieces of a range up to this one (0) or the one before (-1)."""
    return Window.partitionBy(*RANGE).orderBy("id").rowsBetween(Window.unboundedPreceding, last)


def _earlier_ranges():
    return Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(c, window=None) -> Column:
    """Sum over the pieces of the range before this one, or over the ``window``."""
    return F.coalesce(F.sum(c).over(_pieces_until(-1) if window is None else window), F.lit(0))


def _pieces(spark: SparkSession, path: str, field: str) -> DataFrame:
    """file, block, id (in order within a range), text, quotes, and what the piece is outside
    strings if it begins outside (o0) or inside one (o1): its brackets, commas and colons, the
    field's keys, and a ``v`` for every other key or value."""
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"))
    key = f'"{re.escape(field)}"(\\s*:)'
    plain = F.regexp_replace(F.regexp_replace("text", key, KEY + "$1"), r"(?s)\\.", "")

    def outside(text: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(text, '"[^"]*("|$)', "v"), r"\s+", "")
        return F.regexp_replace(bare, f"[^\\[\\]{{,:{KEY}]+", "v")
    return (raw.withColumn("plain", plain)
            .withColumn("quotes", _count(F.col("plain"), '"'))
            .withColumn("o0", outside(F.col("plain")))
            .withColumn("o1", outside(F.regexp_replace("plain", '^[^"]*("|$)', ""))).drop("plain"))


def _step(outside: str, begins: Column) -> Column:
    """Change of depth over a piece that begins in a string (1) or not (0), with the
    brace that ends it if that lies outside strings."""
    ends_outside = F.pmod(begins + F.col("quotes"), F.lit(2)) == 0
    return _net(F.col(outside)) - F.when(ends_outside, 1).otherwise(0)


def _range_starts(pieces: DataFrame) -> DataFrame:
    """file, block, s0 (in a string: 1), d0 (depth): the state at each range's start."""
    odd = F.pmod(_sum_before("quotes"), F.lit(2))
    steps = (pieces.withColumn("odd", odd)
             .withColumn("a", _step("o0", F.lit(0))).withColumn("b", _step("o1", F.lit(1))))
    ranges = steps.groupBy(*RANGE).agg(
        F.pmod(F.sum("quotes"), F.lit(2)).alias("odd"),
        F.sum(F.when(F.col("odd") == 0, F.col("a")).otherwise(F.col("b"))).alias("d_out"),
        F.sum(F.when(F.col("odd") == 0, F.col("b")).otherwise(F.col("a"))).alias("d_in"))
    file = Window.partitionBy("file")
    ranges = (ranges.withColumn("s0", F.pmod(_sum_before("odd", _earlier_ranges()), F.lit(2)))
              .withColumn("d", F.when(F.col("s0") == 0, F.col("d_out")).otherwise(F.col("d_in"))))
    # Text behind the last brace counts as one piece more, so a whole document ends at 0 or -1.
    whole = F.sum("d").over(file).isin(0, -1) & (F.pmod(F.sum("odd").over(file), F.lit(2)) == 0)
    return ranges.select(*RANGE, "s0", F.when(whole, _sum_before("d", _earlier_ranges())).otherwise(F.raise_error(
        F.concat(F.lit("malformed document, brackets or strings are left open: "), "file"))).alias("d0"))


def _stated(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Adds ``o`` (what lies outside strings), ``depth`` at the start, ``closes`` (the
    piece's brace leaves depth 2, where an array's elements lie), and ``event``: 1 where
    the field's array is entered, 0 where it is left."""
    # One row for each byte range of a file.
    df = pieces.join(F.broadcast(starts), list(RANGE))
    s = F.pmod(F.col("s0") + _sum_before("quotes"), F.lit(2))
    df = (df.withColumn("s", s)
          .withColumn("o", F.when(F.col("s") == 0, F.col("o0")).otherwise(F.col("o1")))
          .withColumn("step", _step("o", F.col("s"))).drop("o0", "o1"))
    df = df.withColumn("depth", F.col("d0") + _sum_before("step"))
    closes = (F.pmod(F.col("s") + F.col("quotes"), F.lit(2)) == 0) & (F.col("depth") + F.col("step") == 2)
    parts = F.split("o", f"{KEY}:\\[")
    # The key of the wanted array lies at depth 1; each part before it took a "[" along.  An
    # empty array is not entered.
    enters = F.exists(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda i: (
        (i < F.size(parts)) & ~F.get(parts, i).startswith("]")
        & (F.col("depth") + _net(F.array_join(F.slice(parts, 1, i), "")) + (i - 1) == 1)))
    leaves = (F.col("depth") == 2) & F.col("o").startswith("]")
    return df.withColumn("closes", closes).withColumn("event", F.when(
        F.col("o").contains(KEY) & enters, 1).when(leaves, 0))


def read_json_document(spark: SparkSession, path: str, record: T.StructType, field: str) -> DataFrame:
    """Rows = the records listed under ``field`` of each document in ``path``.

    As ``read_json_envelope``, but a document may be of any size and shape of white space:
    byte ranges of it are read in parallel (``spark.sql.files.maxPartitionBytes``).
    Documents may follow each other.  An element that is no object, a malformed
    record, and a document that is cut off fail the read."""
    pieces = _pieces(spark, path, field)
    starts = _range_starts(pieces)
    seen = _stated(pieces, starts)

    def inside(at_start: Column) -> Column:
        return F.coalesce(F.last("event", ignorenulls=True).over(_pieces_until(0)), at_start) == 1
    per_range = (seen.withColumn("in", inside(F.lit(1))).withColumn("out", inside(F.lit(0)))
                 .groupBy(*RANGE).agg(
                     F.max_by(F.col("event"), F.when(F.col("event").isNotNull(), F.col("id"))).alias("last"),
                     F.count(F.when(F.col("closes") & F.col("in"), 1)).alias("n_in"),
                     F.count(F.when(F.col("closes") & F.col("out"), 1)).alias("n_out")))
    ranges = (per_range.withColumn("in0", F.coalesce(
                  F.last("last", ignorenulls=True).over(_earlier_ranges()), F.lit(0)))
              .withColumn("n", F.when(F.col("in0") == 1, F.col("n_in")).otherwise(F.col("n_out")))
              .withColumn("first", _sum_before("n", _earlier_ranges()))
              .join(starts, list(RANGE)).select(*RANGE, "s0", "d0", "in0", "n", "first"))
    text = _stated(pieces, ranges).withColumn("inside", inside(F.col("in0")))
    ends = (F.col("closes") & F.col("inside")).cast("int")
    text = text.withColumn("k", _sum_before(ends)).filter("inside")
    # What comes before a record's first brace: the field's key, or a comma.
    opening = F.when(F.col("event") == 1, F.regexp_replace(
        "text", f'(?s)^.*?"{re.escape(field)}"\\s*:\\s*\\[', "")).when(
        (F.col("depth") == 2) & (F.col("s") == 0), F.when(
            F.col("o").startswith(",{"), F.regexp_replace("text", r"^\s*,", "")).otherwise(
            F.raise_error(F.concat(F.lit(f"an element of {field} is no object: "),
                                   F.substring("text", 1, 80))))).otherwise(F.col("text"))
    text = text.withColumn("part", F.struct("block", "id", opening.alias("t")))

    def records(df: DataFrame, *by: str) -> Column:
        parts = F.sort_array(F.collect_list("part"))
        return (df.groupBy(*by).agg(parts.alias("p"))
                .select(F.concat(F.array_join(F.transform("p", lambda x: x["t"]), "}"), F.lit("}"))
                        .alias("json")))
    border = (F.col("k") == 0) | (F.col("k") == F.col("n"))
    whole = records(text.filter(~border), *RANGE, "k")
    cut = records(text.filter(border).withColumn("k", F.col("first") + F.col("k")), "file", "k")
    found = whole.unionByName(cut)
    options = {"mode": "FAILFAST", "timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT}
    return found.select(F.from_json("json", record, options).alias("r")).select("r.*")
