"""Typed file scans and sinks.  Every scan takes a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


# Text form of timestamps in every file cumulus writes or reads: full
# microsecond precision (Spark's default text form keeps milliseconds only).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


class EmptyInput(ValueError):
    """A feed that must carry rows carried none."""


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail fast when ``df`` is empty (one bounded action: stops at a row)."""
    if df.isEmpty():
        raise EmptyInput(f"no data to parse in {what}")
    return df


BAD_LINE = "_bad_line"


def _csv(spark: SparkSession, path: str, schema: T.StructType, null_value: str) -> DataFrame:
    """Every row of a header CSV; the text of one that does not fit the schema, else
    NULL, in ``BAD_LINE``.  A header other than the schema's names fails the read."""
    return (spark.read.schema(T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())]))
            .option("header", True).option("nullValue", null_value).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", BAD_LINE).option("enforceSchema", False)
            .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT)
            .csv(path))


def _whole_row(schema: T.StructType) -> Column:
    """Text made of all columns: a filter on it makes the scan parse whole rows, which
    checks them, whatever else is selected."""
    return F.concat_ws(",", *[F.col(f"`{f.name}`").cast("string") for f in schema.fields],
                       F.col(BAD_LINE))


def _parsed(schema: T.StructType) -> Column:
    return F.length(_whole_row(schema)) >= 0     # always true, which the optimizer cannot know


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType,
                   null_value: str = "NA") -> DataFrame:
    """Header CSV with declared types; empty fields and ``null_value`` → NULL.

    The header must name the schema's columns in their order, and every row must
    hold that many values of their types; anything else fails the read, also where
    only some columns or none (``count()``) are asked for.
    """
    fits = F.when(F.col(BAD_LINE).isNull(), F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit("malformed CSV row: "), _whole_row(schema))).cast("boolean"))
    return _csv(spark, path, schema, null_value).filter(fits).drop(BAD_LINE)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, rejects: str,
                     null_value: str = "NA") -> DataFrame:
    """The rows of a header CSV that fit the schema; the others are added to the Parquet
    table ``rejects`` (``read_rejects``) with their text and file, once each, so a scan
    that is repeated reports nothing twice."""
    rows = _csv(spark, path, schema, null_value)
    bad = (rows.withColumn("file", F.input_file_name())
           .filter(F.col(BAD_LINE).isNotNull() & _parsed(schema))
           .groupBy("file", F.col(BAD_LINE).alias("line")).agg(F.count(F.lit(1)).alias("n")))
    if path_exists(spark, rejects):
        bad = bad.join(read_rejects(spark, rejects), ["file", "line"], "left_anti")
    bad.write.mode("append").parquet(rejects)
    return rows.filter(F.col(BAD_LINE).isNull() & _parsed(schema)).drop(BAD_LINE)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, n): text of each rejected line and how often its file has it."""
    return spark.read.schema("file string, line string, n long").parquet(path)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a header CSV (reads its first line)."""
    return spark.read.option("header", True).csv(path).columns


def read_feed_to_date(spark: SparkSession, path: str, schema: T.StructType,
                      ts_col: str, null_value: str = "NA") -> DataFrame:
    """Typed CSV feed whose timestamp column is truncated to a date."""
    df = read_csv_typed(spark, path, schema, null_value)
    return df.withColumn(ts_col, F.to_date(ts_col))


def read_json_envelope(spark: SparkSession, path: str, record: T.StructType,
                       field: str, head_field: str = "meta",
                       multi_line: bool = False) -> DataFrame:
    """Rows = the records listed under ``field`` of each JSON document.

    A document is one line (JSON-lines, splittable) or one whole file
    (``multi_line=True``).  Fields absent from a record, or null there, come
    out NULL because the record schema is declared.  Malformed documents fail
    the read (FAILFAST) instead of turning into a corrupt-record column.
    """
    env = T.StructType([T.StructField(head_field, T.StringType(), True),
                        T.StructField(field, T.ArrayType(record), True)])
    docs = (spark.read.schema(env).option("multiLine", multi_line)
            .option("mode", "FAILFAST").option("timestampNTZFormat", TS_FORMAT)
            .option("timestampFormat", TS_FORMAT).json(path))
    return docs.select(F.inline(F.col(field)))


def read_json_envelope_at(spark: SparkSession, path: str, record: T.StructType, position: int,
                          multi_line: bool = False) -> DataFrame:
    """Rows = the records listed in the member at ``position`` (from 1) of each JSON
    document, whatever that member is called.

    The members are kept in their order as raw text and only the chosen one is parsed.
    A document without that member, or with null there, has no rows; any other value
    than an array of records fails the read.
    """
    docs = spark.read.text(path, wholetext=multi_line)
    strict = {"mode": "FAILFAST", "timestampNTZFormat": TS_FORMAT, "timestampFormat": TS_FORMAT}
    members = F.map_values(F.from_json("value", T.MapType(T.StringType(), T.StringType()), strict))
    member = docs.filter(F.trim("value") != "").select(F.trim(F.get(members, F.lit(position - 1))).alias("m"))
    listed = F.when(F.col("m").startswith("["), F.col("m")).otherwise(F.raise_error(
        F.concat(F.lit(f"member {position} is no array: "), F.substring("m", 1, 80))))
    return (member.filter("m IS NOT NULL")
            .select(F.inline(F.from_json(listed, T.ArrayType(record), strict))))


def extract_json(col, schema: T.StructType) -> Column:
    """JSON text column → struct with the declared fields (absent → NULL)."""
    return F.from_json(col if isinstance(col, Column) else F.col(col), schema)


def write_json_envelopes(df: DataFrame, path: str, field: str, batch_col: Column | None = None,
                         head_field: str = "meta", record_cols=None,
                         batch_rows: int = 1000, mode: str = "overwrite") -> None:
    """Write ``df`` as JSON-lines documents {meta, field: [records]}, one
    document per value of ``batch_col``, which must bound the batch size
    (e.g. ``floor(unique_id / 1000)``).  By default a document holds at most
    ``batch_rows`` consecutive rows of one partition, so no group grows with
    the data.  NULL fields are left out of a record, as sparse feeds do."""
    if batch_col is None:
        batch_col = F.floor(F.monotonically_increasing_id() / F.lit(batch_rows))
    cols = list(record_cols) if record_cols is not None else df.columns
    recs = F.struct(*[F.col(c) for c in cols])
    (df.groupBy(batch_col.alias("__batch"))
       .agg(F.collect_list(recs).alias(field))
       .select(F.col("__batch").cast("string").alias(head_field), F.col(field))
       .write.mode(mode).option("timestampNTZFormat", TS_FORMAT)
       .option("timestampFormat", TS_FORMAT).json(path))


def dated_path(path: str, run_date) -> str:
    """``path/run_date=YYYY-MM-DD``: one folder per run, older runs kept."""
    return f"{path.rstrip('/')}/run_date={run_date.isoformat()}"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class OutputIsInput(ValueError):
    """A sink would overwrite files that its own table reads."""


def _qualified(spark: SparkSession, path: str) -> str:
    from urllib.parse import unquote
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = fs.makeQualified(p).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{unquote(uri.getPath())}".rstrip("/")


def refuse_overlap(spark: SparkSession, output: str, inputs) -> None:
    """Raise when ``output`` is, holds, or lies in one of the input paths."""
    out = _qualified(spark, output)
    for path in {p if p.count("/") < 2 else p.rsplit("/", 1)[0] if p.endswith((".csv", ".parquet",
                                                                              ".json")) else p
                 for p in inputs if p}:
        other = _qualified(spark, path)
        if out == other or out.startswith(other + "/") or other.startswith(out + "/"):
            raise OutputIsInput(f"{output} is read by the table to be written there ({path})")


def write_csv(df: DataFrame, path: str, single_file: bool = False,
              null_value: str = "NA", run_date=None) -> str:
    """Header CSV, overwriting ``path`` (or ``path/run_date=…`` when a run date
    is given); returns the folder written.  Leading/trailing blanks are kept
    (padded display columns).  ``single_file`` is for bounded display tables
    only (the final, already-sorted stage runs as one task); large outputs keep
    one file per task.  A table that reads from the folder is refused before
    anything is deleted."""
    if run_date is not None:
        path = dated_path(path, run_date)
    if path_exists(df.sparkSession, path):  # only then is there something to lose
        refuse_overlap(df.sparkSession, path, df.inputFiles())
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite").option("header", True)
        .option("nullValue", null_value)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", TS_FORMAT)
        .option("timestampFormat", TS_FORMAT)
        .csv(path))
    return path


TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv_ordered(df: DataFrame, path: str, sort_by, null_value: str = "NA") -> str:
    """Header CSV in a global order, written by many tasks; returns the folder.

    The rows are sorted by range, each task writes one numbered part, and the header is
    the first line of the first part: the parts in the order of their names are one CSV
    file (``cat part-*``).  ``sort_by`` holds column names, or (name, "desc"); NULLs
    come last.  ``read_csv_ordered`` reads it back.  As with ``write_csv``, NULL and the
    text ``null_value`` look alike."""
    spark = df.sparkSession
    if path_exists(spark, path):
        refuse_overlap(spark, path, df.inputFiles())
    order = [(c, "asc") if isinstance(c, str) else c for c in sort_by]
    stamps = (T.TimestampType, T.TimestampNTZType)
    cells = [F.date_format(f"`{f.name}`", TS_TEXT) if isinstance(f.dataType, stamps)
             else F.col(f"`{f.name}`").cast("string") for f in df.schema.fields]
    # The sort keys keep their types; the header has none, and a group before all rows.
    rows = df.select(F.lit(1).alias("g"), *[c.alias(f"c{i}") for i, c in enumerate(cells)],
                     *[F.col(f"`{c}`").alias(f"k{i}") for i, (c, _) in enumerate(order)])
    header = spark.range(1).select(
        F.lit(0).alias("g"), *[F.lit(n).alias(f"c{i}") for i, n in enumerate(df.columns)],
        *[F.lit(None).cast(rows.schema[f"k{i}"].dataType).alias(f"k{i}") for i in range(len(order))])
    keys = [F.col(f"k{i}").desc_nulls_last() if way == "desc" else F.col(f"k{i}").asc_nulls_last()
            for i, (_, way) in enumerate(order)]
    (header.unionByName(rows).orderBy("g", *keys).select(*[f"c{i}" for i in range(len(cells))])
        .write.mode("overwrite").option("nullValue", null_value)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))
    return path


def read_csv_ordered(spark: SparkSession, path: str, schema: T.StructType,
                     null_value: str = "NA") -> DataFrame:
    """The rows of a folder written by ``write_csv_ordered``, typed; a value that does not
    fit its type fails the read."""
    names = schema.fieldNames()
    shape = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    rows = (spark.read.schema(shape).option("nullValue", null_value).option("mode", "FAILFAST")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path))
    is_header = F.lit(True)
    for i, n in enumerate(names):
        is_header &= F.col(f"c{i}").eqNullSafe(F.lit(n))
    return rows.filter(~is_header).select(*[
        F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
