"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path

# The white space that separates words everywhere here: space and U+0009..U+000D.
BLANKS = " \t\n\x0b\f\r"
SPLIT = r"[\x20\x09-\x0D]+"


# Rows of an Arrow batch: texts of 3 kB on average make some megabytes, so a
# Python worker's memory is that of a few texts beside its own tables.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python workers in small batches, unless the session already
    has a setting of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) == 10_000:  # Spark's default
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Columns of one given table; the rest is not read."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, *tables: DataFrame, shuffles: bool = False) -> None:
    """Deletes stored tables that no later step reads.  ``shuffles``: also the shuffle files
    of finished jobs, which Spark drops once the driver's JVM has collected their plans."""
    jvm = spark.sparkContext._jvm
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    if shuffles:
        jvm.System.gc()


def words(text: Column | str) -> Column:
    """Array of the words of a text; a null or blank text has none."""
    bare = F.trim(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                  F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT))


def without(text: Column, chars: str) -> Column:
    """The text with every one of ``chars`` removed."""
    return F.translate(text, chars, "")
