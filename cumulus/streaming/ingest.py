"""Snapshot files landing in a folder → the partitioned history.

The daily batch of the tracked program (fetch, normalise, append) as a
Structured Streaming query: a file source with a declared schema, a normalising
projection, and ``foreachBatch`` appending rows once per date and key.
``availableNow`` processes whatever has landed and stops, so it can be
scheduled like the batch it replaces.

A date may be split over files, and files may come late or in several
micro-batches: each row whose date and key the history lacks is added.  A batch
replayed after a lost driver adds none, as its rows are known by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.reshape import normalise_snapshot
from ..sources.history import append_rows


def start_snapshot_ingest(spark: SparkSession, landing_dir: str, record: T.StructType,
                          field: str, history_path: str, history_schema: T.StructType,
                          checkpoint: str, head_field: str = "meta",
                          normalise=normalise_snapshot, keys=("Location",),
                          max_files_per_trigger: int | None = None,
                          multi_line: bool = False) -> StreamingQuery:
    """Start the ingest; with ``availableNow`` it stops once the landed files
    are processed (``awaitTermination()``).  ``normalise`` maps feed records
    to history rows; ``keys`` name a row within a date; ``multi_line`` reads one
    document per file instead of one per line."""
    env = T.StructType([T.StructField(head_field, T.StringType(), True),
                        T.StructField(field, T.ArrayType(record), True)])
    reader = (spark.readStream.schema(env).option("mode", "FAILFAST")
              .option("multiLine", multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = normalise(reader.json(landing_dir).select(F.inline(F.col(field))))

    def _append(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            append_rows(batch.sparkSession, batch, history_path, history_schema, keys)

    return (rows.writeStream.foreachBatch(_append)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
