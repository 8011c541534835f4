"""A history whose feed changes its columns and types over the years.

Beside the date folders lies a log, ``_schemas``: the columns each date was delivered
with.  The history's schema is the least one that holds them all: a column that some
dates lack is NULL there, and a type may widen (``WIDER``) but not change its kind.  A
delivery that no common schema can hold is refused, and the history stays as it was.

Files keep the type they were written with; Parquet's reader widens them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.totals import SchemaMismatch
from .files import path_exists
from .history import read_history
from .landing import Landed, land_snapshot

LOG = "_schemas"

# What a type may become without losing a value.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"), "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"), "float": ("double",), "date": ("timestamp_ntz",),
}
TYPES = {t.simpleString(): t for t in (T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                                       T.TimestampNTZType())}


def common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds all values of both; None if there is none."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    x, y = a.simpleString(), b.simpleString()
    if y in WIDER.get(x, ()):
        return b
    if x in WIDER.get(y, ()):
        return a
    for wide in WIDER.get(x, ()):       # neither holds the other: the first that holds both
        if wide in WIDER.get(y, ()):
            return TYPES[wide]
    return None


def common_schema(schemas) -> T.StructType:
    """All columns of the schemas, in order of appearance, each with its common type."""
    fields: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            known = fields.get(f.name)
            kind = f.dataType if known is None else common_type(known, f.dataType)
            if kind is None:
                raise SchemaMismatch(f"{f.name} is {f.dataType.simpleString()}, and was "
                                     f"{known.simpleString()}")
            fields[f.name] = kind
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def logged_schemas(spark: SparkSession, path: str) -> list[T.StructType]:
    """The different schemas that dates were delivered with, oldest first (a handful)."""
    log = f"{path}/{LOG}"
    if not path_exists(spark, log):
        return []
    rows = (spark.read.schema("date string, fields string").json(log)
            .groupBy("fields").agg(F.min("date").alias("first")).orderBy("first", "fields").collect())
    return [T.StructType.fromJson(json.loads(r["fields"])) for r in rows]


def read_drifting(spark: SparkSession, path: str) -> DataFrame:
    """The whole history as one frame, in the least common schema of its dates."""
    return read_history(spark, path, common_schema(logged_schemas(spark, path)))


def land_drifting(spark: SparkSession, snapshot: DataFrame, path: str, date_col: str = "Date",
                  **kw) -> Landed:
    """``land_snapshot`` with the snapshot's own columns: new ones are taken up, missing
    ones are NULL, types widen; raises ``SchemaMismatch`` where they cannot."""
    own = T.StructType([T.StructField(f.name, f.dataType) for f in snapshot.schema.fields])
    whole = common_schema([*logged_schemas(spark, path), own])
    fits = snapshot.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                             for f in whole.fields if f.name in snapshot.columns])
    done = land_snapshot(spark, fits, path, whole, date_col, **kw)
    # After the rows, so that a refused snapshot leaves no entry; logged again by a rerun.
    (snapshot.select(F.col(f"`{date_col}`").cast("string").alias("date")).distinct()
     .withColumn("fields", F.lit(own.json())).repartition(1)
     .write.mode("append").json(f"{path}/{LOG}"))
    return done
