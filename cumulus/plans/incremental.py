"""Daily results from the day's rows and a small stored state, not from the history.

The rolling report needs, per key, the last values and the last k − 1 daily changes; the
share report needs the last values (k = 1).  That state is a table of one row per key, one version
per date (``state/as_of=…``), beside the rows published then (``rows/as_of=…``).  A day's update
reads the newest earlier version and the day's rows, and writes the next version and the
day's result: its cost is that of a day, and what it publishes equals the full run.

A rerun of a day reads the same earlier version and replaces its own output.  A day not
newer than every other one published is refused: later days would have to be done again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.shares import share_pivot


class OutOfOrder(ValueError):
    """A day older than one already published."""


def _versions(spark: SparkSession, path: str) -> list[dt.date]:
    """Dates of the stored state versions, oldest first (names of folders only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/state")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    found = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("as_of=") and fs.exists(done):
            found.append(dt.date.fromisoformat(name[len("as_of="):]))
    return sorted(found)


class RollingState:
    """Trailing means over ``k`` rows of the day-over-day changes of ``values``, by ``keys``.

    ``start`` takes a whole history once; ``update`` then takes one day at a time."""

    def __init__(self, spark: SparkSession, path: str, keys, values, date_col: str = "Date", k: int = 7):
        self.spark, self.path, self.k = spark, path.rstrip("/"), k
        self.keys, self.values, self.date_col = list(keys), list(values), date_col

    def _write(self, df: DataFrame, kind: str, day: dt.date) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{kind}={day.isoformat()}")

    def start(self, history: DataFrame) -> dt.date:
        """Publish every day of ``history`` and store the state of its last one."""
        last = history.agg(F.max(self.date_col)).first()[0]
        w = Window.partitionBy(*self.keys).orderBy(self.date_col)
        rows = history.select(*self.keys, self.date_col, *self.values)
        for v in self.values:
            rows = rows.withColumn(f"__d_{v}", F.col(v) - F.lag(v).over(w))
        rows = rows.withColumns({f"__r_{v}": F.reverse(F.collect_list(
            F.struct(F.col(f"__d_{v}").alias("d"))).over(w.rowsBetween(1 - self.k, 0)))
            for v in self.values}).withColumn("__n", F.row_number().over(w))
        # The first row of a key has no change: a list that still holds it is a short one.
        rows = rows.withColumns({f"__r_{v}": F.when(
            F.col("__n") < self.k + 1, F.slice(f"__r_{v}", 1, F.col("__n") - 1))
            .otherwise(F.col(f"__r_{v}")) for v in self.values})
        self._write(self._published(rows), "rows/as_of", last)
        newest = Window.partitionBy(*self.keys).orderBy(F.col(self.date_col).desc())
        state = rows.withColumn("__last", F.row_number().over(newest)).filter("__last = 1")
        self._write(self._state(state), "state/as_of", last)
        return last

    def update(self, day_rows: DataFrame, day: dt.date) -> DataFrame:
        """Publish ``day`` from its rows (one per key); returns its published rows."""
        earlier = [d for d in _versions(self.spark, self.path) if d < day]
        if not earlier:
            raise OutOfOrder(f"no state before {day}: start from a history first")
        if any(d > day for d in _versions(self.spark, self.path)):
            raise OutOfOrder(f"{day} is older than {max(_versions(self.spark, self.path))}")
        old = self.spark.read.parquet(f"{self.path}/state/as_of={earlier[-1].isoformat()}")
        new = day_rows.select(*self.keys, F.lit(day).alias(self.date_col),
                              *[F.col(v).alias(f"__new_{v}") for v in self.values])
        old = old.select(*[F.col(c).alias(f"__k_{c}") for c in self.keys],
                         *[c for c in old.columns if c not in self.keys], F.lit(True).alias("__known"))
        same = F.lit(True)
        for c in self.keys:
            same &= F.col(c).eqNullSafe(F.col(f"__k_{c}"))
        both = new.withColumn("__today", F.lit(True)).join(old, same, "full")
        both = both.withColumns({c: F.when(F.col("__today"), F.col(c)).otherwise(F.col(f"__k_{c}"))
                                 for c in self.keys})
        for v in self.values:
            change = F.struct((F.col(f"__new_{v}") - F.col(v)).alias("d"))
            grown = F.slice(F.concat(F.array(change), F.col(f"__r_{v}")), 1, self.k)
            empty = F.slice(F.array(change), 1, 0)
            both = both.withColumn(f"__r_{v}", F.when(F.col("__today") & F.col("__known"), grown)
                                   .when(F.col("__today"), empty).otherwise(F.col(f"__r_{v}")))
            both = both.withColumn(v, F.when(F.col("__today"), F.col(f"__new_{v}")).otherwise(F.col(v)))
        both = both.select(*self.keys, self.date_col, "__today", *self.values,
                           *[f"__r_{v}" for v in self.values]).persist()
        try:
            self._write(self._published(both.filter("__today")), "rows/as_of", day)
            self._write(self._state(both), "state/as_of", day)
        finally:
            both.unpersist()
        return self.published().filter(F.col(self.date_col) == F.lit(day))

    def published(self) -> DataFrame:
        """All published rows: keys, date, and of each value its change and its mean
        (NULL unless ``k`` changes are there)."""
        return self.spark.read.parquet(f"{self.path}/rows").select(
            *self.keys, self.date_col,
            *[f"{v}{s}" for v in self.values for s in ("_diff", "_diff_avg")])

    def _state(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.keys, *self.values,
                           *[F.slice(f"__r_{v}", 1, self.k - 1).alias(f"__r_{v}") for v in self.values])

    def _published(self, rows: DataFrame) -> DataFrame:
        out = {}
        for v in self.values:
            recent = F.transform(f"__r_{v}", lambda x: x["d"])
            total = F.aggregate(recent, F.lit(0).cast("long"), lambda a, x: a + x)
            whole = (F.size(recent) == self.k) & ~F.exists(recent, lambda x: x.isNull())
            out[f"{v}_diff"] = F.get(recent, F.lit(0))
            out[f"{v}_diff_avg"] = F.when(whole, total.cast("double") / F.lit(float(self.k)))
        return rows.select(*self.keys, self.date_col, *[c.alias(n) for n, c in out.items()])


def share_rows(published: DataFrame, categories, label_pattern: str | None, category_col: str,
               value_col: str, date_col: str = "date", id_alias: str = "Date") -> DataFrame:
    """The share table of published days: each category's change as a percentage of the
    day's, from a ``RollingState`` (k = 1) kept by category."""
    changes = published.filter(F.col(f"{value_col}_diff").isNotNull())
    return share_pivot(changes, date_col, category_col, f"{value_col}_diff", categories, 100.0,
                       label_pattern, id_alias=id_alias)
