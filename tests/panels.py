"""Hand-made snapshot panels for the tests."""

import datetime as dt

from pyspark.sql import types as T

D0 = dt.date(2021, 7, 1)


def day(i: int) -> dt.date:
    return D0 + dt.timedelta(days=i)


PANEL_SCHEMA = T.StructType([T.StructField("Date", T.DateType()),
                             T.StructField("Location", T.StringType()),
                             T.StructField("x", T.LongType())])


def panel(spark, rows):
    return spark.createDataFrame(rows, PANEL_SCHEMA)


def three_keys(spark):
    """3 keys × 15 days: A dense and growing, B with a zero week and a
    missing day, NULL key dense, C only on the last day (ragged)."""
    rows = []
    for i in range(15):
        rows.append((day(i), "A", 100 + 10 * i))
        if i != 7:
            rows.append((day(i), "B", 50 if i >= 7 else 40 + i))
        rows.append((day(i), None, 1000 + i))
    rows.append((day(14), "C", 5))
    return panel(spark, rows)
