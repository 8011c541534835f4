"""Named queries of landing, drifting schemas, large documents, long series and
incremental reports, each with its SQL; registered beside those of ``catalog``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import constants as K
from ..operators.deltas import snapshot_pairs
from ..operators.reshape import snake_names
from ..operators.series import numbered, row_delta_long, trailing_mean_long
from ..operators.snapshots import resolve_latest
from ..session import scratch_path
from ..sources.drift import land_drifting, read_drifting
from ..sources.files import (read_csv_checked, read_csv_ordered, read_json_envelope_at, read_rejects,
                             write_csv, write_csv_ordered, write_json_envelopes)
from ..sources.history import read_history
from ..sources.json_ranges import read_json_document
from ..sources.landing import land_rows, land_snapshot, read_marks, read_quarantine
from . import standins as S
from .catalog import BAND_DIFF_SQL, BANDS, W, _label, _share_wide_sql, query
from .incremental import RollingState, share_rows
from .standins import EVENTS_SQL, FEED_SQL, NATION_SQL

PANEL = T.StructType([T.StructField("Location", T.StringType()), T.StructField("events", T.LongType()),
                      T.StructField("value_cents", T.LongType()), T.StructField("Date", T.DateType())])


def _panel(spark: SparkSession, d: str) -> DataFrame:
    return S.stored(S.events_panel(spark, d), "events_panel").select(*PANEL.fieldNames())


# ============================ landing =========================================
@query("landing_recovery", W(EVENTS_SQL) + """
SELECT p.Date, p.Location, p.events, p.value_cents, m.rows AS marked_rows
FROM epanel p JOIN (SELECT Date, count(*) AS rows FROM epanel GROUP BY Date) m ON p.Date = m.Date""")
def landing_recovery(spark: SparkSession, d: str) -> DataFrame:
    """A part of every date has landed, from a stream or a lost driver.  The snapshots of
    all dates complete them, and a rerun adds nothing."""
    panel, path = _panel(spark, d), scratch_path(spark, "landing_recovery")
    part = panel.filter(F.pmod(F.xxhash64("Location", "Date"), F.lit(2)) == 0)
    land_rows(spark, part, path, PANEL, ["Location"])
    for _ in range(2):
        land_snapshot(spark, panel, path, PANEL, keys=["Location"], backfill=True)
    marks = read_marks(spark, path, PANEL).select("Date", F.col("rows").alias("marked_rows"))
    return (read_history(spark, path, PANEL).join(marks, "Date")
            .select("Date", "Location", "events", "value_cents", "marked_rows"))


@query("landing_quarantine", W(EVENTS_SQL) + """
SELECT Date, Location, events + 1 AS events, value_cents, 'clash' AS reason FROM epanel
WHERE events % 2 = 0
UNION ALL
SELECT Date, 'late ' || Location, events, value_cents, 'closed' FROM epanel
WHERE Date = (SELECT max(Date) FROM epanel)""")
def landing_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Revised rows of every date, and keys that a complete date lacks: the history stays,
    they are reported once however often they come."""
    panel, path = _panel(spark, d), scratch_path(spark, "landing_quarantine")
    land_snapshot(spark, panel, path, PANEL, backfill=True)
    revised = panel.withColumn("events", F.when(F.col("events") % 2 == 0, F.col("events") + 1)
                               .otherwise(F.col("events")))
    last = panel.filter(F.col("Date") == F.lit(resolve_latest(panel)))
    more = last.withColumn("Location", F.concat(F.lit("late "), "Location")).unionByName(
        revised.filter(F.col("Date") == F.lit(resolve_latest(panel))))
    revised, more = S.stored(revised, "revised"), S.stored(more, "more")
    for _ in range(2):
        land_rows(spark, revised, path, PANEL, ["Location"])
        land_snapshot(spark, more, path, PANEL, keys=["Location"])
    return read_quarantine(spark, path, PANEL).select("Date", "Location", "events", "value_cents",
                                                      "reason")


@query("schema_drift", W(EVENTS_SQL) + """
, mx AS (SELECT max(Date) AS d FROM epanel)
SELECT Date, Location, events,
       CASE WHEN Date > (SELECT d FROM mx) - 20 THEN value_cents END AS value_cents,
       CASE WHEN Date > (SELECT d FROM mx) - 10 THEN CAST(events AS DOUBLE) / 2 END AS half
FROM epanel""")
def schema_drift(spark: SparkSession, d: str) -> DataFrame:
    """Counts arrive as int, then as bigint with a column more, then with another."""
    panel, path = _panel(spark, d), scratch_path(spark, "schema_drift")
    day = resolve_latest(panel)
    at = [F.lit(day - dt.timedelta(days=n)) for n in (20, 10)]
    land_drifting(spark, panel.filter(F.col("Date") <= at[0]).select(
        "Date", "Location", F.col("events").cast("int").alias("events")), path, backfill=True)
    land_drifting(spark, panel.filter((F.col("Date") > at[0]) & (F.col("Date") <= at[1])), path,
                  backfill=True)
    land_drifting(spark, panel.filter(F.col("Date") > at[1]).withColumn(
        "half", F.col("events").cast("double") / 2), path, backfill=True)
    return read_drifting(spark, path).select("Date", "Location", "events", "value_cents", "half")


# ============================ scans and sinks =================================
@query("csv_checked_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS key, c_acctbal AS value, CAST(NULL AS VARCHAR) AS bad
FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT NULL, NULL, CAST(c_custkey AS VARCHAR) || ',none' FROM customer WHERE c_acctbal < 0""")
def csv_checked_scan(spark: SparkSession, d: str) -> DataFrame:
    """Customers as CSV, the balance a word where it is negative: good rows and rejects."""
    cust = S.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    path, rejects = (scratch_path(spark, f"csv_checked_{x}") for x in ("scan", "rejects"))
    text = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("string")).otherwise(F.lit("none"))
    write_csv(cust.select("c_custkey", text.alias("c_acctbal")), path)
    good = [read_csv_checked(spark, path, cust.schema, rejects) for _ in range(2)][-1]
    return good.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_acctbal").alias("value"),
                       F.lit(None).cast("string").alias("bad")).unionByName(
        read_rejects(spark, rejects).select(F.lit(None).cast("string").alias("key"),
                                            F.lit(None).cast("double").alias("value"),
                                            F.col("line").alias("bad")))


@query("json_by_position", "SELECT event_id, user_id, event_type, value FROM events")
def json_by_position(spark: SparkSession, d: str) -> DataFrame:
    """The records of an envelope's second member, under two names that the reader does
    not know."""
    ev = S.table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    path = scratch_path(spark, "json_by_position")
    for name, half in (("records", 0), ("renamed", 1)):
        write_json_envelopes(ev.filter(F.col("event_id") % 2 == half), f"{path}/{name}", name)
    return read_json_envelope_at(spark, f"{path}/*", ev.schema, 2)


@query("json_large_document", """
SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal
FROM customer""")
def json_large_document(spark: SparkSession, d: str) -> DataFrame:
    """All customers as documents over many lines, read by byte ranges."""
    cust = S.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = scratch_path(spark, "json_large_document")
    row = F.to_json(F.struct("c_custkey", "c_name", "c_mktsegment",
                             F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"),
                             F.struct(F.lit('a "]}" {[').alias("note")).alias("more")))
    # One document a part: its records over many lines, and members before and after them.
    part = F.spark_partition_id().alias("p")
    docs = (cust.repartition(8, "c_custkey").select(part, row.alias("r")).groupBy("p")
            .agg(F.array_join(F.collect_list("r"), ",\n  ").alias("r")))
    docs.select(F.concat(F.lit('{"runid": "x}{",\n "rows": [\n  '), "r",
                         F.lit('\n ],\n "other": [{"c_custkey": -1}]}'))).write.text(path)
    return read_json_document(spark, path, cust.schema, "rows")


@query("csv_ordered_sink", """
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place, o_orderkey,
       o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""")
def csv_ordered_sink(spark: SparkSession, d: str) -> DataFrame:
    """Orders by price, sorted over tasks; the place of a row is that in the parts as named."""
    o = S.table(spark, d, "orders").select("o_orderkey", "o_totalprice",
                                           F.to_date("o_orderdate").alias("o_orderdate"))
    path = scratch_path(spark, "csv_ordered_sink")
    write_csv_ordered(o, path, [("o_totalprice", "desc"), "o_orderkey"])
    back = read_csv_ordered(spark, path, o.schema)
    in_file = back.withColumn("file", F.input_file_name()).withColumn(
        "at", F.monotonically_increasing_id())
    return (numbered(in_file.withColumn("all", F.lit(0)), ["all"], ["file", "at"], "place", 100_000)
            .select("place", "o_orderkey", "o_totalprice", "o_orderdate"))


@query("unique_snake_names", """
SELECT c_custkey AS a_b, c_name AS a_b_2, c_mktsegment AS a_b_3, c_name AS resume_percent,
       c_custkey AS x, c_mktsegment AS x_2
FROM customer""")
def unique_snake_names(spark: SparkSession, d: str) -> DataFrame:
    """Names that clean alike, with marks, or with no Latin letter."""
    c = S.table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", F.col("c_name").alias("4"), F.col("c_custkey").alias("5"),
        F.col("c_mktsegment").alias("6"))
    return snake_names(c.toDF("A b", "a_B", "A.b", "Résumé %", "名", "--"))


# ============================ pairing and series ==============================
@query("repeated_key_delta", W(NATION_SQL) + """
, s AS (
  SELECT Date, CASE WHEN LongName IN (SELECT Geographic_Area_Name FROM dim) THEN Location END AS Location,
         LongName, Doses_Administered FROM snap),
n AS (
  SELECT *, row_number() OVER (PARTITION BY Date, Location ORDER BY LongName, Doses_Administered) AS k
  FROM s)
SELECT a.Location, a.LongName, a.Doses_Administered,
       a.Doses_Administered - b.Doses_Administered AS Doses_Administered_delta
FROM n a LEFT JOIN n b ON a.Location IS NOT DISTINCT FROM b.Location AND a.k = b.k
     AND b.Date = a.Date - 7
WHERE a.Date = (SELECT max(Date) FROM snap)""")
def repeated_key_delta(spark: SparkSession, d: str) -> DataFrame:
    """Weekly change where all nations outside the dimension share the NULL key."""
    hist = S.nation_history(spark, d)
    dim = S.nation_dim(spark, d).select(F.col("postal_code").alias("code"))
    keyed = (hist.join(dim, hist.Location == dim.code, "left")
             .select("Date", F.col("code").alias("Location"), "LongName", "Doses_Administered"))
    return snapshot_pairs(keyed, ["Location"], ["LongName"], ["Doses_Administered"],
                          latest=resolve_latest(hist), block=1000)


@query("long_series", """
WITH p AS (
  SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
x AS (SELECT *, cents - lag(cents) OVER (ORDER BY o_orderkey) AS cents_diff FROM p)
SELECT o_orderkey, cents, cents_diff,
       CASE WHEN count(cents_diff) OVER w = 7 THEN CAST(sum(cents_diff) OVER w AS DOUBLE) / 7 END
         AS cents_diff_avg
FROM x WINDOW w AS (ORDER BY o_orderkey ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def long_series(spark: SparkSession, d: str) -> DataFrame:
    """All orders as one series: change from order to order and its trailing mean, in
    blocks of rows."""
    p = S.table(spark, d, "orders").select(
        F.lit("all").alias("key"), "o_orderkey",
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    x = row_delta_long(p, ["key"], "o_orderkey", ["cents"], block=10_000)
    return trailing_mean_long(x, ["key"], "o_orderkey", ["cents_diff"], block=10_000).drop("key")


@query("hot_group_numbers", """
SELECT l_returnflag, l_orderkey, l_linenumber,
       row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS number
FROM lineitem""")
def hot_group_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Line items numbered within their return flag: three groups hold all rows."""
    li = S.table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber")
    return numbered(li, ["l_returnflag"], ["l_orderkey", "l_linenumber"], block=10_000)


# ============================ incremental reports =============================
@query("incremental_rolling", W(NATION_SQL) + """
, x AS (SELECT Location, Date, Doses_Administered,
               Doses_Administered - lag(Doses_Administered) OVER (PARTITION BY Location ORDER BY Date)
                 AS diff FROM snap)
SELECT Location, Date, diff AS Doses_Administered_diff,
       CASE WHEN count(diff) OVER w = 7 THEN CAST(sum(diff) OVER w AS DOUBLE) / 7 END
         AS Doses_Administered_diff_avg
FROM x WINDOW w AS (PARTITION BY Location ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def incremental_rolling(spark: SparkSession, d: str) -> DataFrame:
    """The rolling report of the whole history: all days but three in one go, three from
    the day's rows and the stored state."""
    hist = S.nation_history(spark, d)
    last = resolve_latest(hist)
    days = [last - dt.timedelta(days=n) for n in (2, 1, 0)]
    state = RollingState(spark, scratch_path(spark, "incremental_rolling"), ["Location"],
                         ["Doses_Administered"])
    state.start(hist.filter(F.col("Date") < F.lit(days[0])))
    for day in days:
        state.update(hist.filter(F.col("Date") == F.lit(day)), day)
    return state.published()


@query("incremental_shares", W(FEED_SQL, BAND_DIFF_SQL, _share_wide_sql("wide", BANDS))
       + "SELECT * FROM wide")
def incremental_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share history, its last two days from the stored last values."""
    feed = S.stored(S.band_feed(spark, d), "band_feed", "date")
    feed = feed.filter(F.col("demographic_category").isNotNull())
    last = resolve_latest(feed, "date")
    days = [last - dt.timedelta(days=n) for n in (1, 0)]
    state = RollingState(spark, scratch_path(spark, "incremental_shares"), ["demographic_category"],
                         ["series_complete_yes"], "date", k=1)
    state.start(feed.filter(F.col("date") < F.lit(days[0])))
    for day in days:
        state.update(feed.filter(F.col("date") == F.lit(day)), day)
    return share_rows(state.published(), BANDS, K.BAND_LABEL_PATTERN, "demographic_category",
                      "series_complete_yes")
