"""Named queries over the driver tables, each with its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is
the same result written as SQL over the driver's tables.  Column names match
on both sides.  Building a query may run jobs: those over the jurisdiction
history store it and resolve its latest date first, and those that exercise
file sources write Spark-derived data to a fresh folder under the session's
shared checkpoint dir and read it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import (add_days, display_string, first_match, is_in, lateness_label,
                         ne_and_not_null, nonzero, not_in_keep_null, parse_thousands,
                         per_capita, round_half_even, str_trim, thousands,
                         weighted_sum, month_label)
from ..functions import date_text
from ..functions.text import TRIM_PATTERN
from ..operators.deltas import pct_change, period_delta, row_delta, snapshot_delta
from ..operators.joins import join_dim, scalar_value
from ..operators.reshape import (canonical_value, cast_by_pattern, regex_rename,
                                 rename_columns, snake_names, stamp_date)
from ..operators.rolling import trailing_mean
from ..operators.shares import group_share, group_total, share_pivot
from ..operators.snapshots import (distinct_dates, latest_date, newer_than, resolve_latest,
                                   single_date, two_snapshots)
from ..operators.sorting import sort_by
from ..operators.totals import total_row, union_by_name, with_total_row
from ..schemas import COUNTY_RECORD, SNAPSHOT_RECORD
from ..session import scratch_path
from ..sources.files import (extract_json, read_csv_typed, read_feed_to_date,
                             read_json_envelope, write_csv, write_json_envelopes)
from ..sources.history import append_by_date, append_if_newer, read_history
from . import reports as R
from . import standins as S
from .standins import COUNTY_SQL, EVENTS_SQL, FEED_SQL, NATION_SQL

QUERIES: dict = {}
ORACLE: dict = {}

D1, D2, J = "Administered_Dose1_Recip", "Administered_Dose2_Recip", "Administered_Janssen"
NOT_EXCL_NAMES = "coalesce(LongName NOT IN ({}), true)".format(
    ", ".join(f"'{n}'" for n in S.EXCLUDED_NAMES))
NOT_EXCL_NAMES_SUPPLY = "coalesce(LongName NOT IN ({}), true)".format(
    ", ".join(f"'{n}'" for n in S.EXCLUDED_NAMES_SUPPLY))
NOT_EXCL_CODES = "coalesce(Location NOT IN ({}), true)".format(
    ", ".join(f"'{n}'" for n in S.EXCLUDED_CODES))
BANDS = S.band_names()


def query(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip().rstrip(",") for c in ctes) + "\n"


def q_list(vals) -> str:
    return ", ".join(f"'{v}'" for v in vals)


def _as_of(history: DataFrame):
    """Run date of the stand-in reports: the data's latest date, resolved once."""
    return F.lit(resolve_latest(history))


# ============================ sources and sinks ===============================
@query("csv_typed_scan", """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, c_mktsegment
FROM customer""")
def csv_typed_scan(spark: SparkSession, d: str) -> DataFrame:
    cust = S.table(spark, d, "customer")
    out = cust.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    path = scratch_path(spark, "csv_typed_scan")
    write_csv(out, path)
    return read_csv_typed(spark, path, cust.schema)


@query("history_scan", W(EVENTS_SQL) + """
SELECT Date, Location, events, value_cents FROM epanel
WHERE Date IN ((SELECT max(Date) FROM epanel), (SELECT max(Date) FROM epanel) - 7)""")
def history_scan(spark: SparkSession, d: str) -> DataFrame:
    panel = S.events_panel(spark, d)
    path = scratch_path(spark, "history_scan")
    panel.write.mode("overwrite").partitionBy("Date").parquet(path)
    schema = T.StructType([T.StructField("Location", T.StringType()),
                           T.StructField("events", T.LongType()),
                           T.StructField("value_cents", T.LongType()),
                           T.StructField("Date", T.DateType())])
    hist = read_history(spark, path, schema)
    return two_snapshots(hist, "Date", 7).select("Date", "Location", "events", "value_cents")


@query("json_envelope_scan", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_envelope_scan(spark: SparkSession, d: str) -> DataFrame:
    ev = S.table(spark, d, "events")
    path = scratch_path(spark, "json_envelope_scan")
    write_json_envelopes(ev, path, "records", F.floor(F.col("event_id") / 1000))
    return read_json_envelope(spark, path, ev.schema, "records")


@query("json_nullsafe_extract", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract(props, '$.j') AS BIGINT) AS j
FROM events""")
def json_nullsafe_extract(spark: SparkSession, d: str) -> DataFrame:
    ev = S.table(spark, d, "events")
    s = extract_json("props", T.StructType([T.StructField("k", T.LongType()),
                                            T.StructField("j", T.LongType())]))
    return ev.select("event_id", s.alias("p")).select("event_id", "p.k", "p.j")


@query("feed_scan_to_date", """
SELECT event_id, CAST(ts AS DATE) AS ts, event_type, value FROM events""")
def feed_scan_to_date(spark: SparkSession, d: str) -> DataFrame:
    ev = S.table(spark, d, "events").select("event_id", "ts", "event_type", "value")
    path = scratch_path(spark, "feed_scan_to_date")
    write_csv(ev, path)
    return read_feed_to_date(spark, path, ev.schema, "ts")


def _month_sql(date: str) -> str:
    return f"(strftime({date}, '%B ') || CAST(year({date}) AS VARCHAR))"


def _date_text_sql(date: str) -> str:
    return (f"(CAST(year({date}) AS VARCHAR) || '-' || lpad(CAST(month({date}) AS VARCHAR), 2, '0')"
            f" || '-' || lpad(CAST(day({date}) AS VARCHAR), 2, '0'))")


TARGET_SQL_BODY = f"""
mx AS (SELECT max(Date) AS d FROM snap),
newer AS (SELECT * FROM snap WHERE Date = (SELECT d FROM mx) AND {NOT_EXCL_NAMES}),
older AS (SELECT * FROM snap WHERE Date = (SELECT d FROM mx) - 7 AND {NOT_EXCL_NAMES}),
dl AS (
  SELECT n.*, n.Doses_Administered - o.Doses_Administered AS dd,
         n.{D1} - o.{D1} AS d1d
  FROM newer n LEFT JOIN older o ON n.Location IS NOT DISTINCT FROM o.Location),
det AS (
  SELECT dl.LongName,
         round_even((CAST(dl.{D2} + dl.{J} AS DOUBLE) / NULLIF(dl.Census2019, 0)) * 100, 0)
           AS pct_fully,
         dl.dd AS doses_last_week,
         round_even((((CAST(0.7 AS DOUBLE) * dl.Census2019) - dl.{D1}) / NULLIF(dl.d1d, 0)) * 7 + 28, 0)
           AS sort_days
  FROM dl JOIN dim ON dl.Location = dim.postal_code
  WHERE dl.dd <> 0),
nat AS (SELECT * FROM latest WHERE Location = 'US'),
pace AS (SELECT sum(d1d) AS p FROM dl),
tot AS (
  SELECT 'U.S. Total' AS "State",
         CAST(round_even(CAST((CAST((SELECT {D2} + {J} FROM nat) AS DOUBLE)
              / NULLIF((SELECT Census2019 FROM nat), 0)) * 100 AS DECIMAL(38, 12)), 1) AS DOUBLE)
           AS "% Population Fully Immunized",
         format('{{:,}}', CAST((SELECT sum(doses_last_week) FROM det) AS BIGINT))
           AS "Doses administered in the last week",
         {_month_sql("(SELECT d FROM mx) + CAST(t.days AS INTEGER)")}
           AS "Estimated to 70% Pop 2 Doses"
  FROM (SELECT round_even((((SELECT Census2019 FROM nat) * CAST(0.7 AS DOUBLE)
                 - (SELECT {D1} FROM nat)) / NULLIF((SELECT p FROM pace), 0)) * 7 + 28, 0)
               AS days) t),
shown AS (
  SELECT LongName AS "State", pct_fully AS "% Population Fully Immunized",
         lpad(format('{{:,}}', doses_last_week),
              CAST(max(length(format('{{:,}}', doses_last_week))) OVER () AS INTEGER), ' ')
           AS "Doses administered in the last week",
         {_month_sql("(SELECT d FROM mx) + CAST(sort_days AS INTEGER)")}
           AS "Estimated to 70% Pop 2 Doses"
  FROM det)
"""
TARGET_SQL = W(NATION_SQL, TARGET_SQL_BODY) + "SELECT * FROM tot UNION ALL SELECT * FROM shown"


def _nation(spark, d):
    hist = S.nation_history(spark, d)
    return hist, S.latest_snapshot(hist), S.nation_dim(spark, d)


def _target(spark, d, parts=None):
    hist, snap, dim = parts or _nation(spark, d)
    return R.report_target(hist, snap, dim, _as_of(hist), excluded_names=S.EXCLUDED_NAMES,
                           national_code=S.PARENT_CODE, national_population=None)


@query("csv_sink_roundtrip", TARGET_SQL)
def csv_sink_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    parts = _nation(spark, d)
    rep = _target(spark, d, parts)
    run_date = resolve_latest(parts[0])
    path = write_csv(rep, scratch_path(spark, "csv_sink_roundtrip"), single_file=True,
                     run_date=run_date)
    schema = T.StructType([T.StructField(c, T.StringType() if t == "string" else T.DoubleType())
                           for c, t in rep.dtypes])
    return read_csv_typed(spark, path, schema)


EVENTS_PANEL_SQL = W(EVENTS_SQL) + "SELECT Location, Date, events, value_cents FROM epanel"


@query("streaming_ingest", EVENTS_PANEL_SQL)
def streaming_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Snapshots land as JSON documents; a Structured Streaming query
    (availableNow, foreachBatch) appends each row once to a partitioned
    history, which is then read back."""
    from ..streaming.ingest import start_snapshot_ingest
    panel = S.events_panel(spark, d)
    record = T.StructType([T.StructField("Date", T.StringType()),
                           T.StructField("Location", T.StringType()),
                           T.StructField("events", T.LongType()),
                           T.StructField("value_cents", T.LongType())])
    hist_schema = T.StructType([T.StructField("Location", T.StringType()),
                                T.StructField("events", T.LongType()),
                                T.StructField("value_cents", T.LongType()),
                                T.StructField("Date", T.DateType())])
    text = panel.withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))
    landing = scratch_path(spark, "streaming_landing")
    hist_path = scratch_path(spark, "streaming_history")
    checkpoint = scratch_path(spark, "streaming_checkpoint")
    # Every date lands split over the files of two deliveries, the second of
    # them late, and each run takes the files in several micro-batches.  A third
    # brings other counts for all rows: the history stays, they go to quarantine.
    late = F.pmod(F.xxhash64("Location"), F.lit(2)) == 0
    revised = text.withColumn("events", F.col("events") + 1)
    for part in (text.filter(~late), text.filter(late), revised):
        write_json_envelopes(part.repartition(4, "Location"), landing, "records", mode="append")
        q = start_snapshot_ingest(spark, landing, record, "records", hist_path, hist_schema,
                                  checkpoint, max_files_per_trigger=2,
                                  normalise=lambda df: df.withColumn("Date", F.to_date("Date")))
        q.awaitTermination()
    return read_history(spark, hist_path, hist_schema).select("Location", "Date", "events",
                                                              "value_cents")


@query("append_snapshot", EVENTS_PANEL_SQL)
def append_snapshot(spark: SparkSession, d: str) -> DataFrame:
    panel = S.events_panel(spark, d)
    mx = S.events_last_day(spark, d)
    return append_by_date(panel.filter(F.col("Date") < mx), panel.filter(F.col("Date") == mx))


@query("store_snapshot", EVENTS_PANEL_SQL)
def store_snapshot_q(spark: SparkSession, d: str) -> DataFrame:
    """The stored path: a backfill of all days but the last, the last day as one
    snapshot without its value column's order, and both once more."""
    from ..sources.history import store_snapshot
    panel = S.stored(S.events_panel(spark, d), "events_panel")
    schema = T.StructType([T.StructField("Location", T.StringType()),
                           T.StructField("events", T.LongType()),
                           T.StructField("value_cents", T.LongType()),
                           T.StructField("Date", T.DateType())])
    mx = F.lit(resolve_latest(panel))
    path = scratch_path(spark, "stored_history")
    for _ in range(2):
        store_snapshot(spark, panel.filter(F.col("Date") < mx), path, schema, backfill=True)
        store_snapshot(spark, panel.filter(F.col("Date") == mx).select(
            "value_cents", "Date", "Location", "events"), path, schema)
    return read_history(spark, path, schema).select("Location", "Date", "events", "value_cents")


@query("append_snapshot_noop", W(EVENTS_SQL) + """
SELECT Location, Date, events, value_cents FROM epanel
WHERE Date < (SELECT max(Date) FROM epanel)""")
def append_snapshot_noop(spark: SparkSession, d: str) -> DataFrame:
    panel = S.events_panel(spark, d)
    mx = S.events_last_day(spark, d)
    hist = panel.filter(F.col("Date") < mx)
    again = hist.filter(F.col("Date") == F.date_sub(mx, 1)).withColumn("events", F.col("events") + 1)
    return append_by_date(hist, again)


@query("append_if_newer", EVENTS_PANEL_SQL)
def append_if_newer_q(spark: SparkSession, d: str) -> DataFrame:
    panel = S.events_panel(spark, d)
    hist = panel.filter(F.col("Date") <= F.date_sub(S.events_last_day(spark, d), 7))
    return append_if_newer(hist, panel)


# ============================ projections =====================================
@query("rename_display", """
SELECT c_name AS "State", c_custkey AS "Total Currently Eligible",
       c_acctbal AS "% Pop. with 1+ Dose"
FROM customer""")
def rename_display(spark: SparkSession, d: str) -> DataFrame:
    cust = S.table(spark, d, "customer").select("c_name", "c_custkey", "c_acctbal")
    return rename_columns(cust, {"c_name": "State", "c_custkey": "Total Currently Eligible",
                                 "c_acctbal": "% Pop. with 1+ Dose"})


def _band_sums_sql(src: str, value: str, cats, label=lambda c: c) -> str:
    return ", ".join(f"CAST(sum(CASE WHEN demographic_category = '{c}' THEN {value} END) AS BIGINT)"
                     f" AS \"{label(c)}\""
                     for c in cats)


def _label(c: str) -> str:
    from ..operators.shares import label_from_pattern
    return label_from_pattern(c, K.BAND_LABEL_PATTERN)


@query("regex_rename", W(FEED_SQL) + f"""
SELECT date, {_band_sums_sql('feed', 'series_complete_yes', BANDS, _label)}
FROM feed GROUP BY date""")
def regex_rename_q(spark: SparkSession, d: str) -> DataFrame:
    feed = S.band_feed(spark, d)
    wide = feed.groupBy("date").pivot("demographic_category", BANDS).agg(F.sum("series_complete_yes"))
    return regex_rename(wide, K.BAND_LABEL_PATTERN)


def _plain_sql(expr: str) -> str:
    """A number's plain text without trailing zeros."""
    return f"regexp_replace(CAST(CAST({expr} AS DECIMAL(38, 9)) AS VARCHAR), '\\.?0+$', '')"


@query("display_cast", f"""
SELECT c_custkey, {_plain_sql("c_acctbal")} AS balance, {_plain_sql("c_custkey * 100")} AS hundreds
FROM customer""")
def display_cast(spark: SparkSession, d: str) -> DataFrame:
    return S.table(spark, d, "customer").select(
        "c_custkey", display_string("c_acctbal").alias("balance"),
        display_string(F.col("c_custkey") * 100).alias("hundreds"))


@query("canonical_name", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'URGENT'
                        WHEN o_orderpriority = '5-LOW' THEN 'LOW' ELSE o_orderpriority END AS priority
FROM orders""")
def canonical_name(spark: SparkSession, d: str) -> DataFrame:
    names = {"1-URGENT": "URGENT", "5-LOW": "LOW"}
    return S.table(spark, d, "orders").select(
        "o_orderkey", canonical_value("o_orderpriority", names).alias("priority"))


def _lateness_sql(col: str, goal: str) -> str:
    e = [goal] + [f"({goal} + INTERVAL {m} MONTH)" for m in K.LATENESS_EDGE_MONTHS]
    L = K.LATENESS_LABELS
    return f"""CASE
  WHEN {col} > {e[0]} AND {col} < {e[1]} THEN '{L[0]}'
  WHEN {col} >= {e[1]} AND {col} < {e[2]} THEN '{L[1]}'
  WHEN {col} >= {e[2]} AND {col} < {e[3]} THEN '{L[2]}'
  WHEN {col} >= {e[3]} AND {col} < {e[4]} THEN '{L[3]}'
  WHEN {col} >= {e[4]} AND {col} < {e[5]} THEN '{L[4]}'
  WHEN {col} >= {e[5]} AND {col} < {e[6]} THEN '{L[5]}'
  WHEN {col} >= {e[6]} AND {col} < {e[7]} THEN '{L[6]}'
  WHEN {col} > {e[7]} THEN '{L[7]}'
  WHEN {col} <= {e[0]} THEN '{L[8]}' END"""


@query("bucket_cascade", """
WITH g AS (SELECT CAST(min(l_shipdate) AS DATE) + INTERVAL 48 MONTH AS goal FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date,
""" + _lateness_sql("CAST(l_shipdate AS DATE)", "CAST((SELECT goal FROM g) AS DATE)")
       + " AS lateness FROM lineitem")
def bucket_cascade(spark: SparkSession, d: str) -> DataFrame:
    li = S.table(spark, d, "lineitem")
    goal = F.add_months(li.select(F.min(F.to_date("l_shipdate"))).scalar(), 48)
    return li.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship_date"),
                     lateness_label(F.to_date("l_shipdate"), goal).alias("lateness"))


@query("scalar_lookup", W(NATION_SQL) + """
SELECT Location, (CAST(Doses_Administered AS DOUBLE)
       / NULLIF((SELECT Doses_Administered FROM latest WHERE Location = 'US'), 0)) * 100
       AS share_of_parent
FROM latest""")
def scalar_lookup(spark: SparkSession, d: str) -> DataFrame:
    _, snap, _ = _nation(spark, d)
    parent = scalar_value(snap, "Location", S.PARENT_CODE, "Doses_Administered")
    return snap.select("Location", per_capita("Doses_Administered", parent, 100)
                       .alias("share_of_parent"))


@query("total_row", """
SELECT 'Total' AS label, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
       CAST(sum(l_linenumber) AS BIGINT) AS lines,
       (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem) AS last_ship
FROM lineitem""")
def total_row_q(spark: SparkSession, d: str) -> DataFrame:
    li = S.table(spark, d, "lineitem").select(F.col("l_quantity").cast("bigint").alias("qty"),
                                              F.col("l_linenumber").cast("bigint").alias("lines"),
                                              "l_shipdate")
    last = li.select(F.max(F.to_date("l_shipdate"))).scalar()
    return total_row(li, "label", "Total", sums=("qty", "lines"), extra={"last_ship": last})


# ============================ filters =========================================
# Customers in debt have no segment here, so the filter meets NULLs.
SEGMENT_SQL = "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END"


@query("filter_not_in", f"""
SELECT c_custkey, {SEGMENT_SQL} AS segment FROM customer
WHERE coalesce({SEGMENT_SQL} NOT IN ('BUILDING', 'MACHINERY'), true)""")
def filter_not_in(spark: SparkSession, d: str) -> DataFrame:
    cust = S.table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"))
    return cust.filter(not_in_keep_null("segment", ("BUILDING", "MACHINERY")))


@query("filter_in", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')""")
def filter_in(spark: SparkSession, d: str) -> DataFrame:
    return (S.table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
             .filter(is_in("o_orderpriority", ("1-URGENT", "5-LOW"))))


@query("filter_eq", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_returnflag = 'R'""")
def filter_eq(spark: SparkSession, d: str) -> DataFrame:
    return (S.table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
             .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("filter_nonzero", W(EVENTS_SQL) + """
SELECT Location, Date, events - lag(events) OVER (PARTITION BY Location ORDER BY Date) AS events_diff
FROM epanel QUALIFY events_diff <> 0""")
def filter_nonzero(spark: SparkSession, d: str) -> DataFrame:
    p = row_delta(S.events_panel(spark, d), ["Location"], "Date", ["events"])
    return p.filter(nonzero("events_diff")).select("Location", "Date", "events_diff")


@query("filter_ne_notnull", W(COUNTY_SQL) + """
SELECT c_custkey, FIPS, Series_Complete_Pop_Pct FROM county
WHERE FIPS <> 'UNK' AND Series_Complete_Pop_Pct IS NOT NULL""")
def filter_ne_notnull(spark: SparkSession, d: str) -> DataFrame:
    c = S.county_records(spark, d)
    return (c.filter(ne_and_not_null("FIPS", "UNK", "Series_Complete_Pop_Pct"))
             .select("c_custkey", "FIPS", "Series_Complete_Pop_Pct"))


@query("filter_notnull", W(EVENTS_SQL) + """
SELECT Location, Date, value_cents - lag(value_cents) OVER (PARTITION BY Location ORDER BY Date)
       AS value_cents_diff
FROM epanel QUALIFY value_cents_diff IS NOT NULL""")
def filter_notnull(spark: SparkSession, d: str) -> DataFrame:
    p = row_delta(S.events_panel(spark, d), ["Location"], "Date", ["value_cents"])
    return (p.filter(F.col("value_cents_diff").isNotNull())
             .select("Location", "Date", "value_cents_diff"))


@query("two_snapshots", W(NATION_SQL) + f"""
SELECT Date, Location, {D1} FROM snap
WHERE Date IN ((SELECT max(Date) FROM snap), (SELECT max(Date) FROM snap) - 7)""")
def two_snapshots_q(spark: SparkSession, d: str) -> DataFrame:
    return two_snapshots(S.nation_history(spark, d), "Date", 7).select("Date", "Location", D1)


@query("newer_than_max", W(FEED_SQL) + """
SELECT date, demographic_category, series_complete_yes FROM feed
WHERE date > (SELECT max(date) - 7 FROM feed)""")
def newer_than_max(spark: SparkSession, d: str) -> DataFrame:
    feed = S.band_feed(spark, d)
    hist = feed.filter(F.col("date") <= F.date_sub(latest_date(feed, "date"), 7))
    return newer_than(feed, hist, "date")


# ============================ joins ===========================================
@query("join_dim", W(NATION_SQL) + """
SELECT l.LongName, l.Location, dim.Geographic_Area_Name, dim.Census2019_18PlusPop_2
FROM latest l JOIN dim ON l.Location = dim.postal_code""")
def join_dim_q(spark: SparkSession, d: str) -> DataFrame:
    _, snap, dim = _nation(spark, d)
    return join_dim(snap, dim, "Location", "postal_code").select(
        "LongName", "Location", "Geographic_Area_Name", "Census2019_18PlusPop_2")


@query("join_as_filter", W(NATION_SQL) + f"""
SELECT s.Date, s.Location, s.{D2} FROM snap s JOIN dim ON s.Location = dim.postal_code""")
def join_as_filter(spark: SparkSession, d: str) -> DataFrame:
    hist = S.nation_history(spark, d)
    dim = S.nation_dim(spark, d)
    return join_dim(hist, dim, "Location", "postal_code").select("Date", "Location", D2)


@query("left_join_dim", W(NATION_SQL) + """
SELECT l.LongName, f.postal_code, f.fips_code
FROM latest l LEFT JOIN (SELECT n_name AS name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0')
                                AS postal_code, n_nationkey AS fips_code FROM nation) f
  ON l.LongName = f.name""")
def left_join_dim(spark: SparkSession, d: str) -> DataFrame:
    _, snap, _ = _nation(spark, d)
    return join_dim(snap, S.fips_dim(spark, d), "LongName", "name", "left").select(
        "LongName", "postal_code", "fips_code")


# ============================ aggregations ====================================
@query("delta_total", W(NATION_SQL, TARGET_SQL_BODY) + """
SELECT CAST(sum(d1d) AS BIGINT) AS first_doses_last_week FROM dl""")
def delta_total(spark: SparkSession, d: str) -> DataFrame:
    hist = S.nation_history(spark, d)
    dl = snapshot_delta(hist, ["Location"], [D1], where=not_in_keep_null("LongName", S.EXCLUDED_NAMES))
    return dl.agg(F.sum(D1 + "_delta").alias("first_doses_last_week"))


@query("distinct_dates", W(NATION_SQL) + "SELECT DISTINCT Date FROM snap")
def distinct_dates_q(spark: SparkSession, d: str) -> DataFrame:
    return distinct_dates(S.nation_history(spark, d), "Date")


@query("single_date", W(EVENTS_SQL) + "SELECT max(Date) AS Date FROM epanel")
def single_date_q(spark: SparkSession, d: str) -> DataFrame:
    """The one date of the last day's snapshot; several would raise."""
    panel = S.events_panel(spark, d)
    return single_date(panel.filter(F.col("Date") == S.events_last_day(spark, d)))


BAND_DIFF_SQL = f"""
fd AS (
  SELECT date, demographic_category,
         series_complete_yes - lag(series_complete_yes)
           OVER (PARTITION BY demographic_category ORDER BY date) AS diff
  FROM feed WHERE demographic_category IN ({q_list(BANDS)})
  QUALIFY diff IS NOT NULL)
"""


def _feed(spark, d):
    """The category feed, derived once and stored (lineage cut)."""
    return S.stored(S.band_feed(spark, d), "band_feed", "date")


def _band_diff(spark, d, feed=None):
    feed = (feed if feed is not None else _feed(spark, d)).filter(is_in("demographic_category", BANDS))
    return row_delta(feed, ["demographic_category"], "date", ["series_complete_yes"],
                     suffix="_diff").filter(F.col("series_complete_yes_diff").isNotNull()) \
        .select("date", "demographic_category", F.col("series_complete_yes_diff").alias("diff"))


# Sundays have no group: their rows form the NULL group.
WORKDAY_SQL = "CASE WHEN dayofweek(date) <> 0 THEN date END"


def _with_workday(rows: DataFrame) -> DataFrame:
    return rows.withColumn("workday", F.when(F.dayofweek("date") != 1, F.col("date")))


@query("group_sum_back", W(FEED_SQL, BAND_DIFF_SQL) + f"""
SELECT date, demographic_category, diff, workday,
       CAST(sum(diff) OVER (PARTITION BY workday) AS BIGINT) AS day_total
FROM (SELECT *, {WORKDAY_SQL} AS workday FROM fd)""")
def group_sum_back(spark: SparkSession, d: str) -> DataFrame:
    return group_total(_with_workday(_band_diff(spark, d)), ["workday"], "diff", "day_total")


@query("group_share", W(FEED_SQL, BAND_DIFF_SQL) + f"""
SELECT date, demographic_category,
       (CAST(diff AS DOUBLE) / NULLIF(sum(diff) OVER (PARTITION BY workday), 0)) * 100 AS share
FROM (SELECT *, {WORKDAY_SQL} AS workday FROM fd)""")
def group_share_q(spark: SparkSession, d: str) -> DataFrame:
    return group_share(_with_workday(_band_diff(spark, d)), ["workday"], "diff").select(
        "date", "demographic_category", "share")


def _share_cols_sql(cats, src="w") -> str:
    tot = " + ".join(f"coalesce({src}.\"s{i}\", 0)" for i in range(len(cats)))
    return ", ".join(f"(CAST({src}.\"s{i}\" AS DOUBLE) / NULLIF({tot}, 0)) * 100 AS \"{_label(c)}\""
                     for i, c in enumerate(cats))


def _share_wide_sql(name: str, cats, where: str = "true") -> str:
    sums = ", ".join(f"sum(CASE WHEN demographic_category = '{c}' THEN diff END) AS \"s{i}\""
                     for i, c in enumerate(cats))
    return (f"{name} AS (SELECT w.date AS Date, {_share_cols_sql(cats)} FROM "
            f"(SELECT date, {sums} FROM fd WHERE demographic_category IN ({q_list(cats)}) "
            f"AND {where} GROUP BY date) w)")


@query("share_pivot", W(FEED_SQL, BAND_DIFF_SQL, _share_wide_sql("sw", BANDS)) + "SELECT * FROM sw")
def share_pivot_q(spark: SparkSession, d: str) -> DataFrame:
    return share_pivot(_band_diff(spark, d), "date", "demographic_category", "diff", BANDS,
                       100.0, K.BAND_LABEL_PATTERN, id_alias="Date")


# ============================ windows =========================================
@query("period_delta", W(NATION_SQL) + f"""
SELECT Date, Location, {D1} - max({D1}) OVER week_ago AS {D1}_delta,
       Doses_Administered - max(Doses_Administered) OVER week_ago AS Doses_Administered_delta
FROM snap WINDOW week_ago AS (
  PARTITION BY Location ORDER BY Date
  RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING)""")
def period_delta_q(spark: SparkSession, d: str) -> DataFrame:
    hist = S.nation_history(spark, d).select("Date", "Location", D1, "Doses_Administered")
    return period_delta(hist, ["Location"], [D1, "Doses_Administered"]).select(
        "Date", "Location", D1 + "_delta", "Doses_Administered_delta")


@query("day_delta", W(NATION_SQL) + f"""
SELECT Date, Location, {D1} - lag({D1}) OVER (PARTITION BY Location ORDER BY Date) AS {D1}_diff,
       {D2} - lag({D2}) OVER (PARTITION BY Location ORDER BY Date) AS {D2}_diff
FROM snap""")
def day_delta(spark: SparkSession, d: str) -> DataFrame:
    hist = S.nation_history(spark, d).select("Date", "Location", D1, D2)
    return row_delta(hist, ["Location"], "Date", [D1, D2]).select(
        "Date", "Location", D1 + "_diff", D2 + "_diff")


@query("grouped_delta", W(FEED_SQL, BAND_DIFF_SQL) + "SELECT date, demographic_category, diff FROM fd")
def grouped_delta(spark: SparkSession, d: str) -> DataFrame:
    return _band_diff(spark, d)


@query("trailing_mean", W(NATION_SQL) + f"""
, dd AS (SELECT Date, Location,
                {D1} - lag({D1}) OVER (PARTITION BY Location ORDER BY Date) AS d1
         FROM snap)
SELECT Date, Location, d1,
       CASE WHEN count(d1) OVER w = 7 THEN CAST(sum(d1) OVER w AS DOUBLE) / 7 END AS d1_avg
FROM dd WINDOW w AS (PARTITION BY Location ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def trailing_mean_q(spark: SparkSession, d: str) -> DataFrame:
    hist = S.nation_history(spark, d).select("Date", "Location", F.col(D1).alias("v"))
    dd = row_delta(hist, ["Location"], "Date", ["v"]).withColumnRenamed("v_diff", "d1")
    return trailing_mean(dd, ["Location"], "Date", ["d1"], 7).select("Date", "Location", "d1", "d1_avg")


# ============================ sorts ===========================================
STATE_DETAIL_SQL = f"""
det2 AS (
  SELECT LongName, Doses_Distributed, Doses_Administered,
         Administered_Dose1_Pop_Pct * 1000 AS Administered_Dose1_Per_100K,
         round_even((CAST({D2} + {J} AS DOUBLE) / NULLIF(Census2019, 0)) * 100000, 0)
           AS Complete_Vaccinations_Per_100K
  FROM latest WHERE {NOT_EXCL_CODES})
"""


@query("sort_desc", W(NATION_SQL, STATE_DETAIL_SQL) + "SELECT * FROM det2")
def sort_desc(spark: SparkSession, d: str) -> DataFrame:
    _, snap, _ = _nation(spark, d)
    det = (snap.filter(not_in_keep_null("Location", S.EXCLUDED_CODES))
           .select("LongName", "Doses_Distributed", "Doses_Administered",
                   (F.col("Administered_Dose1_Pop_Pct") * 1000).alias("Administered_Dose1_Per_100K"),
                   round_half_even(per_capita(F.col(D2) + F.col(J), "Census2019"))
                   .alias("Complete_Vaccinations_Per_100K")))
    return sort_by(det, ("Complete_Vaccinations_Per_100K", "desc"), "LongName")


@query("sort_helper", W(NATION_SQL, TARGET_SQL_BODY) + """
SELECT LongName, pct_fully, doses_last_week FROM det""")
def sort_helper(spark: SparkSession, d: str) -> DataFrame:
    hist, snap, dim = _nation(spark, d)
    det = R.target_detail(hist, dim, _as_of(hist), excluded_names=S.EXCLUDED_NAMES)
    return sort_by(det, "sort_days", "LongName").drop("sort_days", "target_month")


@query("sort_mixed", W(NATION_SQL) + f"""
SELECT Date, LongName, {D1} FROM snap
WHERE Date IN ((SELECT max(Date) FROM snap), (SELECT max(Date) FROM snap) - 7)""")
def sort_mixed(spark: SparkSession, d: str) -> DataFrame:
    two = two_snapshots(S.nation_history(spark, d)).select("Date", "LongName", D1)
    return sort_by(two, ("Date", "desc"), "LongName")


# ============================ set operations ==================================
HIST_CATS = [c for c in BANDS if c != BANDS[1]]


@query("union_by_name", W(FEED_SQL, BAND_DIFF_SQL,
                          _share_wide_sql("hist", HIST_CATS,
                                          "date <= (SELECT max(date) - 7 FROM feed)"),
                          _share_wide_sql("fresh", BANDS,
                                          "date > (SELECT max(date) - 7 FROM feed)")) + f"""
SELECT *, CAST(NULL AS DOUBLE) AS "{_label(BANDS[1])}" FROM hist
UNION ALL BY NAME SELECT * FROM fresh""")
def union_by_name_q(spark: SparkSession, d: str) -> DataFrame:
    feed = _feed(spark, d)
    diff = _band_diff(spark, d, feed)
    cut = F.date_sub(F.lit(resolve_latest(feed, "date")), 7)
    hist = share_pivot(diff.filter(F.col("date") <= cut), "date", "demographic_category",
                       "diff", HIST_CATS, 100.0, K.BAND_LABEL_PATTERN, id_alias="Date")
    fresh = share_pivot(diff.filter(F.col("date") > cut), "date", "demographic_category",
                        "diff", BANDS, 100.0, K.BAND_LABEL_PATTERN, id_alias="Date")
    return union_by_name(hist, fresh)


@query("with_total_row", W(NATION_SQL, STATE_DETAIL_SQL) + """
SELECT 'Total' AS LongName, CAST(sum(Doses_Distributed) AS BIGINT) AS Doses_Distributed,
       CAST(sum(Doses_Administered) AS BIGINT) AS Doses_Administered, 0 AS sort_group
FROM det2
UNION ALL
SELECT LongName, Doses_Distributed, Doses_Administered, 1 AS sort_group FROM det2""")
def with_total_row_q(spark: SparkSession, d: str) -> DataFrame:
    det = sort_desc(spark, d).select("LongName", "Doses_Distributed", "Doses_Administered")
    tot = total_row(det, "LongName", "Total", sums=("Doses_Distributed", "Doses_Administered"))
    return with_total_row(tot, det, group_col="sort_group")


# ============================ scalar functions ================================
@query("round_even", """
SELECT l_orderkey, l_linenumber,
       round_even(l_extendedprice * (1 - l_discount), 0) AS net_rounded FROM lineitem""")
def round_even(spark: SparkSession, d: str) -> DataFrame:
    li = S.table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     round_half_even(F.col("l_extendedprice") * (1 - F.col("l_discount")))
                     .alias("net_rounded"))


@query("round_even_1", """
SELECT l_orderkey, l_linenumber,
       CAST(round_even(CAST(l_extendedprice AS DECIMAL(12, 2))
            * (1 - CAST(l_discount AS DECIMAL(12, 2))), 1) AS DOUBLE) AS net_1dp
FROM lineitem""")
def round_even_1(spark: SparkSession, d: str) -> DataFrame:
    li = S.table(spark, d, "lineitem")
    net = F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(12,2)"))
    return li.select("l_orderkey", "l_linenumber", round_half_even(net, 1).alias("net_1dp"))


@query("per_capita", W(NATION_SQL) + f"""
SELECT Location, (CAST({D1} AS DOUBLE) / NULLIF(Census2019, 0)) * 100000 AS dose1_per_100k,
       (CAST({D2} + {J} AS DOUBLE) / NULLIF(Census2019, 0)) * 100 AS pct_complete
FROM latest""")
def per_capita_q(spark: SparkSession, d: str) -> DataFrame:
    _, snap, _ = _nation(spark, d)
    return snap.select("Location", per_capita(D1, "Census2019").alias("dose1_per_100k"),
                       per_capita(F.col(D2) + F.col(J), "Census2019", 100).alias("pct_complete"))


@query("weighted_units", """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS DOUBLE) / 2 + CAST(l_suppkey AS DOUBLE) / 2
       + l_linenumber AS courses
FROM lineitem""")
def weighted_units(spark: SparkSession, d: str) -> DataFrame:
    return S.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        weighted_sum([("l_partkey", 2), ("l_suppkey", 2), ("l_linenumber", 1)]).alias("courses"))


@query("goal_projection", W(NATION_SQL, TARGET_SQL_BODY) + f"""
SELECT LongName, sort_days,
       {_date_text_sql("(SELECT d FROM mx) + CAST(sort_days AS INTEGER)")} AS target_date
FROM det""")
def goal_projection(spark: SparkSession, d: str) -> DataFrame:
    hist, snap, dim = _nation(spark, d)
    det = R.target_detail(hist, dim, _as_of(hist), excluded_names=S.EXCLUDED_NAMES)
    return det.select("LongName", "sort_days",
                      date_text(add_days(_as_of(hist), F.col("sort_days"))).alias("target_date"))


@query("month_label", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%B %Y') AS order_month FROM orders""")
def month_label_q(spark: SparkSession, d: str) -> DataFrame:
    o = S.table(spark, d, "orders")
    return o.select("o_orderkey", month_label(F.to_date("o_orderdate")).alias("order_month"))


@query("thousands_format", """
SELECT o_orderkey, format('{:,}', CAST(round(o_totalprice * 100) AS BIGINT)) AS total_cents
FROM orders""")
def thousands_format(spark: SparkSession, d: str) -> DataFrame:
    o = S.table(spark, d, "orders")
    return o.select("o_orderkey",
                    thousands(F.round(F.col("o_totalprice") * 100)).alias("total_cents"))


PADDED_SQL = """
pad AS (
  SELECT o_orderkey, lpad(format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)),
         CAST(max(length(format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)))) OVER ()
              AS INTEGER), ' ') AS total_padded
  FROM orders)
"""


def _padded(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey",
                                           F.bround("o_totalprice").alias("t"))
    width = o.select(F.max(F.length(thousands("t")))).scalar()
    return o.select("o_orderkey", F.lpad(thousands("t"), width, " ").alias("total_padded"))


@query("padded_format", W(PADDED_SQL) + "SELECT * FROM pad")
def padded_format(spark: SparkSession, d: str) -> DataFrame:
    return _padded(spark, d)


@query("str_trim", f"""
SELECT doc_id, regexp_replace(text, '{TRIM_PATTERN}', '', 'g') AS text_trimmed FROM documents""")
def str_trim_q(spark: SparkSession, d: str) -> DataFrame:
    docs = S.table(spark, d, "documents")
    return docs.select("doc_id", str_trim("text").alias("text_trimmed"))


@query("parse_formatted", W(PADDED_SQL) + """
SELECT o_orderkey, TRY_CAST(replace(regexp_replace(total_padded, '^\\s+|\\s+$', '', 'g'), ',', '')
       AS BIGINT) AS total_parsed
FROM pad""")
def parse_formatted(spark: SparkSession, d: str) -> DataFrame:
    return _padded(spark, d).select("o_orderkey",
                                    parse_thousands("total_padded").alias("total_parsed"))


@query("regex_extract", f"""
SELECT doc_id, NULLIF(regexp_extract(text, '{K.BAND_LABEL_PATTERN}'), '') AS band FROM documents""")
def regex_extract(spark: SparkSession, d: str) -> DataFrame:
    docs = S.table(spark, d, "documents")
    return docs.select("doc_id", first_match("text", K.BAND_LABEL_PATTERN).alias("band"))


# ============================ commented-out steps =============================
@query("pct_change", W(NATION_SQL) + f"""
, mx AS (SELECT max(Date) AS d FROM snap),
n AS (SELECT * FROM snap WHERE Date = (SELECT d FROM mx) AND {NOT_EXCL_NAMES}),
o AS (SELECT * FROM snap WHERE Date = (SELECT d FROM mx) - 7 AND {NOT_EXCL_NAMES})
SELECT n.LongName,
       CAST(n.Doses_Administered - o.Doses_Administered AS DOUBLE) / NULLIF(o.Doses_Administered, 0)
         AS Doses_Administered_pct_chg,
       CAST(n.{D1} - o.{D1} AS DOUBLE) / NULLIF(o.{D1}, 0) AS {D1}_pct_chg
FROM n LEFT JOIN o ON n.Location = o.Location
WHERE n.Doses_Administered - o.Doses_Administered <> 0""")
def pct_change_q(spark: SparkSession, d: str) -> DataFrame:
    hist = S.nation_history(spark, d).filter(not_in_keep_null("LongName", S.EXCLUDED_NAMES))
    hist = hist.select("Date", "Location", "LongName", "Doses_Administered", D1)
    pc = pct_change(hist, ["Location"], ["Doses_Administered", D1])
    pc = pc.filter(nonzero(F.col("Doses_Administered_pct_chg")))
    return sort_by(pc.select("LongName", "Doses_Administered_pct_chg", D1 + "_pct_chg"),
                   (D1 + "_pct_chg", "desc"), "LongName")


@query("cast_by_pattern", """
SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey,
       l_linenumber, l_returnflag FROM lineitem""")
def cast_by_pattern_q(spark: SparkSession, d: str) -> DataFrame:
    return cast_by_pattern(S.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"), "key", "double")


STATE_TABLE_SQL_BODY = f"""
nat AS (SELECT * FROM latest WHERE Location = 'US'),
tot2 AS (
  SELECT 'U.S. Total' AS LongName,
         format('{{:,}}', CAST(sum(Doses_Distributed) AS BIGINT)) AS Doses_Distributed,
         format('{{:,}}', CAST(sum(Doses_Administered) AS BIGINT)) AS Doses_Administered,
         format('{{:,}}', CAST(round_even((SELECT Administered_Dose1_Pop_Pct FROM nat) * 1000, 0) AS BIGINT))
           AS Administered_Dose1_Per_100K,
         format('{{:,}}', CAST(round_even((CAST((SELECT {D2} + {J} FROM nat) AS DOUBLE)
                / NULLIF((SELECT Census2019 FROM nat), 0)) * 100000, 0) AS BIGINT))
           AS Complete_Vaccinations_Per_100K
  FROM det2),
state AS (
  SELECT LongName AS "State", Doses_Distributed AS "Total Doses Delivered",
         Doses_Administered AS "Total Doses Administered",
         Administered_Dose1_Per_100K AS "People with 1 Dose per 100k",
         Complete_Vaccinations_Per_100K AS "People Completely Vaccinated per 100k"
  FROM (SELECT * FROM tot2 UNION ALL
        SELECT LongName, CAST(Doses_Distributed AS VARCHAR), CAST(Doses_Administered AS VARCHAR),
               {_plain_sql("Administered_Dose1_Per_100K")},
               CAST(CAST(Complete_Vaccinations_Per_100K AS BIGINT) AS VARCHAR)
        FROM det2))
"""


def _state(spark, d):
    _, snap, _ = _nation(spark, d)
    return R.report_state_table(snap, excluded_codes=S.EXCLUDED_CODES,
                                national_code=S.PARENT_CODE,
                                national_population=scalar_value(snap, "Location", S.PARENT_CODE,
                                                                 "Census2019"))


@query("snake_names", W(NATION_SQL, STATE_DETAIL_SQL, STATE_TABLE_SQL_BODY) + """
SELECT "State" AS state, "Total Doses Delivered" AS total_doses_delivered,
       "Total Doses Administered" AS total_doses_administered,
       "People with 1 Dose per 100k" AS people_with_1_dose_per_100k,
       "People Completely Vaccinated per 100k" AS people_completely_vaccinated_per_100k
FROM state""")
def snake_names_q(spark: SparkSession, d: str) -> DataFrame:
    return snake_names(_state(spark, d))


@query("stamp_date", """
SELECT o_orderkey, o_totalprice, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS run_date
FROM orders""")
def stamp_date_q(spark: SparkSession, d: str) -> DataFrame:
    o = S.table(spark, d, "orders")
    last = o.select(F.max(F.to_date("o_orderdate"))).scalar()
    return stamp_date(o.select("o_orderkey", "o_totalprice"), last, "run_date")


# ============================ composed reports ================================
@query("report_history", W(NATION_SQL) + """
SELECT Date, Location,
       CASE WHEN Date = (SELECT max(Date) FROM snap) AND LongName = 'NATION_1' THEN 'NATION ONE'
            ELSE LongName END AS LongName,
       Census2019, Census2019_12PlusPop, Doses_Distributed, Doses_Administered,
       Administered_Dose1_Recip, Administered_Dose2_Recip, Administered_Janssen,
       Administered_Dose1_Pop_Pct, Distributed_Moderna, Distributed_Pfizer, Distributed_Janssen
FROM snap""")
def report_history(spark: SparkSession, d: str) -> DataFrame:
    return history_roundtrip(spark, S.nation_history(spark, d))


def history_roundtrip(spark: SparkSession, hist: DataFrame) -> DataFrame:
    """Land the latest snapshot as JSON envelopes, read it back, append once."""
    mx = latest_date(hist)
    records = (hist.filter(F.col("Date") == mx)
                   .withColumn("Date", F.date_format("Date", "yyyy-MM-dd")))
    path = scratch_path(spark, "report_history")
    write_json_envelopes(records, path, "vaccination_data")
    landed = read_json_envelope(spark, path, SNAPSHOT_RECORD, "vaccination_data")
    return R.report_history(hist.filter(F.col("Date") < mx), landed, S.CANONICAL_NAMES)


@query("report_state_table", W(NATION_SQL, STATE_DETAIL_SQL, STATE_TABLE_SQL_BODY)
       + "SELECT * FROM state")
def report_state_table(spark: SparkSession, d: str) -> DataFrame:
    return _state(spark, d)


@query("report_map", W(NATION_SQL) + f"""
SELECT l.LongName AS "ID",
       CAST(round_even(CAST((CAST(round_even(CAST(l.{D2} + l.{J} AS DOUBLE), 0) AS DOUBLE)
            / NULLIF(l.Census2019_12PlusPop, 0)) * 100 AS DECIMAL(38, 12)), 1) AS DOUBLE)
         AS "% of Currently Eligible Vaccinated",
       l.Census2019_12PlusPop AS "Total Currently Eligible"
FROM latest l JOIN dim ON l.Location = dim.postal_code""")
def report_map(spark: SparkSession, d: str) -> DataFrame:
    _, snap, dim = _nation(spark, d)
    return R.report_map(snap, dim)


@query("report_target", TARGET_SQL)
def report_target(spark: SparkSession, d: str) -> DataFrame:
    return _target(spark, d)


@query("report_supply", W(NATION_SQL) + f"""
, mx AS (SELECT max(Date) AS d FROM snap),
cs AS (SELECT *, CAST(Distributed_Moderna AS DOUBLE) / 2 + CAST(Distributed_Pfizer AS DOUBLE) / 2
                 + Distributed_Janssen AS courses FROM snap),
n AS (SELECT * FROM cs WHERE Date = (SELECT d FROM mx) AND {NOT_EXCL_NAMES_SUPPLY}),
o AS (SELECT * FROM cs WHERE Date = (SELECT d FROM mx) - 7 AND {NOT_EXCL_NAMES_SUPPLY}),
j AS (
  SELECT n.*, n.courses - o.courses AS cd, dim.Census2019_18PlusPop_2
  FROM n LEFT JOIN o ON n.Location IS NOT DISTINCT FROM o.Location
  JOIN dim ON n.Location = dim.postal_code
  WHERE n.courses - o.courses <> 0),
k AS (
  SELECT *, round_even(((Census2019_18PlusPop_2 - courses) / NULLIF(cd, 0)) * 7, 0) AS days FROM j),
p AS (
  SELECT *, (SELECT d FROM mx) + CAST(days AS INTEGER) AS ad FROM k)
SELECT LongName AS "State",
       CAST(round_even((CAST({D2} + {J} AS DOUBLE) / NULLIF(Census2019, 0)) * 100000, 0) AS BIGINT)
         AS "People Vaccinated per 100K",
       Census2019_18PlusPop_2 AS "Population",
       {_lateness_sql('ad', '(SELECT d FROM mx)')} AS "How far behind",
       {_date_text_sql('ad')} AS "100% Vaccine Availability Est. Date"
FROM p""")
def report_supply(spark: SparkSession, d: str) -> DataFrame:
    hist, _, dim = _nation(spark, d)
    as_of = _as_of(hist)
    rep = R.report_supply(hist, dim, as_of, goal=as_of, excluded_names=S.EXCLUDED_NAMES_SUPPLY)
    day = K.SUPPLY_NAMES["availability_date"]
    return rep.withColumn(day, date_text(F.col(f"`{day}`")))


@query("report_rolling", W(NATION_SQL) + f"""
, dd AS (SELECT Date, {D1} - lag({D1}) OVER w0 AS a, {D2} - lag({D2}) OVER w0 AS b
         FROM snap WHERE Location = 'US' WINDOW w0 AS (ORDER BY Date)),
r AS (SELECT Date,
             CASE WHEN count(a) OVER w = 7 THEN CAST(sum(a) OVER w AS DOUBLE) / 7 END AS fa,
             CASE WHEN count(b) OVER w = 7 THEN CAST(sum(b) OVER w AS DOUBLE) / 7 END AS sa
      FROM dd WINDOW w AS (ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT Date, fa AS "First Dose Daily Avg", sa AS "Second Dose Daily Avg" FROM r WHERE fa IS NOT NULL""")
def report_rolling(spark: SparkSession, d: str) -> DataFrame:
    return R.report_rolling(S.nation_history(spark, d), national_code=S.PARENT_CODE)


@query("report_county", W(COUNTY_SQL) + f"""
SELECT CAST(Date AS DATE) AS Date, FIPS AS "FIPS-Code", StateName,
       regexp_replace(StateAbbr, '{TRIM_PATTERN}', '', 'g') AS StateAbbr, County,
       Series_Complete_Pop_Pct, Administered_Dose1_Pop_Pct
FROM county WHERE FIPS <> 'UNK' AND Series_Complete_Pop_Pct IS NOT NULL""")
def report_county(spark: SparkSession, d: str) -> DataFrame:
    recs = S.county_records(spark, d)
    path = scratch_path(spark, "report_county")
    write_json_envelopes(recs, path, "vaccination_county_condensed_data",
                         F.floor(F.col("c_custkey") / 1000),
                         record_cols=[f.name for f in COUNTY_RECORD.fields])
    landed = read_json_envelope(spark, path, COUNTY_RECORD, "vaccination_county_condensed_data")
    return R.report_county(landed)


@query("report_age_share", W(FEED_SQL, BAND_DIFF_SQL,
                             _share_wide_sql("hist", HIST_CATS,
                                             "date <= (SELECT max(date) - 7 FROM feed)"),
                             _share_wide_sql("fresh", BANDS,
                                             "date > (SELECT max(Date) FROM hist)")) + f"""
SELECT *, CAST(NULL AS DOUBLE) AS "{_label(BANDS[1])}" FROM hist
UNION ALL BY NAME SELECT * FROM fresh""")
def report_age_share(spark: SparkSession, d: str) -> DataFrame:
    return age_share_from_feed(_feed(spark, d))


def age_share_from_feed(feed: DataFrame) -> DataFrame:
    """Share history up to a week before the feed's end (six bands, as the
    published history lacks one), then the new days appended by the report."""
    diff = _band_diff(None, None, feed)
    cut = F.lit(resolve_latest(feed, "date")) - F.expr("INTERVAL 7 DAYS")
    hist = share_pivot(diff.filter(F.col("date") <= cut), "date", "demographic_category",
                       "diff", HIST_CATS, 100.0, K.BAND_LABEL_PATTERN, id_alias="Date")
    return R.report_age_share(feed, hist, categories=BANDS)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Smoke query: what changed in the last week, by key, on the events panel."""
    panel = S.events_panel(spark, d)
    out = snapshot_delta(panel, ["Location"], ["events", "value_cents"],
                         latest=S.events_last_day(spark, d))
    return sort_by(out, ("events_delta", "desc"), "Location")


# ============================ lineitem-scale operator runs ====================
LI_DAILY_SQL = """
li_supp AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS Date,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(*) AS lines
  FROM lineitem GROUP BY 1, 2),
li_part AS (
  SELECT l_partkey, CAST(l_shipdate AS DATE) AS Date,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty
  FROM lineitem GROUP BY 1, 2)
"""


def lineitem_daily(spark: SparkSession, d: str, key: str) -> DataFrame:
    li = S.table(spark, d, "lineitem")
    return li.groupBy(key, F.to_date("l_shipdate").alias("Date")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"), F.count("*").alias("lines"))


@query("lineitem_weekly_delta", W(LI_DAILY_SQL) + """
SELECT s.l_suppkey, s.Date, s.qty - o.qty AS qty_delta, s.lines - o.lines AS lines_delta
FROM li_supp s LEFT JOIN li_supp o ON s.l_suppkey = o.l_suppkey AND s.Date = o.Date + 7""")
def lineitem_weekly_delta(spark: SparkSession, d: str) -> DataFrame:
    daily = lineitem_daily(spark, d, "l_suppkey")
    return period_delta(daily, ["l_suppkey"], ["qty", "lines"]).select(
        "l_suppkey", "Date", "qty_delta", "lines_delta")


@query("lineitem_trailing_mean", W(LI_DAILY_SQL) + """
SELECT l_partkey, Date, qty,
       CASE WHEN count(qty) OVER w = 7 THEN CAST(sum(qty) OVER w AS DOUBLE) / 7 END AS qty_avg
FROM li_part WINDOW w AS (PARTITION BY l_partkey ORDER BY Date
                          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def lineitem_trailing_mean(spark: SparkSession, d: str) -> DataFrame:
    daily = lineitem_daily(spark, d, "l_partkey").drop("lines")
    return trailing_mean(daily, ["l_partkey"], "Date", ["qty"], 7)


FLAGS = ("A", "N", "R")


@query("lineitem_flag_shares", """
SELECT Date, """ + ", ".join(
    f"(CAST(s{f} AS DOUBLE) / NULLIF({' + '.join(f'coalesce(s{g}, 0)' for g in FLAGS)}, 0)) * 100 AS {f}"
    for f in FLAGS) + """
FROM (SELECT CAST(l_shipdate AS DATE) AS Date, """ + ", ".join(
    f"sum(CASE WHEN l_returnflag = '{f}' THEN CAST(l_quantity AS BIGINT) END) AS s{f}" for f in FLAGS)
    + """ FROM lineitem GROUP BY 1)""")
def lineitem_flag_shares(spark: SparkSession, d: str) -> DataFrame:
    li = S.table(spark, d, "lineitem").select(
        F.to_date("l_shipdate").alias("Date"), "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("qty"))
    return share_pivot(li, "Date", "l_returnflag", "qty", FLAGS)
