"""Snapshot-shaped inputs derived by Spark from the driver's tables.

The driver tables hold no vaccination data, so the report shapes are mapped:

* jurisdiction panel — customer nation × order date, cumulative counts built
  from orders ⋈ lineitem ⋈ customer; densified so each nation has a row for
  every day from its first order to the last order date of the table.  A
  parent row (code ``US``) per date is the sum over all nations.
* state dimension — ``nation`` ⋈ ``region`` with customer counts; nations of
  the MIDDLE EAST region are left out, so they behave like territories (kept
  by the state table, dropped by the dimension join).
* category feed — events per day and value band, cumulative per band.
* county feed — one record per customer.

Everything grows with the tables; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import band_label, safe_div
from ..operators.reshape import cumulative_panel

# ---- stand-in parameters ----------------------------------------------------
PEOPLE_PER_CUSTOMER = 20          # population = 20 × customers of the nation
ADULTS_PER_CUSTOMER = 40          # dimension adult population weight
TERRITORY_REGION = "MIDDLE EAST"  # nations of this region are not in the dimension
EXCLUDED_CODES = ("03", "08", "US")
EXCLUDED_NAMES = ("NATION_3", "NATION_8", "United States")
EXCLUDED_NAMES_SUPPLY = ("NATION_3", "NATION_8")
CANONICAL_NAMES = {"NATION_1": "NATION ONE"}
PARENT_CODE, PARENT_NAME = "US", "United States"
VALUE_BAND_EDGES = (0, 10, 25, 40, 50, 65, 75)
BAND_PREFIX, BAND_SUFFIX = "Ages_", "_yrs"
# ------------------------------------------------------------------------------

MEASURES = ["Doses_Distributed", "Doses_Administered", "Administered_Dose1_Recip",
            "Administered_Dose2_Recip", "Administered_Janssen", "Distributed_Moderna",
            "Distributed_Pfizer", "Distributed_Janssen"]
SNAPSHOT_COLS = ["Date", "Location", "LongName", "Census2019", "Census2019_12PlusPop",
                 "Doses_Distributed", "Doses_Administered", "Administered_Dose1_Recip",
                 "Administered_Dose2_Recip", "Administered_Janssen",
                 "Administered_Dose1_Pop_Pct", "Distributed_Moderna",
                 "Distributed_Pfizer", "Distributed_Janssen"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    """A driver table, read with its declared schema (no inference job)."""
    from ..schemas import DRIVER_TABLES
    reader = spark.read
    if name in DRIVER_TABLES:
        reader = reader.schema(DRIVER_TABLES[name])
    return reader.parquet(f"{d}/{name}.parquet")


def _code(c) -> "F.Column":
    return F.lpad(F.col(c).cast("string"), 2, "0")


def band_names(edges=VALUE_BAND_EDGES, prefix=BAND_PREFIX, suffix=BAND_SUFFIX):
    out = []
    for i, lo in enumerate(edges):
        hi = edges[i + 1] if i + 1 < len(edges) else None
        out.append(f"{prefix}{lo:02d}-{hi - 1:02d}{suffix}" if hi is not None
                   else f"{prefix}{lo:02d}+{suffix}")
    return out


def nation_daily(spark: SparkSession, d: str) -> DataFrame:
    """Per nation and order date: the day's increments of every measure, plus
    the parent row (all nations) per date from the same pass (grouping sets).

    lineitem is reduced to one row per order before it meets ``orders`` (the
    aggregation's shuffle on the order key also serves the join).
    """
    li = table(spark, d, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.count("*").alias("items"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("qty"),
        *[F.sum(F.when(F.col("l_returnflag") == f, 1).otherwise(0)).alias(f"items_{f}")
          for f in ("A", "R", "N")])
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         "o_orderpriority",
                                         F.to_date("o_orderdate").alias("Date"))
    done = F.col("o_orderstatus") == "F"
    # Orders are summed per (customer, day) before they meet ``customer``: a
    # customer with a third of all orders is one row per day at the join.
    per_cust_day = (o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
                     .groupBy("o_custkey", "Date").agg(
                         F.sum("qty").alias("qty"), F.sum("items").alias("items"),
                         F.count("*").alias("n_orders"),
                         F.sum(F.when(done, 1).otherwise(0)).alias("n_done"),
                         F.sum(F.when((F.col("o_orderpriority") == "1-URGENT") & ~done, 1)
                               .otherwise(0)).alias("n_urgent"),
                         *[F.sum(f"items_{f}").alias(f"items_{f}") for f in ("A", "R", "N")]))
    c = table(spark, d, "customer").select("c_custkey", _code("c_nationkey").alias("Location"))
    j = per_cust_day.join(c, per_cust_day.o_custkey == c.c_custkey)
    # one pass, two grouping sets: (day, nation) and (day) = the parent row
    agg = j.groupingSets([["Date", "Location"], ["Date"]], "Date", "Location").agg(
        F.grouping("Location").alias("__gl"),
        F.sum("qty").alias("Doses_Distributed"),
        F.sum("items").alias("Doses_Administered"),
        F.sum("n_orders").alias("Administered_Dose1_Recip"),
        F.sum("n_done").alias("Administered_Dose2_Recip"),
        F.sum("n_urgent").alias("Administered_Janssen"),
        F.sum("items_A").alias("Distributed_Moderna"),
        F.sum("items_R").alias("Distributed_Pfizer"),
        F.sum("items_N").alias("Distributed_Janssen"))
    return (agg.withColumn("Location", F.when(F.col("__gl") == 1, F.lit(PARENT_CODE))
                                        .otherwise(F.col("Location")))
               .drop("__gl"))


def nation_population(spark: SparkSession, d: str) -> DataFrame:
    """Population per nation plus the parent total (``rollup``)."""
    c = table(spark, d, "customer").select(_code("c_nationkey").alias("Location"), "c_acctbal")
    agg = c.rollup("Location").agg(
        F.grouping("Location").alias("__gl"),
        (F.count("*") * PEOPLE_PER_CUSTOMER).alias("Census2019"),
        (F.sum(F.when(F.col("c_acctbal") > 0, 1).otherwise(0)) * PEOPLE_PER_CUSTOMER)
        .alias("Census2019_12PlusPop"))
    return (agg.withColumn("Location", F.when(F.col("__gl") == 1, F.lit(PARENT_CODE))
                                        .otherwise(F.col("Location")))
               .drop("__gl"))


def nation_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """The jurisdiction history (``schemas.SNAPSHOT`` columns).

    One pass over the raw tables (the daily increments are stored, then
    densified); the panel is keys × days, independent of the number of
    orders.  The two lookups are per-nation tables (25 rows by the TPC-H
    definition of ``nation``, plus the parent row).
    """
    # The daily increments are read twice (latest day, running sums); they are
    # small (nations × active days), so they are stored once rather than
    # recomputed from the raw joins.
    cum = cumulative_panel(stored(nation_daily(spark, d), "nation_daily"), ["Location"],
                           "Date", MEASURES)
    names = (table(spark, d, "nation")
             .select(_code("n_nationkey").alias("Location"), F.col("n_name").alias("LongName"))
             .unionByName(spark.range(1).select(F.lit(PARENT_CODE).alias("Location"),
                                                F.lit(PARENT_NAME).alias("LongName"))))
    # No broadcast hints: both lookups are per-nation tables, so the planner
    # broadcasts them from their estimated (or, under AQE, measured) size,
    # and would keep a shuffle join if they ever outgrew the threshold.
    rows = (cum.join(names, "Location")
               .join(nation_population(spark, d), "Location"))
    rows = rows.withColumn("Administered_Dose1_Pop_Pct",
                           F.bround(safe_div(F.col("Administered_Dose1_Recip") * 1000000,
                                             "Census2019")) / 10000)
    return rows.select(*SNAPSHOT_COLS)


def stored(df: DataFrame, name: str = "derived", sort_by: str | None = "Date") -> DataFrame:
    """Cut lineage: write ``df`` once as a Parquet table in a fresh folder
    under the session's shared checkpoint dir (``spark.checkpoint.dir``) and
    read it back.

    Unlike an eager RDD ``checkpoint()`` (one job to count, a second that
    recomputes the plan to write it), this is a single pass, and readers get
    column pruning and filter pushdown.  Each task's rows are sorted by
    ``sort_by`` (no shuffle), so a filter on that column skips row groups.
    Task retries are handled by the file commit protocol; a rerun writes a new
    folder.
    """
    from ..session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    out = df.sortWithinPartitions(sort_by) if sort_by and sort_by in df.columns else df
    out.write.mode("errorifexists").parquet(path)
    # read back with the schema just written (no footer-inference job)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    return spark.read.schema(schema).parquet(path)


def nation_history(spark: SparkSession, d: str) -> DataFrame:
    """The jurisdiction history, derived once and stored (lineage cut)."""
    return stored(nation_snapshots(spark, d), "nation_history")


def latest_snapshot(history: DataFrame) -> DataFrame:
    from ..operators.snapshots import resolve_latest
    return history.filter(F.col("Date") == F.lit(resolve_latest(history)))


def nation_dim(spark: SparkSession, d: str) -> DataFrame:
    """State dimension stand-in (``schemas.POPULATION`` columns)."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    c = table(spark, d, "customer").groupBy("c_nationkey").agg(
        F.count("*").alias("n_cust"),
        F.sum(F.when(F.col("c_mktsegment") != "HOUSEHOLD", 1).otherwise(0)).alias("n_adult"))
    nr = (n.join(r, n.n_regionkey == r.r_regionkey)
           .filter(F.col("r_name") != TERRITORY_REGION))
    j = nr.join(c, nr.n_nationkey == c.c_nationkey, "left")
    return j.select(
        F.col("n_name").alias("Geographic_Area_Name"),
        (F.coalesce(F.col("n_cust"), F.lit(0)) * PEOPLE_PER_CUSTOMER).alias("Census2019_2"),
        (F.coalesce(F.col("n_adult"), F.lit(0)) * ADULTS_PER_CUSTOMER)
        .alias("Census2019_18PlusPop_2"),
        _code("n_nationkey").alias("postal_code"),
        F.col("n_nationkey").alias("fips_code"))


def fips_dim(spark: SparkSession, d: str) -> DataFrame:
    """Name → code dimension over every nation (``schemas.FIPS`` columns)."""
    return table(spark, d, "nation").select(F.col("n_name").alias("name"),
                                            _code("n_nationkey").alias("postal_code"),
                                            F.col("n_nationkey").alias("fips_code"))


def events_panel(spark: SparkSession, d: str) -> DataFrame:
    """Event type × day, cumulative event count and value (in cents)."""
    ev = table(spark, d, "events")
    daily = ev.groupBy(F.to_date("ts").alias("Date"), F.col("event_type").alias("Location")).agg(
        F.count("*").alias("events"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("value_cents"))
    return cumulative_panel(daily, ["Location"], "Date", ["events", "value_cents"])


def events_last_day(spark: SparkSession, d: str) -> "F.Column":
    """The events panel's last day as a scalar subquery over the raw table.

    Equal to max(Date) of ``events_panel`` (the panel runs to the last event
    day), but one pruned column scan with a partial max per task, instead of
    rebuilding the panel (aggregate, window, explode) inside the subquery.
    """
    return table(spark, d, "events").select(F.max(F.to_date("ts"))).scalar()


def band_feed(spark: SparkSession, d: str) -> DataFrame:
    """Category feed stand-in: cumulative events per value band and day."""
    ev = table(spark, d, "events")
    daily = ev.groupBy(F.to_date("ts").alias("date"),
                       band_label("value", VALUE_BAND_EDGES, BAND_PREFIX, BAND_SUFFIX)
                       .alias("demographic_category")).agg(F.count("*").alias("n"))
    cum = cumulative_panel(daily, ["demographic_category"], "date", ["n"])
    return cum.select("date", "demographic_category",
                      F.col("n").alias("series_complete_yes"))


def county_records(spark: SparkSession, d: str) -> DataFrame:
    """County feed stand-in: one record per customer (``schemas.COUNTY_RECORD``)."""
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    last = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.max(F.to_date("o_orderdate")).alias("last_d"))
    j = (c.join(n, c.c_nationkey == n.n_nationkey)
          .join(last, c.c_custkey == last.o_custkey, "left"))
    return j.select(
        F.date_format("last_d", "yyyy-MM-dd").alias("Date"),
        F.when(F.col("c_acctbal") < 0, F.lit("UNK"))
         .otherwise(F.col("c_custkey").cast("string")).alias("FIPS"),
        F.col("n_name").alias("StateName"),
        F.rpad(_code("c_nationkey"), 4, " ").alias("StateAbbr"),
        F.col("c_name").alias("County"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_acctbal") / 100)
         .alias("Series_Complete_Pop_Pct"),
        (F.col("c_acctbal") / 50).alias("Administered_Dose1_Pop_Pct"),
        F.col("c_custkey"))


# ---- the same derivations as DuckDB SQL (oracle side) -------------------------
def _sum_bigint(expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT)"


NATION_SQL = f"""
li_o AS (
  SELECT l_orderkey, count(*) AS items, sum(CAST(l_quantity AS BIGINT)) AS qty,
         sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS items_a,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS items_r,
         sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS items_n
  FROM lineitem GROUP BY l_orderkey),
nd AS MATERIALIZED (
  SELECT lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS Location,
         CAST(o.o_orderdate AS DATE) AS Date,
         sum(p.qty) AS Doses_Distributed, sum(p.items) AS Doses_Administered,
         count(*) AS Administered_Dose1_Recip,
         sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS Administered_Dose2_Recip,
         sum(CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderstatus <> 'F'
                  THEN 1 ELSE 0 END) AS Administered_Janssen,
         sum(p.items_a) AS Distributed_Moderna, sum(p.items_r) AS Distributed_Pfizer,
         sum(p.items_n) AS Distributed_Janssen
  FROM orders o LEFT JOIN li_o p ON o.o_orderkey = p.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2),
ngrid AS (
  SELECT Location, CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP),
         CAST((SELECT max(Date) FROM nd) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS Date
  FROM (SELECT Location, min(Date) AS d0 FROM nd GROUP BY 1)),
ncum AS MATERIALIZED (
  SELECT g.Location, g.Date,
  {", ".join(f"CAST(sum(coalesce(nd.{m}, 0)) OVER w AS BIGINT) AS {m}" for m in MEASURES)}
  FROM ngrid g LEFT JOIN nd ON g.Location = nd.Location AND g.Date = nd.Date
  WINDOW w AS (PARTITION BY g.Location ORDER BY g.Date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
npop AS (
  SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS Location,
         CAST(count(*) * {PEOPLE_PER_CUSTOMER} AS BIGINT) AS Census2019,
         CAST(sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) * {PEOPLE_PER_CUSTOMER} AS BIGINT)
           AS Census2019_12PlusPop
  FROM customer GROUP BY 1
  UNION ALL
  SELECT '{PARENT_CODE}', CAST(count(*) * {PEOPLE_PER_CUSTOMER} AS BIGINT),
         CAST(sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) * {PEOPLE_PER_CUSTOMER} AS BIGINT)
  FROM customer),
nrows AS (
  SELECT c.Date, c.Location, n.n_name AS LongName, p.Census2019, p.Census2019_12PlusPop,
         {", ".join("c." + m for m in MEASURES)}
  FROM ncum c JOIN nation n ON c.Location = lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')
  JOIN npop p ON c.Location = p.Location),
nboth AS (
  SELECT * FROM nrows
  UNION ALL
  SELECT t.Date, '{PARENT_CODE}' AS Location, '{PARENT_NAME}' AS LongName,
         p.Census2019, p.Census2019_12PlusPop, {", ".join("t." + m for m in MEASURES)}
  FROM (SELECT Date, {", ".join(_sum_bigint(m) + " AS " + m for m in MEASURES)}
        FROM nrows GROUP BY Date) t
  JOIN npop p ON p.Location = '{PARENT_CODE}'),
snap AS MATERIALIZED (
  SELECT Date, Location, LongName, Census2019, Census2019_12PlusPop, Doses_Distributed,
         Doses_Administered, Administered_Dose1_Recip, Administered_Dose2_Recip,
         Administered_Janssen,
         round_even(CAST(Administered_Dose1_Recip * 1000000 AS DOUBLE) / NULLIF(Census2019, 0), 0)
           / 10000 AS Administered_Dose1_Pop_Pct,
         Distributed_Moderna, Distributed_Pfizer, Distributed_Janssen
  FROM nboth),
latest AS (SELECT * FROM snap WHERE Date = (SELECT max(Date) FROM snap)),
dim AS (
  SELECT n.n_name AS Geographic_Area_Name,
         CAST(coalesce(cc.n_cust, 0) * {PEOPLE_PER_CUSTOMER} AS BIGINT) AS Census2019_2,
         CAST(coalesce(cc.n_adult, 0) * {ADULTS_PER_CUSTOMER} AS BIGINT) AS Census2019_18PlusPop_2,
         lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS postal_code,
         n.n_nationkey AS fips_code
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT c_nationkey, count(*) AS n_cust,
                    sum(CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 1 ELSE 0 END) AS n_adult
             FROM customer GROUP BY 1) cc ON n.n_nationkey = cc.c_nationkey
  WHERE r.r_name <> '{TERRITORY_REGION}')
"""


def _band_case(col: str) -> str:
    arms = []
    edges = VALUE_BAND_EDGES
    for i, (lo, name) in enumerate(zip(edges, band_names())):
        hi = edges[i + 1] if i + 1 < len(edges) else None
        cond = f"{col} >= {lo} AND {col} < {hi}" if hi is not None else f"{col} >= {lo}"
        arms.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(arms) + " END"


EVENTS_SQL = """
ed AS (
  SELECT CAST(ts AS DATE) AS Date, event_type AS Location, count(*) AS events,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents
  FROM events GROUP BY 1, 2),
egrid AS (
  SELECT Location, CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP),
         CAST((SELECT max(Date) FROM ed) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS Date
  FROM (SELECT Location, min(Date) AS d0 FROM ed GROUP BY 1)),
epanel AS (
  SELECT g.Location, g.Date,
         CAST(sum(coalesce(ed.events, 0)) OVER w AS BIGINT) AS events,
         CAST(sum(coalesce(ed.value_cents, 0)) OVER w AS BIGINT) AS value_cents
  FROM egrid g LEFT JOIN ed ON g.Location = ed.Location AND g.Date = ed.Date
  WINDOW w AS (PARTITION BY g.Location ORDER BY g.Date
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""

FEED_SQL = f"""
bd AS (
  SELECT CAST(ts AS DATE) AS date, {_band_case('value')} AS demographic_category,
         count(*) AS n
  FROM events GROUP BY 1, 2),
bgrid AS (
  SELECT demographic_category, CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP),
         CAST((SELECT max(date) FROM bd) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT demographic_category, min(date) AS d0 FROM bd GROUP BY 1)),
feed AS (
  SELECT g.date, g.demographic_category,
         CAST(sum(coalesce(bd.n, 0)) OVER (PARTITION BY g.demographic_category ORDER BY g.date
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS series_complete_yes
  FROM bgrid g LEFT JOIN bd ON g.demographic_category IS NOT DISTINCT FROM bd.demographic_category
       AND g.date = bd.date)
"""

COUNTY_SQL = """
county AS (
  SELECT strftime(l.last_d, '%Y-%m-%d') AS Date,
         CASE WHEN c.c_acctbal < 0 THEN 'UNK' ELSE CAST(c.c_custkey AS VARCHAR) END AS FIPS,
         n.n_name AS StateName,
         rpad(lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0'), 4, ' ') AS StateAbbr,
         c.c_name AS County,
         CASE WHEN c.c_mktsegment <> 'HOUSEHOLD' THEN c.c_acctbal / 100 END
           AS Series_Complete_Pop_Pct,
         c.c_acctbal / 50 AS Administered_Dose1_Pop_Pct,
         c.c_custkey
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_d
             FROM orders GROUP BY 1) l ON c.c_custkey = l.o_custkey)
"""
