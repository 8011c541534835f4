"""The eight published tables, each a function of DataFrames and parameters.

Inputs follow ``schemas.SNAPSHOT`` (history = many snapshot dates stacked).
Every report is independent: one failing cannot stop another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions import (add_days, display_string, lateness_of_days, month_label,
                         ne_and_not_null, nonzero, not_in_keep_null, per_capita,
                         round_half_even, safe_div, str_trim, thousands, weighted_sum)
from ..operators.deltas import row_delta, snapshot_pairs
from ..operators.joins import fits_broadcast, join_dim, scalar_value
from ..operators.reshape import normalise_snapshot, rename_columns
from ..operators.rolling import trailing_mean
from ..operators.shares import share_pivot
from ..operators.snapshots import newer_than, resolve_latest
from ..operators.totals import total_row, union_by_name, with_total_row
from ..session import scratch_path
from ..sources.history import append_by_date

D1, D2, J = "Administered_Dose1_Recip", "Administered_Dose2_Recip", "Administered_Janssen"


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back with its schema."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _latest(history: DataFrame, latest):
    """The history's latest date, resolved once per report (one tiny job) so
    every snapshot filter below is a literal partition filter."""
    return resolve_latest(history) if latest is None else latest


# R1 -------------------------------------------------------------------------
def report_history(history: DataFrame, records: DataFrame,
                   names=K.CANONICAL_NAMES) -> DataFrame:
    """History after appending the normalised snapshot once (by date)."""
    return append_by_date(history, normalise_snapshot(records, names))


# R2 -------------------------------------------------------------------------
def report_state_table(snapshot: DataFrame, excluded_codes=K.EXCLUDED_CODES,
                       national_code: str = K.NATIONAL_CODE,
                       national_population=K.NATIONAL_POPULATION,
                       total_label: str = K.TOTAL_LABEL) -> DataFrame:
    """Formatted per-jurisdiction table with a national total row on top.

    Detail: territories kept, federal entities and the national row dropped.
    Total: delivered/administered are sums of the detail rows; the two rates
    come from the national row of the snapshot (scalar subqueries).
    """
    detail = (snapshot.filter(not_in_keep_null("Location", excluded_codes))
              .select("LongName", "Doses_Distributed", "Doses_Administered",
                      (F.col("Administered_Dose1_Pop_Pct") * 1000)
                      .alias("Administered_Dose1_Per_100K"),
                      round_half_even(per_capita(F.col(D2) + F.col(J), "Census2019"))
                      .alias("Complete_Vaccinations_Per_100K")))
    nat = lambda c: scalar_value(snapshot, "Location", national_code, c)
    total = total_row(
        detail, "LongName", total_label, sums=("Doses_Distributed", "Doses_Administered"),
        extra={"Administered_Dose1_Per_100K":
               F.bround(nat("Administered_Dose1_Pop_Pct") * 1000),
               "Complete_Vaccinations_Per_100K":
               F.bround(safe_div(nat(F.col(D2) + F.col(J)), _lit(national_population))
                        * 100000)})
    total = total.select("LongName", *[thousands(c).alias(c) for c in total.columns[1:]],
                         F.lit(None).cast("double").alias("__key"))
    shown = detail.select("LongName",
                          *[display_string(c).alias(c) for c in detail.columns[1:]],
                          F.col("Complete_Vaccinations_Per_100K").alias("__key"))
    out = with_total_row(total, shown, group_col="__grp")
    out = out.orderBy("__grp", F.col("__key").desc_nulls_last(), "LongName")
    return rename_columns(out.drop("__grp", "__key"), K.STATE_TABLE_NAMES)


# R3 -------------------------------------------------------------------------
def report_map(snapshot: DataFrame, dim: DataFrame, dim_key: str = "postal_code") -> DataFrame:
    """Share of the eligible population fully vaccinated, states only."""
    s = snapshot.withColumn("Complete_Vaccinations", F.bround(F.col(D2) + F.col(J)))
    j = join_dim(s, dim, "Location", dim_key)
    out = j.select("LongName",
                   round_half_even(per_capita("Complete_Vaccinations",
                                              "Census2019_12PlusPop", 100), 1)
                   .alias("pct_eligible_vaccinated"),
                   "Census2019_12PlusPop")
    return rename_columns(out, K.MAP_NAMES)


# R4 + R4t -------------------------------------------------------------------
def week_frame(history: DataFrame, period_days: int = K.PERIOD_DAYS, latest=None) -> DataFrame:
    """What the projections need of the two snapshots, from one scan of them:
    every row of the latest with its weekly change."""
    courses = weighted_sum([("Distributed_Moderna", 2), ("Distributed_Pfizer", 2),
                            ("Distributed_Janssen", 1)])
    return snapshot_pairs(history.withColumn("courses", courses), ["Location"],
                          ["LongName", "Census2019", D2, J],
                          ["Doses_Administered", D1, "courses"], days=period_days,
                          latest=_latest(history, latest))


def _target_days(share, period_days: int, lag_days: int, people, first, pace) -> Column:
    """Days until ``share`` of the people have their second dose."""
    return F.bround(safe_div(people * F.lit(share) - first, pace) * period_days + lag_days)


def target_detail(history: DataFrame, dim: DataFrame, as_of,
                  excluded_names=K.EXCLUDED_NAMES, share: float = K.TARGET_SHARE,
                  period_days: int = K.PERIOD_DAYS,
                  lag_days: int = K.SECOND_DOSE_LAG_DAYS,
                  dim_key: str = "postal_code", latest=None, frame=None) -> DataFrame:
    """Numeric rows of the target projection, one per state with activity."""
    frame = week_frame(history, period_days, latest) if frame is None else frame
    d = frame.filter(not_in_keep_null("LongName", excluded_names)
                     & nonzero("Doses_Administered_delta"))
    return _target_rows(join_dim(d, dim, "Location", dim_key), as_of, share, period_days, lag_days)


def _target_rows(j: DataFrame, as_of, share, period_days, lag_days) -> DataFrame:
    days = _target_days(share, period_days, lag_days, F.col("Census2019"), F.col(D1),
                        F.col(D1 + "_delta"))
    return j.select(
        "LongName",
        F.bround(per_capita(F.col(D2) + F.col(J), "Census2019", 100)).alias("pct_fully"),
        F.col("Doses_Administered_delta").alias("doses_last_week"),
        days.alias("sort_days")).withColumn("target_month", month_label(add_days(_lit(as_of),
                                                                                 "sort_days")))


def report_target(history: DataFrame, snapshot: DataFrame, dim: DataFrame, as_of,
                  excluded_names=K.EXCLUDED_NAMES, share: float = K.TARGET_SHARE,
                  period_days: int = K.PERIOD_DAYS,
                  lag_days: int = K.SECOND_DOSE_LAG_DAYS,
                  national_code: str = K.NATIONAL_CODE,
                  national_population=K.NATIONAL_POPULATION,
                  total_label: str = K.TOTAL_LABEL, dim_key: str = "postal_code",
                  latest=None) -> DataFrame:
    """Projected month for reaching ``share`` fully vaccinated, with a total row.

    Total row: its first-dose pace sums the weekly deltas of every
    non-excluded entity (no dimension join), its doses figure sums the detail
    rows, its rates use the national row, which must be there, and
    ``national_population`` (None: that row's own).  ``snapshot`` is not needed any more
    (the two snapshots of the history hold all).

    The two snapshots are scanned and paired once: what they give, one row per
    jurisdiction, is written to the shared folder, and read for the detail rows, the total
    row and the padding's width.
    """
    frame = week_frame(history, period_days, latest)
    codes = dim.groupBy(F.col(dim_key).alias("__code")).agg(F.count(F.lit(1)).alias("__copies"))
    codes = F.broadcast(codes) if fits_broadcast(codes) else codes
    rows = _stored(frame.join(codes, F.col("Location") == F.col("__code"), "left").select(
        "LongName", "Census2019", D1, D2, J, "Doses_Administered_delta", D1 + "_delta", "__copies",
        (F.col("Location") == F.lit(national_code)).alias("__national")), "report_target")
    counted = not_in_keep_null("LongName", excluded_names)
    listed = (counted & nonzero("Doses_Administered_delta") & F.col("__copies").isNotNull())
    detail = _target_rows(rows.filter(listed).withColumn(
        "__copy", F.explode(F.expr("sequence(1, __copies)"))), as_of, share, period_days, lag_days)
    doses, national = F.when(listed, F.col("Doses_Administered_delta")), F.col("__national")
    sums = rows.agg(
        F.count(F.when(national, 1)).alias("n"),
        F.sum(F.when(counted, F.col(D1 + "_delta"))).alias("pace"),
        F.sum(doses * F.col("__copies")).alias("doses"),
        F.max(F.when(national, F.col(D1))).alias("first"),
        F.max(F.when(national, F.col("Census2019"))).alias("people"),
        F.max(F.when(national, F.col(D2) + F.col(J))).alias("fully"))
    wrong = F.raise_error(F.format_string(f"Location = {national_code}: %d rows, not one",
                                          F.col("n"))).cast("long")
    pop = F.col("people") if national_population is None else _lit(national_population)
    total = (sums.withColumn("first", F.when(F.col("n") == 1, F.col("first")).otherwise(wrong))
             .select(F.lit(total_label).alias("LongName"),
                     round_half_even(safe_div("fully", pop) * 100, 1).alias("pct_fully"),
                     thousands("doses").alias("doses_last_week"),
                     _target_days(share, period_days, lag_days, pop, F.col("first"), F.col("pace"))
                     .alias("__days"))
             .select("LongName", "pct_fully", "doses_last_week",
                     month_label(add_days(_lit(as_of), "__days")).alias("target_month"),
                     F.lit(None).cast("double").alias("sort_days")))
    width = rows.select(F.max(F.length(thousands(doses)))).scalar()
    shown = detail.withColumn("doses_last_week", F.lpad(thousands("doses_last_week"), width, " "))
    out = with_total_row(total, shown.select(*total.columns), group_col="__grp")
    out = out.orderBy("__grp", F.col("sort_days").asc_nulls_last(), "LongName")
    return rename_columns(out.drop("__grp", "sort_days"), K.TARGET_NAMES)


# R5 -------------------------------------------------------------------------
def report_supply(history: DataFrame, dim: DataFrame, as_of, goal=K.GOAL_DATE,
                  excluded_names=K.EXCLUDED_NAMES_SUPPLY, period_days: int = K.PERIOD_DAYS,
                  dim_key: str = "postal_code", latest=None) -> DataFrame:
    """Projected date of full vaccine availability and how late that is."""
    d = week_frame(history, period_days, latest).filter(
        not_in_keep_null("LongName", excluded_names) & nonzero("courses_delta"))
    j = join_dim(d, dim, "Location", dim_key)
    days = safe_div(F.col("Census2019_18PlusPop_2") - F.col("courses"),
                    F.col("courses_delta")) * period_days
    j = j.withColumn("days", days).withColumn("availability_date", add_days(_lit(as_of), days))
    out = j.select(
        "LongName",
        F.bround(per_capita(F.col(D2) + F.col(J), "Census2019")).cast("bigint")
        .alias("Complete_Vaccinations_Per_100K"),
        "Census2019_18PlusPop_2",
        lateness_of_days("days", _lit(as_of), goal).alias("lateness"),
        "availability_date", "days")
    out = out.orderBy(F.col("days").asc_nulls_last(), "LongName").drop("days")
    return rename_columns(out, K.SUPPLY_NAMES)


# R6 -------------------------------------------------------------------------
def report_rolling(history: DataFrame, national_code: str = K.NATIONAL_CODE,
                   k: int = 7) -> DataFrame:
    """7-row trailing mean of day-over-day first/second dose growth."""
    s = history.filter(F.col("Location") == national_code).select("Location", "Date", D1, D2)
    s = row_delta(s, ["Location"], "Date", [D1, D2])
    s = trailing_mean(s, ["Location"], "Date", [D1 + "_diff", D2 + "_diff"], k)
    out = (s.select("Date", F.col(D1 + "_diff_avg").alias("first_avg"),
                    F.col(D2 + "_diff_avg").alias("second_avg"))
            .filter(F.col("first_avg").isNotNull())
            .orderBy(F.col("Date").desc()))
    return rename_columns(out, K.ROLLING_NAMES)


# R7 -------------------------------------------------------------------------
def report_county(records: DataFrame, unknown: str = "UNK") -> DataFrame:
    """County rows with a known code and a complete-series share."""
    r = records.select("Date", "FIPS", "StateName", "StateAbbr", "County",
                       "Series_Complete_Pop_Pct", "Administered_Dose1_Pop_Pct")
    r = (r.filter(ne_and_not_null("FIPS", unknown, "Series_Complete_Pop_Pct"))
          .withColumn("Date", F.to_date("Date"))
          .withColumn("StateAbbr", str_trim("StateAbbr")))
    return rename_columns(r, K.COUNTY_NAMES)


# R8 -------------------------------------------------------------------------
def age_share_updates(feed: DataFrame, history: DataFrame, categories=K.AGE_CATEGORIES,
                      label_pattern: str = K.BAND_LABEL_PATTERN, date_col: str = "date",
                      category_col: str = "demographic_category",
                      value_col: str = "series_complete_yes",
                      history_date_col: str = "Date") -> DataFrame:
    """New share rows: per-band daily increase as a share of the day's total.

    The daily difference runs over the whole feed first (so the first new day
    has its predecessor), then only days newer than the history are kept.
    """
    f = (feed.select(F.to_date(date_col).alias(date_col), category_col, value_col)
             .filter(F.col(category_col).isin(list(categories))))
    d = row_delta(f, [category_col], date_col, [value_col], suffix="_diff")
    d = d.filter(F.col(value_col + "_diff").isNotNull())
    d = newer_than(d, history, date_col, history_date_col)
    return share_pivot(d, date_col, category_col, value_col + "_diff", categories,
                       100.0, label_pattern, id_alias=history_date_col)


def report_age_share(feed: DataFrame, history: DataFrame, **kw) -> DataFrame:
    """Share history with the new days appended (no-op when none are new)."""
    new = age_share_updates(feed, history, **kw)
    return union_by_name(history, new)


__all__ = ["normalise_snapshot", "report_history", "report_state_table", "report_map",
           "target_detail", "report_target", "report_supply", "report_rolling",
           "report_county", "age_share_updates", "report_age_share"]
