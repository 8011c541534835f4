import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulus import constants as K
from cumulus.functions import lateness_label, parse_thousands
from cumulus.plans import reports as R

from .snapshots_fixture import AS_OF, DATES, dim, history


def latest(spark):
    h = history(spark)
    return h, h.filter(F.col("Date") == DATES[-1])


def test_state_table_total_is_sum_of_detail(spark):
    _, snap = latest(spark)
    out = R.report_state_table(snap).collect()
    names = [r["State"] for r in out]
    assert names[0] == K.TOTAL_LABEL
    assert "Bureau of Prisons" not in names and "United States" not in names
    assert "Guam" in names                                 # territories kept here
    det = out[1:]
    total = out[0]
    assert int(total["Total Doses Delivered"].replace(",", "")) == sum(
        int(r["Total Doses Delivered"]) for r in det)
    # detail sorted by completion rate, descending
    rates = [int(r["People Completely Vaccinated per 100k"]) for r in det]
    assert rates == sorted(rates, reverse=True)


def test_map_drops_rows_without_dimension(spark):
    _, snap = latest(spark)
    out = {r["ID"]: r for r in R.report_map(snap, dim(spark)).collect()}
    assert set(out) == {"Massachusetts", "Vermont", "New York State"}
    d1 = 50000 + 700 * 7
    assert out["Massachusetts"]["% of Currently Eligible Vaccinated"] == round(
        (int(d1 * 0.8) + 10) / 60000 * 100, 1) == 73.2


def test_target_report(spark):
    h, snap = latest(spark)
    out = R.report_target(h, snap, dim(spark), F.lit(AS_OF)).collect()
    total, det = out[0], out[1:]
    assert total["State"] == K.TOTAL_LABEL
    # Vermont has no doses this week: dropped; Guam has no dimension row: dropped
    assert {r["State"] for r in det} == {"Massachusetts", "New York State"}
    parsed = spark.createDataFrame([(r["Doses administered in the last week"],) for r in det], "s string")
    s = parsed.select(F.sum(parse_thousands("s"))).first()[0]
    assert int(total["Doses administered in the last week"].replace(",", "")) == s
    widths = {len(r["Doses administered in the last week"]) for r in det}
    assert len(widths) == 1                                   # padded to one width
    assert {r["Estimated to 70% Pop 2 Doses"] for r in det} == {"August 2021", "September 2021"}
    assert total["Estimated to 70% Pop 2 Doses"].endswith("2321")   # far, but a date


def test_supply_label_follows_date(spark):
    h, _ = latest(spark)
    out = R.report_supply(h, dim(spark), F.lit(AS_OF))
    chk = out.withColumn("re", lateness_label(F.col("`100% Vaccine Availability Est. Date`")))
    rows = chk.collect()
    assert rows and all(r["re"] == r["How far behind"] for r in rows)
    dates = [r["100% Vaccine Availability Est. Date"] for r in rows]
    assert dates == sorted(dates)


def test_rolling_counts_rows(spark):
    rows = []
    for i in range(12):
        if i == 4:
            continue                                           # a missing day
        d = dt.date(2021, 7, 1) + dt.timedelta(days=i)
        rows.append((d, "US", i * 10, i * 5))
    df = spark.createDataFrame(rows, "Date date, Location string, "
                                     "Administered_Dose1_Recip long, Administered_Dose2_Recip long")
    out = R.report_rolling(df).collect()
    assert len(out) == 11 - 7
    assert out[0]["First Dose Daily Avg"] == pytest.approx(
        (110 - 30) / 7)            # 7 row-diffs span 9 days: day 4 is missing


def test_county_report(spark):
    recs = spark.createDataFrame(
        [("2021-07-21", "25001", "Massachusetts", " MA ", "Barnstable", 60.0, 70.0),
         ("2021-07-21", "UNK", "Massachusetts", "MA", "Unknown", 10.0, 20.0),
         ("2021-07-21", "25003", "Massachusetts", "MA", "Berkshire", None, 50.0)],
        "Date string, FIPS string, StateName string, StateAbbr string, County string, "
        "Series_Complete_Pop_Pct double, Administered_Dose1_Pop_Pct double")
    out = R.report_county(recs).collect()
    assert len(out) == 1 and out[0]["FIPS-Code"] == "25001" and out[0]["StateAbbr"] == "MA"


def _age_feed(spark, days):
    rows = []
    for i in range(days):
        d = dt.datetime(2021, 7, 1) + dt.timedelta(days=i)
        for j, c in enumerate(K.AGE_CATEGORIES):
            rows.append((d, c, (j + 1) * i * i))
    return spark.createDataFrame(rows, "date timestamp_ntz, demographic_category string, "
                                       "series_complete_yes long")


def test_age_share_rows_sum_to_100_and_first_new_day_kept(spark):
    feed = _age_feed(spark, 10)
    from cumulus.schemas import share_history
    hist = spark.createDataFrame([(dt.date(2021, 7, 5),) + (None,) * 7], share_history())
    out = R.report_age_share(feed, hist).filter(F.col("Date") > dt.date(2021, 7, 5)).collect()
    assert [r.Date.day for r in out] == [6, 7, 8, 9, 10] or len(out) == 5
    for r in out:
        vals = [r[c] for c in r.asDict() if c != "Date" and r[c] is not None]
        assert sum(vals) == pytest.approx(100.0)


def test_age_share_no_new_dates_is_noop(spark):
    from cumulus.schemas import share_history
    feed = _age_feed(spark, 5)
    hist = spark.createDataFrame([(dt.date(2021, 7, 30),) + (1.0,) * 7], share_history())
    out = R.report_age_share(feed, hist)
    assert out.count() == 1 and "18-24" in out.columns


def test_zero_first_dose_pace_gives_null_date_sorted_last(spark):
    from cumulus.schemas import SNAPSHOT
    rows = []
    for d, k in ((DATES[0], 0), (DATES[-1], 7)):
        # MA: first doses flat, second doses still moving (doses change, pace 0)
        rows.append((d, "MA", "Massachusetts", 70000, 60000, 0, 50000 + 100 * k, 30000,
                     20000 + 100 * k, 0, 42.9, 0, 0, 0))
        rows.append((d, "NY", "New York", 200000, 180000, 0, 100000 + 700 * k, 100000 + 700 * k,
                     0, 0, 50.0, 0, 0, 0))
    h = spark.createDataFrame(rows, SNAPSHOT)
    det = R.target_detail(h, dim(spark), F.lit(AS_OF)).orderBy(
        F.col("sort_days").asc_nulls_last(), "LongName").collect()
    assert [r.LongName for r in det] == ["New York", "Massachusetts"]
    assert det[1].target_month is None and det[1].sort_days is None


def test_nonzero_drops_zero_and_null(spark):
    from cumulus.functions import nonzero
    df = spark.createDataFrame([(0,), (None,), (5,), (-2,)], "d long")
    assert sorted(r.d for r in df.filter(nonzero("d")).collect()) == [-2, 5]
