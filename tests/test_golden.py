"""Whole published tables from the hand-made history, in order, row by row.

The expected rows were worked out by hand from the numbers in
``snapshots_fixture`` and the published column names.
"""

import datetime as dt

from pyspark.sql import functions as F

from cumulus import constants as K
from cumulus.plans import reports as R

from .snapshots_fixture import AS_OF, DATES, dim, history


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_state_table(spark):
    snap = history(spark).filter(F.col("Date") == AS_OF)
    out = R.report_state_table(snap)
    assert out.columns == ["State", "Total Doses Delivered", "Total Doses Administered",
                           "People with 1 Dose per 100k", "People Completely Vaccinated per 100k"]
    assert rows(out) == [
        ("U.S. Total", "345,196", "307,076", "54,900", "132"),
        ("Vermont", "11000", "9000", "83300", "66833"),
        ("Massachusetts", "110800", "98820", "78400", "62757"),
        ("Guam", "2796", "1616", "56100", "45500"),
        ("New York State", "220600", "197640", "54900", "43925")]


def test_state_table_shows_rates_as_they_are(spark):
    snap = history(spark).filter(F.col("Date") == AS_OF).withColumn(
        "Administered_Dose1_Pop_Pct", F.lit(42.8574))
    out = rows(R.report_state_table(snap))
    assert out[0][3] == "42,857"                        # rounded in the total row only
    assert {r[3] for r in out[1:]} == {"42857.4"}


def test_target_table(spark):
    h = history(spark)
    out = R.report_target(h, None, dim(spark), F.lit(AS_OF))
    assert out.columns == ["State", "% Population Fully Immunized",
                           "Doses administered in the last week", "Estimated to 70% Pop 2 Doses"]
    far = AS_OF + dt.timedelta(days=109701)
    assert rows(out) == [
        ("U.S. Total", 0.1, "26,460", far.strftime("%B %Y")),
        ("Massachusetts", 63.0, " 8,820", "August 2021"),
        ("New York State", 44.0, "17,640", "September 2021")]


def test_supply_table(spark):
    out = R.report_supply(history(spark), dim(spark), F.lit(AS_OF))
    assert out.columns == ["State", "People Vaccinated per 100K", "Population", "How far behind",
                           "100% Vaccine Availability Est. Date"]
    assert rows(out) == [
        ("Massachusetts", 62757, 55000, "1-2 months behind", dt.date(2021, 7, 17)),
        ("New York State", 43925, 150000, "2-3 months behind", dt.date(2021, 8, 1))]


def test_map_table(spark):
    out = R.report_map(history(spark).filter(F.col("Date") == AS_OF), dim(spark))
    assert out.columns == ["ID", "% of Currently Eligible Vaccinated", "Total Currently Eligible"]
    assert sorted(rows(out)) == [("Massachusetts", 73.2, 60000), ("New York State", 48.8, 180000),
                                 ("Vermont", 72.9, 5500)]


def test_rolling_table_is_newest_first(spark):
    days = [dt.date(2021, 7, 1) + dt.timedelta(days=i) for i in range(10)]
    df = spark.createDataFrame([(d, "US", 7 * i * i, 70 * i) for i, d in enumerate(days)]
                               + [(days[0], "MA", 1, 1)],
                               "Date date, Location string, Administered_Dose1_Recip long, "
                               "Administered_Dose2_Recip long")
    out = R.report_rolling(df)
    assert out.columns == ["Date", "First Dose Daily Avg", "Second Dose Daily Avg"]
    # increases 7 * (2i - 1); mean of days i-6 .. i is 7 * (2i - 7)
    assert rows(out) == [(days[i], 7.0 * (2 * i - 7), 70.0) for i in (9, 8, 7)]


def test_far_projections_have_a_label_and_a_month(spark):
    """One dose in the week, 5.5 million to go: no calendar cap on either side."""
    h = history(spark)
    slow = h.withColumn("Distributed_Janssen", F.when(F.col("Location") == "MA", F.when(
        F.col("Date") == AS_OF, 1).otherwise(0)).otherwise(F.col("Distributed_Janssen"))) \
        .withColumn("Distributed_Moderna", F.when(F.col("Location") == "MA", 0)
                    .otherwise(F.col("Distributed_Moderna"))) \
        .withColumn("Distributed_Pfizer", F.col("Distributed_Moderna"))

    def label(population):
        d = dim(spark).withColumn("Census2019_18PlusPop_2", F.lit(population).cast("long"))
        out = R.report_supply(slow, d, F.lit(AS_OF)).filter("State = 'Massachusetts'")
        return out.select("How far behind", F.col(
            "`100% Vaccine Availability Est. Date`").isNull().alias("none")).first()

    assert tuple(label(5_500_000)) == ("1 year+", False)
    assert tuple(label(-5_500_000)) == ("Ahead of schedule", False)
    assert tuple(label(10**15)) == ("1 year+", True)       # beyond the date type itself


def test_missing_national_row_is_an_error(spark):
    import pytest
    h = history(spark).filter("Location <> 'US'")
    with pytest.raises(Exception, match="Location = US: 0 rows"):
        R.report_state_table(h.filter(F.col("Date") == AS_OF)).collect()
    with pytest.raises(Exception, match="Location = US: 0 rows"):
        R.report_target(h, None, dim(spark), F.lit(AS_OF)).collect()


def test_total_label_and_dates_are_the_published_ones():
    assert K.TOTAL_LABEL == "U.S. Total" and DATES[-1] == AS_OF
