import datetime as dt
import os

from pyspark.sql import functions as F

from cumulus import constants as K, schemas
from cumulus.plans.daily_run import DailyInputs, run_daily
from cumulus.sources.files import read_csv_typed, write_csv, write_json_envelopes
from cumulus.sources.history import read_history, store_snapshot

from .snapshots_fixture import AS_OF, dim, history


BANDS = ("12-15", "16-17", "18-24", "25-39", "40-49", "50-64", "65-74", "75+")


def age_feed(spark, scratch, days):
    rows = [(dt.datetime(2021, 7, 1) + dt.timedelta(days=i), c, None, None, None,
             (j + 1) * i * i, None, None, None, None)
            for i in range(days) for j, c in enumerate(K.AGE_CATEGORIES)]
    path = scratch("age_feed")
    write_csv(spark.createDataFrame(rows, schemas.AGE_FEED), path)
    return path


def test_age_history_is_carried_from_day_to_day(spark, scratch):
    empty = scratch("no_snapshot")
    write_json_envelopes(history(spark).limit(0).withColumn("Date", F.lit("")), empty,
                         "vaccination_data", head_field="runid")
    old = scratch("first_history")
    write_csv(spark.createDataFrame([(dt.date(2021, 7, 8),) + (10.0,) * 7], schemas.share_history()),
              old, single_file=True)
    out, hist, pop = scratch("days_out"), scratch("days_hist"), scratch("days_pop")
    write_csv(dim(spark), pop, single_file=True)

    def run(day, days, previous, dated=True):
        return run_daily(spark, DailyInputs(
            snapshot_json=empty, population_csv=pop, history_path=hist, out_dir=out, multi_line=False,
            age_feed_csv=age_feed(spark, scratch, days), age_history_csv=previous,
            as_of=day, dated_outputs=dated))

    first = run(dt.date(2021, 7, 12), 12, old)
    assert first["age_share"] == "ok" and first["history"].startswith("EmptyInput")
    assert first["target"] == "skipped: no snapshot landed"
    one = f"{out}/age_share/run_date=2021-07-12"
    assert run(dt.date(2021, 7, 13), 13, one)["age_share"] == "ok"
    two = f"{out}/age_share/run_date=2021-07-13"
    rows = read_csv_typed(spark, two, schemas.share_history(BANDS)).orderBy("Date").collect()
    assert [r.Date.day for r in rows] == [8, 9, 10, 11, 12, 13]
    for r in rows[1:]:
        assert abs(sum(r[b] for b in BANDS) - 100) < 1e-9
    # an output that is an input is refused, and the history is still there
    again = run(dt.date(2021, 7, 13), 13, two)
    assert again["age_share"].startswith("OutputIsInput")
    assert read_csv_typed(spark, two, schemas.share_history(BANDS)).count() == 6


def test_daily_run_end_to_end(spark, scratch):
    h = history(spark)
    hist_path = scratch("daily_hist")
    store_snapshot(spark, h.filter(F.col("Date") < AS_OF), hist_path, schemas.SNAPSHOT,
                   backfill=True)

    landing = scratch("daily_landing")
    recs = h.filter(F.col("Date") == AS_OF).withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))
    write_json_envelopes(recs, landing, "vaccination_data", head_field="runid")
    pop = scratch("daily_pop")
    write_csv(dim(spark), pop, single_file=True)

    county = scratch("daily_county")
    write_json_envelopes(spark.createDataFrame(
        [("2021-07-21", "25001", "Massachusetts", "MA ", "Barnstable", 60.0, 70.0),
         ("2021-07-21", "UNK", "Massachusetts", "MA", "Unknown", 1.0, 2.0)],
        schemas.COUNTY_RECORD), county, "vaccination_county_condensed_data", head_field="runid")

    feed_rows = [(dt.datetime(2021, 7, 1) + dt.timedelta(days=i), c, None, None, None,
                  (j + 1) * i * i, None, None, None, None)
                 for i in range(12) for j, c in enumerate(K.AGE_CATEGORIES)]
    feed = scratch("daily_age_feed")
    write_csv(spark.createDataFrame(feed_rows, schemas.AGE_FEED), feed)
    old = scratch("daily_age_hist")
    write_csv(spark.createDataFrame([(dt.date(2021, 7, 8),) + (10.0,) * 7,], schemas.share_history()),
              old, single_file=True)

    out = scratch("daily_out")
    inp = DailyInputs(snapshot_json=landing, population_csv=pop, history_path=hist_path,
                      out_dir=out, county_json=county, age_feed_csv=feed, age_history_csv=old,
                      multi_line=False, as_of=AS_OF)
    status = run_daily(spark, inp)
    assert status.pop("history") == "rows appended: 6"
    assert all(v == "ok" for v in status.values()), status
    assert sorted(os.listdir(out)) == ["age_share", "county", "map", "rolling", "state_table",
                                       "supply", "target"]
    hist = read_history(spark, hist_path, schemas.SNAPSHOT)
    assert hist.count() == h.count()
    assert hist.filter(F.col("LongName") == "New York").count() == 1   # canonical on landing
    age = read_csv_typed(spark, f"{out}/age_share",
                         schemas.share_history(BANDS))
    assert age.count() == 1 + 4          # old row + 2021-07-09 … 07-12
    # the county table keeps one file per task; its rows are whole
    county_out = spark.read.option("header", True).csv(f"{out}/county")
    assert county_out.count() == 1       # the UNK row is filtered out

    again = run_daily(spark, DailyInputs(**{**inp.__dict__, "out_dir": scratch("daily_out2")}))
    assert again["history"] == "rows appended: 0"                      # rerun is a no-op
    assert read_history(spark, hist_path, schemas.SNAPSHOT).count() == h.count()


def test_daily_run_command_line(spark, scratch):
    from cumulus.plans.daily_run import main
    h = history(spark)
    hist_path = scratch("cli_hist")
    landing = scratch("cli_landing")
    recs = h.filter(F.col("Date") == AS_OF).withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))
    write_json_envelopes(recs, landing, "vaccination_data", head_field="runid")
    store_snapshot(spark, h.filter(F.col("Date") < AS_OF), hist_path, schemas.SNAPSHOT,
                   backfill=True)
    pop = scratch("cli_pop")
    write_csv(dim(spark), pop, single_file=True)
    out = scratch("cli_out")
    rc = main(["--snapshot", landing, "--population", pop, "--history", hist_path,
               "--out", out, "--as-of", AS_OF.isoformat(), "--json-lines", "--dated"])
    assert rc == 0
    assert os.listdir(f"{out}/target") == [f"run_date={AS_OF.isoformat()}"]
