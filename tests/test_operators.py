import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulus.operators.deltas import (pct_change, period_delta, row_delta, snapshot_delta,
                                     snapshot_pairs)
from cumulus.operators.joins import fits_broadcast, join_dim, rows_at_most, scalar_value
from cumulus.operators.reshape import (cast_by_pattern, cumulative_panel, regex_rename,
                                       snake_name, snake_names)
from cumulus.operators.rolling import trailing_mean
from cumulus.operators.shares import group_share, group_total, share_pivot
from cumulus.operators.snapshots import newer_than, single_date, two_snapshots
from cumulus.operators.sorting import sort_by
from cumulus.operators.totals import (SchemaMismatch, total_row, union_by_name,
                                      with_total_row)

from .panels import day, panel, three_keys


def as_dict(df, key="Location", val=None):
    return {r[key]: (r[val] if val else r) for r in df.collect()}


def test_two_snapshots_keeps_latest_and_week_before(spark):
    got = two_snapshots(three_keys(spark)).select("Date").distinct().collect()
    assert sorted(r.Date for r in got) == [day(7), day(14)]


def test_snapshot_delta_is_keyed(spark):
    out = as_dict(snapshot_delta(three_keys(spark), ["Location"], ["x"]), val="x_delta")
    assert out["A"] == 70            # 240 - 170
    assert out["B"] is None          # B missing on day 7: NULL, not mis-paired
    assert out[None] == 7            # NULL keys pair with each other
    assert out["C"] is None          # ragged key: no older row


def test_snapshot_delta_older_absent_gives_all_null(spark):
    p = three_keys(spark).filter(F.col("Date") != day(7))
    out = snapshot_delta(p, ["Location"], ["x"]).collect()
    assert out and all(r.x_delta is None for r in out)


def test_snapshot_delta_where_applies_after_date_choice(spark):
    p = three_keys(spark)
    late = panel(spark, [(day(20), "Z", 1)])
    out = snapshot_delta(p.unionByName(late), ["Location"], ["x"],
                         where=F.col("Location") != "Z").collect()
    assert out == []   # latest date is chosen on the whole input (day 20)


def test_period_delta_every_date(spark):
    out = period_delta(three_keys(spark), ["Location"], ["x"]).filter(F.col("Location") == "A")
    got = {r.Date: r.x_delta for r in out.collect()}
    assert got[day(6)] is None and got[day(7)] == 70 and got[day(14)] == 70


def test_row_delta_counts_rows_not_days(spark):
    out = row_delta(three_keys(spark), ["Location"], "Date", ["x"]).filter(F.col("Location") == "B")
    got = {r.Date: r.x_diff for r in out.collect()}
    assert got[day(0)] is None
    assert got[day(8)] == 50 - (40 + 6)   # spans the missing day 7


def test_trailing_mean_needs_k_full_rows(spark):
    rows = [(day(i), "A", i) for i in range(10)] + [(day(i), "N", None if i == 5 else i)
                                                     for i in range(10)]
    out = trailing_mean(panel(spark, rows), ["Location"], "Date", ["x"], 7)
    a = {r.Date: r.x_avg for r in out.filter(F.col("Location") == "A").collect()}
    assert a[day(5)] is None and a[day(6)] == 3.0 and a[day(9)] == 6.0
    n = {r.Date: r.x_avg for r in out.filter(F.col("Location") == "N").collect()}
    assert all(n[day(i)] is None for i in range(5, 10) if i <= 11)   # NULL inside frame


def test_pct_change(spark):
    out = as_dict(pct_change(three_keys(spark), ["Location"], ["x"]), val="x_pct_chg")
    assert out["A"] == pytest.approx(70 / 170)


def test_group_total_and_share(spark):
    df = spark.createDataFrame([("d1", "a", 1), ("d1", "b", 3), ("d2", "a", 0), ("d2", "b", 0)],
                               "g string, c string, v long")
    t = {(r.g, r.c): r.group_total for r in group_total(df, ["g"], "v").collect()}
    assert t[("d1", "a")] == 4 and t[("d2", "b")] == 0
    s = {(r.g, r.c): r.share for r in group_share(df, ["g"], "v").collect()}
    assert s[("d1", "b")] == 75.0 and s[("d2", "a")] is None


def test_share_pivot_rows_sum_to_100(spark):
    cats = ["Ages_12-15_yrs", "Ages_16-17_yrs", "Ages_75+_yrs"]
    rows = [(day(i), c, (i + 1) * (j + 2)) for i in range(5) for j, c in enumerate(cats)]
    df = spark.createDataFrame(rows, "date date, cat string, v long")
    out = share_pivot(df, "date", "cat", "v", cats, label_pattern=r"\d{2}[-\+]\d*",
                      id_alias="Date")
    assert out.columns == ["Date", "12-15", "16-17", "75+"]
    for r in out.collect():
        assert sum(r[1:]) == pytest.approx(100.0, abs=1e-9)


def test_share_pivot_keeps_schema_when_empty(spark):
    df = spark.createDataFrame([], "date date, cat string, v long")
    out = share_pivot(df, "date", "cat", "v", ["a", "b"])
    assert out.columns == ["date", "a", "b"] and out.count() == 0


def test_cumulative_panel_densifies_and_carries_forward(spark):
    daily = panel(spark, [(day(0), "A", 1), (day(3), "A", 2), (day(1), "B", 5)])
    out = cumulative_panel(daily, ["Location"], "Date", ["x"])
    got = {(r.Location, r.Date): r.x for r in out.collect()}
    assert got == {("A", day(0)): 1, ("A", day(1)): 1, ("A", day(2)): 1, ("A", day(3)): 3,
                   ("B", day(1)): 5, ("B", day(2)): 5, ("B", day(3)): 5}


def test_delta_of_running_sum_is_original(spark):
    daily = panel(spark, [(day(i), k, (i * 7 + len(k)) % 5) for i in range(12) for k in ("A", "BB")])
    cum = cumulative_panel(daily, ["Location"], "Date", ["x"])
    back = row_delta(cum, ["Location"], "Date", ["x"]).filter(F.col("x_diff").isNotNull())
    orig = {(r.Location, r.Date): r.x for r in daily.collect()}
    for r in back.collect():
        assert r.x_diff == orig[(r.Location, r.Date)]


def test_union_by_name_checks_types(spark):
    a = spark.createDataFrame([(dt.date(2021, 7, 1), 1.0)], "Date date, v double")
    b = spark.createDataFrame([("2021-07-02", 2.0)], "Date string, v double")
    with pytest.raises(SchemaMismatch):
        union_by_name(a, b)
    c = spark.createDataFrame([(dt.date(2021, 7, 2), 2.0, 3.0)], "Date date, v double, w double")
    assert union_by_name(a, c).filter(F.col("w").isNull()).count() == 1


def test_with_total_row_on_top(spark):
    det = spark.createDataFrame([("x", 2), ("y", 3)], "n string, v long")
    out = with_total_row(total_row(det, "n", "Total", sums=("v",)), det, "grp")
    rows = sort_by(out, "grp", "n").collect()
    assert rows[0].n == "Total" and rows[0].v == 5 and len(rows) == 3


def test_join_dim_inner_filters_and_broadcast_check(spark):
    facts = spark.createDataFrame([("AL", 1), ("GU", 2)], "Location string, v long")
    dim = spark.createDataFrame([("AL", "Alabama")], "postal_code string, name string")
    assert rows_at_most(dim, 1) and not rows_at_most(facts, 1)
    assert [r.name for r in join_dim(facts, dim, "Location", "postal_code").collect()] == ["Alabama"]
    left = join_dim(facts, dim, "Location", "postal_code", "left", max_broadcast_rows=0)
    assert left.count() == 2


def test_broadcast_check_bounds_bytes_as_well_as_rows(spark):
    wide = spark.createDataFrame([(f"K{i}", "x" * 100_000, [i] * 10) for i in range(3)],
                                 "postal_code string, blob string, xs array<int>")
    assert fits_broadcast(wide, max_rows=10, max_bytes=1_000_000)
    assert not fits_broadcast(wide, max_rows=10, max_bytes=200_000)     # 3 × 100 kB text
    assert not fits_broadcast(wide, max_rows=2, max_bytes=10_000_000)   # 3 rows
    facts = spark.createDataFrame([("K1", 1), ("Z", 2)], "Location string, v long")
    out = join_dim(facts, wide, "Location", "postal_code", max_broadcast_bytes=200_000)
    hinted = out._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in hinted
    assert [r.v for r in out.collect()] == [1]
    small = join_dim(facts, wide.select("postal_code"), "Location", "postal_code")
    assert "strategy=broadcast" in small._jdf.queryExecution().analyzed().toString()


def test_scalar_value_in_row_expression(spark):
    df = spark.createDataFrame([("US", 10), ("MA", 4)], "Location string, v long")
    out = df.select("Location", (F.col("v") / scalar_value(df, "Location", "US", "v")).alias("s"))
    assert as_dict(out, val="s")["MA"] == 0.4


def test_newer_than_and_single_date(spark):
    p = three_keys(spark)
    hist = p.filter(F.col("Date") <= day(10))
    assert newer_than(p, hist).select("Date").distinct().count() == 4
    empty = p.limit(0)
    assert newer_than(p, empty).count() == p.count()
    assert single_date(p.filter(F.col("Date") == day(3))).first().Date == day(3)
    with pytest.raises(Exception):
        single_date(p).collect()


def test_regex_rename_and_names(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "date int, `Ages_12-15_yrs` double, `Ages_18_24_yrs` double")
    assert regex_rename(df, r"\d{2}[-\+]\d*").columns == ["date", "12-15", "NA"]
    assert snake_name("People with 1 Dose per 100k") == "people_with_1_dose_per_100k"
    assert snake_name("% of Currently Eligible Vaccinated") == "percent_of_currently_eligible_vaccinated"
    assert snake_names(df, ["a", "b", "c"]).columns == ["a", "b", "c"]


def test_cast_by_pattern(spark):
    df = spark.createDataFrame([("1", "x", 2)], "Doses_A string, Name string, Doses_B long")
    out = cast_by_pattern(df, "Doses")
    assert dict(out.dtypes) == {"Doses_A": "double", "Name": "string", "Doses_B": "double"}


def test_sort_by_order_with_ties_nulls_and_mixed_directions(spark):
    df = spark.createDataFrame([("b", 1, 2.0), ("a", 1, 2.0), (None, 1, 2.0), ("c", None, 5.0),
                                ("d", 3, None), ("e", 3, 1.0), ("f", None, None)],
                               "k string, x long, y double").repartition(4)
    order = [r.k for r in sort_by(df, ("x", "desc"), "y", "k").collect()]
    assert order == ["e", "d", "a", "b", None, "c", "f"]
    assert [r.k for r in sort_by(df, "x", ("y", "desc"), ("k", "desc")).collect()] == \
        ["b", "a", None, "e", "d", "c", "f"]
    assert [r.k for r in sort_by(df, ("k", "desc")).collect()] == ["f", "e", "d", "c", "b", "a", None]


def test_group_total_of_a_null_group(spark):
    df = spark.createDataFrame([(None, "x", 1), (None, "y", 3), ("a", "x", 5), ("a", None, 7)],
                               "g string, h string, v long")
    got = {(r.g, r.h): r.group_total for r in group_total(df, ["g"], "v").collect()}
    assert got == {(None, "x"): 4, (None, "y"): 4, ("a", "x"): 12, ("a", None): 12}
    got = {(r.g, r.h): r.group_total for r in group_total(df, ["g", "h"], "v").collect()}
    assert got == {(None, "x"): 1, (None, "y"): 3, ("a", "x"): 5, ("a", None): 7}
    assert group_total(df, ["g"], "v").columns == ["g", "h", "v", "group_total"]


def test_snapshot_pairs_equals_the_join(spark):
    p = three_keys(spark).withColumn("name", F.concat(F.lit("n"), F.col("Location")))
    pairs = {r.Location: (r.x, r.x_delta, r.name) for r in
             snapshot_pairs(p, ["Location"], ["name"], ["x"]).collect()}
    joined = {r.Location: (r.x, r.x_delta, r.name) for r in
              snapshot_delta(p, ["Location"], ["x"]).collect()}
    assert pairs == joined and pairs["C"] == (5, None, "nC") and None in pairs


def test_scalar_value_needs_exactly_one_row(spark):
    df = spark.createDataFrame([("US", None), ("MA", 4), ("MA", 5)], "Location string, v long")
    assert df.select(scalar_value(df, "Location", "US", "v").alias("s")).first().s is None
    for key in ("XX", "MA"):
        with pytest.raises(Exception, match="rows, not one"):
            df.select(scalar_value(df, "Location", key, "v")).collect()
