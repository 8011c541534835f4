"""Checked scans, ordered sinks, names, drift, series in blocks, incremental reports."""

import csv
import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cumulus.operators.deltas import row_delta, snapshot_delta, snapshot_pairs
from cumulus.operators.reshape import snake_names, unique_names
from cumulus.operators.rolling import trailing_mean
from cumulus.operators.series import BLOCK, numbered, over_blocks, row_delta_long, trailing_mean_long
from cumulus.operators.totals import SchemaMismatch
from cumulus.plans import reports as R
from cumulus.plans.incremental import OutOfOrder, RollingState
from cumulus.schemas import POPULATION
from cumulus.sources.drift import common_schema, common_type, land_drifting, read_drifting
from cumulus.sources.files import (read_csv_checked, read_csv_ordered, read_csv_typed, read_rejects,
                                   write_csv_ordered)

from .snapshots_fixture import AS_OF, DATES, dim, history

AB = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
                   T.StructField("c", T.StringType())])
BROKEN = "a,b,c\n1,2,x\n2,word,y\n3,4,z,surplus\n4,5,NA\n6\n"


# ---- scans -------------------------------------------------------------------
@pytest.mark.parametrize("use", [lambda d: d.select("a").collect(), lambda d: d.count(),
                                 lambda d: d.collect(), lambda d: d.groupBy("c").count().collect()])
def test_a_broken_row_fails_whatever_is_selected(spark, tmp_path, use):
    (tmp_path / "f.csv").write_text(BROKEN)
    with pytest.raises(Exception, match="(?i)malformed"):
        use(read_csv_typed(spark, str(tmp_path), AB))
    (tmp_path / "f.csv").write_text("b,a,c\n1,2,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        use(read_csv_typed(spark, str(tmp_path), AB))


def test_broken_rows_are_listed_once_with_their_text(spark, tmp_path, scratch):
    (tmp_path / "f.csv").write_text(BROKEN + "2,word,y\n")
    rejects = scratch("rejects")
    for _ in range(2):
        good = read_csv_checked(spark, str(tmp_path), AB, rejects)
        assert good.count() == 2 and sorted(r["a"] for r in good.select("a").collect()) == [1, 4]
    got = sorted((r["line"], r["n"]) for r in read_rejects(spark, rejects).collect())
    assert got == [("2,word,y", 2), ("3,4,z,surplus", 1), ("6", 1)]


def test_parts_in_the_order_of_their_names_are_one_file(spark, scratch):
    df = spark.createDataFrame(
        [(i * 37 % 101 - 50, f'"x", {i}\\' if i % 3 else None, dt.date(2021, 1, 1) + dt.timedelta(days=i),
          dt.datetime(2021, 1, 1, 0, 0, 0, i)) for i in range(400)], "`a b` long, b string, c date, d timestamp_ntz")
    path = scratch("ordered")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_csv_ordered(df.repartition(5), path, [("a b", "desc"), "c"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = sorted(glob.glob(path.replace("file:", "") + "/part-*.csv"))
    lines = [line for f in files for line in open(f).read().splitlines()]
    rows = list(csv.reader(lines, escapechar="\\"))
    want = [(str(r["a b"]), r["c"].isoformat()) for r in
            sorted(df.collect(), key=lambda r: (-r["a b"], r["c"]))]
    assert len(files) > 2 and rows[0] == ["a b", "b", "c", "d"]
    assert [(r[0], r[2]) for r in rows[1:]] == want
    assert sorted(read_csv_ordered(spark, path, df.schema).collect(), key=str) == sorted(df.collect(), key=str)


def test_clean_names_are_all_different(spark):
    df = spark.createDataFrame([(1,) * 8], ["A b", "a_B", "A.b", "a_b_2", "Größe %", "名", "--", "ÇØrÆ"])
    assert snake_names(df).columns == ["a_b", "a_b_2", "a_b_3", "a_b_2_2", "grosse_percent", "x", "x_2", "cor_ae"]
    assert unique_names(["x", "x", "x_2", "x"]) == ["x", "x_2", "x_2_2", "x_3"]


# ---- drift -------------------------------------------------------------------
def test_a_column_added_and_widened_midway_reads_as_one_frame(spark, scratch):
    path, day = scratch("drift"), dt.date(2021, 7, 1)
    kinds = {"n": ("int", "bigint"), "m": ("int", "double"), "f": ("float", "double"),
             "p": ("decimal(5,1)", "decimal(9,3)"), "s": ("string", "string")}
    frames = []
    for i, side in enumerate((0, 1, 0)):
        cols = [F.lit(7 + i).cast(k[side]).alias(c) for c, k in kinds.items()]
        cols += [F.lit("new").alias("extra")] if side else []
        frames.append(spark.range(2).select(F.lit(day + dt.timedelta(days=i)).alias("Date"),
                                            F.col("id").cast("string").alias("Location"), *cols))
        assert land_drifting(spark, frames[-1], path).written == 2
        assert land_drifting(spark, frames[-1], path).written == 0
    got = read_drifting(spark, path)
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {
        "Date": "date", "Location": "string", **{c: k[1] for c, k in kinds.items()}, "extra": "string"}
    rows = sorted(got.select("Date", "n", "m", "f", "p", "extra").distinct().collect())
    assert [(r["n"], r["m"], r["f"], float(r["p"]), r["extra"]) for r in rows] == [
        (7, 7.0, 7.0, 7.0, None), (8, 8.0, 8.0, 8.0, "new"), (9, 9.0, 9.0, 9.0, None)]


def test_a_type_of_another_kind_is_refused(spark, scratch):
    path = scratch("refused")
    one = spark.createDataFrame([(dt.date(2021, 7, 1), 1)], "Date date, n long")
    land_drifting(spark, one, path)
    for bad in ("string", "double", "boolean"):
        later = one.select(F.date_add("Date", 1).alias("Date"), F.col("n").cast(bad).alias("n"))
        with pytest.raises(SchemaMismatch, match="n is"):
            land_drifting(spark, later, path)
    assert read_drifting(spark, path).count() == 1


def test_common_types_hold_both(spark):
    t = T._parse_datatype_string
    assert common_type(t("int"), t("float")) == t("double")
    assert common_type(t("decimal(38,0)"), t("decimal(10,5)")) is None
    assert common_type(t("bigint"), t("double")) is None
    assert common_schema([t("a int, b date"), t("b timestamp_ntz, c string, a smallint")]) == t(
        "a int, b timestamp_ntz, c string")


# ---- series ------------------------------------------------------------------
def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


@pytest.mark.parametrize("block", [8, 50, BLOCK])
def test_blocks_equal_the_plain_windows(spark, block):
    df = spark.range(600).select(
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 > 0, F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"), F.when(F.col("id") % 41 > 0, F.pmod(F.col("id") * 7919, 1000)).alias("v"))
    df = df.repartition(5)
    assert same(row_delta_long(df, ["k"], "t", ["v"], block=block), row_delta(df, ["k"], "t", ["v"]))
    assert same(trailing_mean_long(df, ["k"], "t", ["v"], block=block), trailing_mean(df, ["k"], "t", ["v"]))
    got = numbered(df, ["k"], ["t"], block=block)
    from pyspark.sql import Window
    assert same(got, df.withColumn("number", F.row_number().over(
        Window.partitionBy("k").orderBy("t")).cast("long")))


def test_one_series_is_spread_over_tasks(spark):
    df = spark.range(20_000).select(F.lit("one").alias("k"), F.col("id").alias("t"), (F.col("id") * 2).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = row_delta_long(df, ["k"], "t", ["v"], block=1000)
        sizes = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(sizes) == 4 and sum(r["count"] for r in sizes) == 20_000
    assert out.filter("v_diff <> 2").count() == 0 and out.filter("v_diff IS NULL").count() == 1


def test_a_halo_as_long_as_a_block_is_refused(spark):
    with pytest.raises(ValueError, match="cannot hand on"):
        over_blocks(spark.range(3), [], ["id"], 7, lambda rows, w: rows, block=7)


@pytest.mark.parametrize("block", [None, 3, 1000])
def test_rows_of_a_repeated_key_are_all_paired(spark, block):
    old, new = AS_OF - dt.timedelta(days=7), AS_OF
    df = spark.createDataFrame([(old, None, "P", 10), (new, None, "P", 17), (old, None, "Q", 20), (new, None, "Q", 29),
                                (old, "X", "x", 1), (new, "X", "x", 3), (new, "X", "x", 5), (old, "gone", "g", 1),
                                (new, "Y", None, 2)], "Date date, Location string, name string, v long")
    got = snapshot_pairs(df, ["Location"], ["name"], ["v"], block=block, latest=new)
    assert got.columns == ["Location", "name", "v", "v_delta"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, "P", 17, 7), (None, "Q", 29, 9), ("X", "x", 3, 2), ("X", "x", 5, None), ("Y", None, 2, None)], key=str)
    assert snapshot_pairs(df.limit(0), ["Location"], ["name"], ["v"], block=block).collect() == []
    unique = df.filter("Location IN ('Y', 'gone')")
    assert sorted(map(tuple, snapshot_pairs(unique, ["Location"], ["name"], ["v"]).collect())) == sorted(
        map(tuple, snapshot_delta(unique, ["Location"], ["v"]).select("Location", "name", "v", "v_delta").collect()))


def test_target_report_keeps_states_without_a_code_and_reads_three_relations(spark):
    """Two states whose code is NULL both have a row, each with its own change."""
    h = history(spark).withColumn("Location", F.when(~F.col("Location").isin("MA", "NY"), F.col("Location")))
    codes = spark.createDataFrame([("None", 1, 1, None, 1)], POPULATION).unionByName(dim(spark))
    pairs = R.week_frame(h, latest=AS_OF).filter("Location IS NULL")
    assert sorted((r["LongName"], r["Doses_Administered_delta"]) for r in pairs.collect()) == [
        ("Massachusetts", 8820), ("New York State", 17640)]
    out = R.report_target(h, None, codes, F.lit(AS_OF), latest=AS_OF)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", plan)) <= 3
    assert plan.count("scalar-subquery") <= 2


# ---- incremental -------------------------------------------------------------
PANEL = [(d, k, (i + 1) * (k != "v") * 10 + i * i) for i, d in enumerate(
    AS_OF - dt.timedelta(days=n) for n in range(14, -1, -1)) for k in ("u", "v", None)
    if not (k == "u" and i in (5, 13)) and not (k == "v" and i < 13)]


def test_days_one_by_one_equal_the_full_run(spark, scratch):
    panel = spark.createDataFrame(PANEL, "Date date, key string, n long").withColumn("extra", F.lit(1))
    full = trailing_mean(row_delta(panel, ["key"], "Date", ["n"]), ["key"], "Date", ["n_diff"])
    days = sorted({r[0] for r in PANEL})
    state = RollingState(spark, scratch("rolling"), ["key"], ["n"])
    state.start(panel.filter(F.col("Date") <= days[2]))
    for day in days[3:]:
        state.update(panel.filter(F.col("Date") == day), day)
    again = state.update(panel.filter(F.col("Date") == days[-1]), days[-1])     # a rerun of the last day
    assert again.count() == 3
    assert same(state.published(), full)
    with pytest.raises(OutOfOrder, match="is older"):
        state.update(panel.filter(F.col("Date") == days[3]), days[3])
    with pytest.raises(OutOfOrder, match="no state"):
        RollingState(spark, scratch("none"), ["key"], ["n"]).update(panel, days[3])


def test_an_update_reads_one_state_and_the_day(spark, scratch):
    panel = spark.createDataFrame(PANEL, "Date date, key string, n long")
    state = RollingState(spark, scratch("reads"), ["key"], ["n"])
    state.start(panel.filter(F.col("Date") < DATES[1]))
    state.update(panel.filter(F.col("Date") == DATES[1]), DATES[1])
    out = state.update(panel.filter(F.col("Date") == DATES[2]), DATES[2])
    assert out.count() == 2 + 1 * (DATES[2] == AS_OF)
    assert len(glob.glob(state.path.replace("file:", "") + "/state/as_of=*")) == 3
