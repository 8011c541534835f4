import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulus.operators.totals import SchemaMismatch
from cumulus.schemas import SNAPSHOT, SNAPSHOT_RECORD
from cumulus.sources.files import EmptyInput, write_json_envelopes
from cumulus.sources.history import (BadSnapshot, append_by_date, append_if_newer, append_rows,
                                     read_history, store_snapshot)
from cumulus.streaming.ingest import start_snapshot_ingest

from .snapshots_fixture import DATES, history


def test_append_by_date_is_idempotent(spark):
    h = history(spark)
    old = h.filter(F.col("Date") < DATES[-1])
    new = h.filter(F.col("Date") == DATES[-1])
    once = append_by_date(old, new)
    twice = append_by_date(once, new)
    assert once.count() == h.count() == twice.count()


def test_older_snapshot_adds_no_duplicate_dates(spark):
    h = history(spark)
    older = h.filter(F.col("Date") == DATES[0]).withColumn("Doses_Administered", F.lit(0).cast("bigint"))
    out = append_by_date(h, older)
    assert out.count() == h.count()
    assert out.filter(F.col("Doses_Administered") == 0).count() == 0


def test_date_as_text_fails_loudly(spark):
    h = history(spark)
    bad = h.withColumn("Date", F.col("Date").cast("string"))
    with pytest.raises(SchemaMismatch):
        append_by_date(h, bad)


def test_append_if_newer_noop_keeps_schema(spark):
    h = history(spark)
    out = append_if_newer(h, h.filter(F.col("Date") < DATES[-1]))
    assert out.count() == h.count() and out.columns == h.columns


def test_store_snapshot_partitions_and_reruns(spark, scratch):
    path = scratch("hist")
    h = history(spark)
    first = h.filter(F.col("Date") == DATES[0])
    assert store_snapshot(spark, first, path, SNAPSHOT) == 6
    assert store_snapshot(spark, first, path, SNAPSHOT) == 0          # same snapshot: no-op
    with pytest.raises(BadSnapshot, match="more than one date"):
        store_snapshot(spark, h, path, SNAPSHOT)
    assert store_snapshot(spark, h, path, SNAPSHOT, backfill=True) == 12   # only the new dates
    assert store_snapshot(spark, h, path, SNAPSHOT, backfill=True) == 0
    back = read_history(spark, path, SNAPSHOT)
    assert back.count() == 18
    assert back.select("Date").distinct().count() == 3
    with pytest.raises(EmptyInput):
        store_snapshot(spark, h.limit(0), path, SNAPSHOT)
    assert read_history(spark, path, SNAPSHOT).count() == 18          # unchanged


def test_streaming_ingest_available_now(spark, scratch):
    landing, hist_path, ckpt = scratch("landing"), scratch("hist"), scratch("ckpt")
    h = history(spark)
    recs = (h.filter(F.col("Date") == DATES[-1])
             .withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))
             .withColumn("LongName", F.col("LongName")))
    write_json_envelopes(recs, landing, "vaccination_data")
    q = start_snapshot_ingest(spark, landing, SNAPSHOT_RECORD, "vaccination_data", hist_path,
                              SNAPSHOT, ckpt)
    q.awaitTermination(120)
    back = read_history(spark, hist_path, SNAPSHOT)
    assert back.count() == 6
    assert back.filter(F.col("LongName") == "New York").count() == 1
    assert back.first().Date == dt.date(2021, 7, 21)


def test_stored_table_roundtrip_under_checkpoint_dir_with_pushdown(spark):
    from cumulus.plans.standins import stored
    from cumulus.session import shared_dir
    df = spark.createDataFrame(
        [(dt.date(2021, 7, 1) + dt.timedelta(days=i % 9), f"k{i % 4}", i) for i in range(60)],
        "Date date, key string, v long").repartition(3)
    s = stored(df, "stored_test")
    assert sorted(map(tuple, s.collect())) == sorted(map(tuple, df.collect()))
    assert s.schema.names == df.schema.names
    text = s.filter(F.col("Date") == dt.date(2021, 7, 5))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "EqualTo(Date,2021-07-05)" in text
    assert shared_dir(spark).replace("file:", "") in text.replace("file:", "")
    assert "Scan ExistingRDD" not in text          # a table scan, not a checkpointed RDD


def test_store_snapshot_keeps_other_dates_under_static_session_default(spark, scratch):
    """The append must not depend on the session's overwrite mode."""
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        path = scratch("hist_static")
        h = history(spark)
        assert store_snapshot(spark, h.filter(F.col("Date") == DATES[0]), path, SNAPSHOT) == 6
        assert store_snapshot(spark, h.filter(F.col("Date") == DATES[1]), path, SNAPSHOT) == 6
        back = read_history(spark, path, SNAPSHOT)
        assert back.count() == 12 and back.select("Date").distinct().count() == 2
    finally:
        spark.conf.set(key, old)


def test_store_snapshot_fills_missing_columns_and_refuses_missing_dates(spark, scratch):
    path, h = scratch("hist_cols"), history(spark)
    first = h.filter(F.col("Date") == DATES[0]).drop("Census2019")
    assert store_snapshot(spark, first, path, SNAPSHOT) == 6
    back = read_history(spark, path, SNAPSHOT)
    assert back.filter(F.col("Census2019").isNull()).count() == 6
    undated = h.filter(F.col("Date") == DATES[1]).withColumn(
        "Date", F.when(F.col("Location") != "MA", F.col("Date")))
    with pytest.raises(BadSnapshot, match="1 rows without a date"):
        store_snapshot(spark, undated, path, SNAPSHOT)
    with pytest.raises(SchemaMismatch):
        store_snapshot(spark, first.withColumn("Location", F.lit(1)), path, SNAPSHOT)
    assert read_history(spark, path, SNAPSHOT).count() == 6


def test_append_reads_only_the_snapshots_dates(spark, scratch):
    """The look-up in the history is a filter on the date folders."""
    from cumulus.sources.history import _between
    path = scratch("hist_prune")
    store_snapshot(spark, history(spark), path, SNAPSHOT, backfill=True)
    plan = _between(read_history(spark, path, SNAPSHOT), "Date", DATES[1], DATES[1])._jdf \
        .queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Date" in plan and str(DATES[1]) in plan


def test_backfill_writes_few_files(spark, scratch):
    import glob
    days = spark.range(120).select(F.date_add(F.lit(dt.date(2021, 1, 1)), F.col("id").cast("int"))
                                   .alias("Date"))
    rows = days.crossJoin(spark.range(26).select(F.col("id").cast("string").alias("Location")))
    rows = rows.repartition(8, "Location")
    path = scratch("hist_files")
    assert store_snapshot(spark, rows, path, rows.schema, backfill=True) == 3120
    assert len(glob.glob(path.replace("file:", "") + "/Date=*/*.parquet")) <= 2 * 120


def _landed(spark, rows, landing):
    write_json_envelopes(rows.withColumn("Date", F.date_format("Date", "yyyy-MM-dd")), landing,
                         "vaccination_data", F.monotonically_increasing_id(), mode="append")


def test_stream_keeps_a_date_split_over_files_batches_and_runs(spark, scratch):
    landing, hist_path, ckpt = scratch("landing"), scratch("hist"), scratch("ckpt")
    h = history(spark).filter(F.col("Date") == DATES[-1])

    def run(checkpoint=ckpt):
        start_snapshot_ingest(spark, landing, SNAPSHOT_RECORD, "vaccination_data", hist_path,
                              SNAPSHOT, checkpoint, max_files_per_trigger=1).awaitTermination(120)
        return read_history(spark, hist_path, SNAPSHOT)

    _landed(spark, h.filter(F.col("Location").isin("MA", "NY", "US")).repartition(3, "Location"),
            landing)
    assert run().count() == 3
    _landed(spark, h.filter("Location = 'GU'").coalesce(1), landing)   # late, same date
    assert run().count() == 4
    assert run(scratch("ckpt_lost")).count() == 4                      # all files again: no row twice


def test_stream_reads_one_document_per_file(spark, tmp_path, scratch):
    import json
    records = [r.asDict() | {"Date": r.Date.isoformat()}
               for r in history(spark).filter(F.col("Date") == DATES[-1]).collect()]
    (tmp_path / "a.json").write_text(json.dumps({"meta": "1", "vaccination_data": records}, indent=1))
    start_snapshot_ingest(spark, str(tmp_path), SNAPSHOT_RECORD, "vaccination_data", path := scratch("h"),
                          SNAPSHOT, scratch("c"), multi_line=True).awaitTermination(120)
    assert read_history(spark, path, SNAPSHOT).count() == 6


def test_append_rows_adds_unknown_keys_only(spark, scratch):
    path, h = scratch("hist_rows"), history(spark)
    assert append_rows(spark, h.filter("Location = 'MA'"), path, SNAPSHOT, ["Location"]) == 3
    assert append_rows(spark, h, path, SNAPSHOT, ["Location"]) == 15
    assert append_rows(spark, h, path, SNAPSHOT, ["Location"]) == 0
    null_key = h.filter("Location = 'MA'").withColumn("Location", F.lit(None).cast("string"))
    assert append_rows(spark, null_key, path, SNAPSHOT, ["Location"]) == 3
    assert append_rows(spark, null_key, path, SNAPSHOT, ["Location"]) == 0
