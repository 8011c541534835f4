"""Benchmark: headline cumulus jobs on the driver tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.

Each job runs to completion through the ``noop`` sink (every row computed, no
driver collect); every job is timed best-of-2, each run building its
DataFrame (or stored table) afresh (no result reuse between runs).  The jurisdiction history is built once from the raw tables
and stored as Parquet in the session's shared checkpoint folder (lineage cut),
as the daily ingest would leave a stored table for the reports.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from cumulus.schemas import SNAPSHOT  # noqa: E402
from cumulus.session import build_session, scratch_path, shared_dir  # noqa: E402
from cumulus.sources.history import store_snapshot  # noqa: E402
from cumulus.operators.joins import scalar_value  # noqa: E402
from cumulus.operators.snapshots import resolve_latest  # noqa: E402
from cumulus.plans import catalog as C, reports as R, standins as S  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("cumulus-bench", master=f"local[{cpus}]",
                          shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": "8g",
                                 **({"spark.eventLog.enabled": "true",
                                     "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
                                    if os.environ.get("BENCH_EVENT_LOG") else {}),
                                 "spark.sql.files.maxPartitionBytes": "64m"})
    shared_dir(spark)
    times: dict[str, float] = {}

    def timed(name, fn, repeat: int = 1):
        """Best of ``repeat`` runs (the host is shared; noise is one-sided)."""
        best, out = None, None
        for _ in range(repeat):
            t = time.time()
            out = fn()
            dt = time.time() - t
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        return out

    # Warm-up, untimed: one pass of the history build compiles the code paths
    # (whole-stage codegen, class loading) so the timings below are steady state.
    run(S.nation_snapshots(spark, sf_dir))

    hist = timed("history_build", lambda: S.nation_history(spark, sf_dir), 2)
    dim = timed("dimension_build", lambda: S.stored(S.nation_dim(spark, sf_dir), "nation_dim"), 2)
    latest = timed("latest_date", lambda: resolve_latest(hist), 2)
    snap = hist.filter(F.col("Date") == F.lit(latest))
    as_of = F.lit(latest)
    nat_pop = scalar_value(snap, "Location", S.PARENT_CODE, "Census2019")

    timed("report_state_table", lambda: run(R.report_state_table(
        snap, S.EXCLUDED_CODES, S.PARENT_CODE, nat_pop)), 2)
    timed("report_map", lambda: run(R.report_map(snap, dim)), 2)
    timed("report_target", lambda: run(R.report_target(
        hist, snap, dim, as_of, excluded_names=S.EXCLUDED_NAMES,
        national_code=S.PARENT_CODE, national_population=nat_pop, latest=latest)), 2)
    timed("report_supply", lambda: run(R.report_supply(
        hist, dim, as_of, goal=as_of, excluded_names=S.EXCLUDED_NAMES_SUPPLY, latest=latest)), 2)
    timed("report_rolling", lambda: run(R.report_rolling(hist, S.PARENT_CODE)), 2)
    timed("report_history", lambda: run(C.history_roundtrip(spark, hist)), 2)
    # What runs daily: a backfill of 120 days in one go, then one day appended to
    # it through the stored path (look-up, write into the date folder).
    path = scratch_path(spark, "bench_history")
    days = [r[0] for r in hist.select("Date").distinct().orderBy(F.col("Date").desc())
            .limit(121).collect()]
    old = hist.filter(F.col("Date").between(F.lit(days[-1]), F.lit(days[1])))
    timed("backfill_120_days", lambda: store_snapshot(spark, old, path, SNAPSHOT, backfill=True))
    timed("append_one_day", lambda: store_snapshot(spark, snap, path, SNAPSHOT))
    files = {"files_120_days": spark.read.parquet(path).filter(
                 F.col("Date") < F.lit(days[0])).select(F.input_file_name()).distinct().count(),
             "files_one_day": spark.read.parquet(path).filter(
                 F.col("Date") == F.lit(days[0])).select(F.input_file_name()).distinct().count()}
    feed = timed("feed_build", lambda: C._feed(spark, sf_dir), 2)
    timed("report_age_share", lambda: run(C.age_share_from_feed(feed)), 2)
    timed("flagship_weekly_change", lambda: run(C.flagship(spark, sf_dir)), 2)
    for name in ("report_county",
                 "lineitem_weekly_delta", "lineitem_trailing_mean", "lineitem_flag_shares"):
        timed(name, lambda n=name: run(C.QUERIES[n](spark, sf_dir)), 2)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_job_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "files": files,
                      "sf": float(sf.group(1)) if sf else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
