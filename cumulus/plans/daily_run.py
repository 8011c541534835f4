"""One daily run: land the snapshot, then publish every table.

The tracked program's whole daily batch as calls into cumulus: ingest the
snapshot into the date-partitioned history (once per date), then derive the
state table, map, target projection, supply projection, rolling growth,
county table and age-share history, each written as a header CSV under
``out_dir/<table>/``.  Each table is independent: a failing one is reported
and does not stop the others; without a snapshot, the tables that need none
are still published.  An output that equals, holds or lies in an input is
refused before anything is deleted, so the age-share history is carried on by
reading yesterday's output and writing to today's folder.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F

from .. import constants as K
from .. import schemas
from ..operators.reshape import normalise_snapshot
from ..operators.shares import label_from_pattern
from ..operators.snapshots import resolve_latest
from ..sources.files import (EmptyInput, csv_header, dated_path, read_csv_typed,
                             read_feed_to_date, read_json_envelope, refuse_overlap, write_csv)
from ..sources.history import BadSnapshot, read_history
from ..sources.json_ranges import read_json_document
from ..sources.landing import land_snapshot
from . import reports as R


@dataclass
class DailyInputs:
    snapshot_json: str                       # landed snapshot document(s)
    population_csv: str                      # state dimension
    history_path: str                        # Parquet history, partitioned by Date
    out_dir: str                             # one folder per published table
    county_json: str | None = None
    age_feed_csv: str | None = None
    age_history_csv: str | None = None
    snapshot_field: str = "vaccination_data"
    county_field: str = "vaccination_county_condensed_data"
    head_field: str = "runid"
    multi_line: bool = True                  # one document per file
    as_of: dt.date | None = None             # run date; default: today
    age_categories: tuple = K.AGE_CATEGORIES
    dated_outputs: bool = False              # out_dir/<table>/run_date=YYYY-MM-DD/


def read_share_history(spark: SparkSession, path: str, categories=K.AGE_CATEGORIES):
    """The share history as its header names it: a date and any of the bands, as
    histories from before a band was added hold fewer.  Comes with all bands in
    the categories' order, a missing one NULL."""
    bands = [label_from_pattern(c, K.BAND_LABEL_PATTERN) for c in categories]
    header = csv_header(spark, path)
    unknown = set(header) - {"Date", *bands}
    if unknown or "Date" not in header:
        raise ValueError(f"share history has columns {header}; known are Date and {bands}")
    known = {f.name: f for f in schemas.share_history(bands).fields}
    old = read_csv_typed(spark, path, schemas.T.StructType([known[c] for c in header]))
    return old.select("Date", *[F.col(f"`{b}`") if b in header
                                else F.lit(None).cast("double").alias(b) for b in bands])


def run_daily(spark: SparkSession, inp: DailyInputs) -> dict:
    """Returns {table: "ok" | "rows appended: n" | error text}."""
    status: dict = {}
    run_date = inp.as_of or dt.date.today()
    as_of = F.lit(run_date)
    inputs = [p for p in (inp.snapshot_json, inp.population_csv, inp.history_path,
                          inp.county_json, inp.age_feed_csv, inp.age_history_csv) if p]

    landed = read_json_envelope(spark, inp.snapshot_json, schemas.SNAPSHOT_RECORD,
                                inp.snapshot_field, inp.head_field, inp.multi_line)
    snapshot = normalise_snapshot(landed).select(*schemas.SNAPSHOT.fieldNames())
    try:
        # the history stays as it is on an empty document, a type clash, a
        # missing date, or more dates than one
        landed_rows = land_snapshot(spark, snapshot, inp.history_path, schemas.SNAPSHOT,
                                    keys=["Location"])
        status["history"] = f"rows appended: {landed_rows.written}" + (
            f", in quarantine: {landed_rows.quarantined}" if landed_rows.quarantined else "")
        landed_ok = True
    except (EmptyInput, BadSnapshot) as e:
        status["history"] = f"{type(e).__name__}: {e}"
        landed_ok = False

    def publish(name, build, bounded=True):
        """``bounded`` tables (one row per jurisdiction, day or category) are
        written as one file; the county table grows with its feed, so it
        keeps one file per task rather than passing through a single task."""
        path = f"{inp.out_dir}/{name}"
        path = dated_path(path, run_date) if inp.dated_outputs else path
        try:
            refuse_overlap(spark, path, inputs)
            write_csv(build(), path, single_file=bounded)
            status[name] = "ok"
        except Exception as e:  # noqa: BLE001 — report and continue with the next table
            status[name] = f"{type(e).__name__}: {e}"

    if landed_ok:
        hist = read_history(spark, inp.history_path, schemas.SNAPSHOT)
        latest = resolve_latest(hist)
        snap = hist.filter(F.col("Date") == F.lit(latest))
        dim = read_csv_typed(spark, inp.population_csv, schemas.POPULATION)
        publish("state_table", lambda: R.report_state_table(snap))
        publish("map", lambda: R.report_map(snap, dim))
        publish("target", lambda: R.report_target(hist, snap, dim, as_of, latest=latest))
        publish("supply", lambda: R.report_supply(hist, dim, as_of, latest=latest))
        publish("rolling", lambda: R.report_rolling(hist))
    else:
        for name in ("state_table", "map", "target", "supply", "rolling"):
            status[name] = "skipped: no snapshot landed"
    if inp.county_json:
        # The county document grows with the feed, so one document is read by many tasks.
        publish("county", lambda: R.report_county(
            read_json_document(spark, inp.county_json, schemas.COUNTY_RECORD, inp.county_field)
            if inp.multi_line else read_json_envelope(
                spark, inp.county_json, schemas.COUNTY_RECORD, inp.county_field,
                inp.head_field)), bounded=False)
    if inp.age_feed_csv and inp.age_history_csv:
        def age():
            feed = read_feed_to_date(spark, inp.age_feed_csv, schemas.AGE_FEED, "date")
            old = read_share_history(spark, inp.age_history_csv, inp.age_categories)
            return R.report_age_share(feed, old, categories=inp.age_categories)
        publish("age_share", age)
    return status


def main(argv=None) -> int:
    """``python -m cumulus.plans.daily_run --snapshot … --population … --history … --out …``"""
    import argparse
    import json

    from ..session import build_session

    ap = argparse.ArgumentParser(description="Land today's snapshot and publish every table.")
    ap.add_argument("--snapshot", required=True, help="landed snapshot JSON document(s)")
    ap.add_argument("--population", required=True, help="state dimension CSV")
    ap.add_argument("--history", required=True, help="Parquet history (partitioned by Date)")
    ap.add_argument("--out", required=True, help="output folder, one sub-folder per table")
    ap.add_argument("--county", help="county JSON document(s)")
    ap.add_argument("--age-feed", help="age feed CSV")
    ap.add_argument("--age-history", help="published age-share history CSV")
    ap.add_argument("--as-of", help="run date YYYY-MM-DD (default: today)")
    ap.add_argument("--json-lines", action="store_true", help="documents are one per line")
    ap.add_argument("--dated", action="store_true", help="write under run_date=YYYY-MM-DD")
    a = ap.parse_args(argv)
    spark = build_session("cumulus-daily")
    status = run_daily(spark, DailyInputs(
        snapshot_json=a.snapshot, population_csv=a.population, history_path=a.history,
        out_dir=a.out, county_json=a.county, age_feed_csv=a.age_feed,
        age_history_csv=a.age_history, multi_line=not a.json_lines,
        as_of=dt.date.fromisoformat(a.as_of) if a.as_of else None, dated_outputs=a.dated))
    print(json.dumps(status, indent=1))
    failed = [k for k, v in status.items()
              if v != "ok" and not (k == "history" and v.startswith("rows appended"))]
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
