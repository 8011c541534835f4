"""Plan-shape guards: what would not survive 1000× the data fails here.

For every registered query (run from test_catalog): no cartesian product or nested-loop join, no
window without a partition key (it would pull all rows into one task), no
Python evaluation node (row-at-a-time or Arrow UDF) in the plan, and no scan
reading every column of a wide driver table.
"""

import os
import re

import pytest

from cumulus.schemas import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


SCAN = re.compile(r"FileScan parquet \[([^\]]*)\].*?Location: \w+\(\d+ paths\)\[([^,\]]*)")


def full_scans(text: str) -> list:
    """Driver tables (wider than 3 columns) scanned with every column."""
    out = []
    for cols, loc in SCAN.findall(text):
        t = re.search(r"/(\w+)\.parquet", loc)
        schema = DRIVER_TABLES.get(t.group(1)) if t else None
        if schema is not None and len(schema.fields) > 3 \
                and len(cols.split(",")) >= len(schema.fields):
            out.append(t.group(1))
    return out


def check_plan_shape(name, df) -> None:
    text = plan_text(df)
    for bad in FORBIDDEN:
        assert bad not in text, f"{name}: {bad} in plan"
    for line in text.splitlines():
        body = line.strip().lstrip("+-: ")
        if body.startswith("Window ["):
            assert "], [], [" not in body, f"{name}: unpartitioned window: {body[:200]}"
    # column pruning reaches every scan of a wide driver table
    assert not full_scans(text), f"{name}: reads every column of {full_scans(text)}"


def test_full_scan_guard_sees_an_unpruned_scan(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert full_scans(plan_text(li)) == ["lineitem"]
    assert full_scans(plan_text(li.select("l_orderkey"))) == []


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_quantity")
    text = plan_text(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in text
