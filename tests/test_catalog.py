"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from cumulus.plans import catalog

from .test_plans import check_plan_shape

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


# Their SQL binds rows by name, which puts the columns of one side last.
UNORDERED_COLUMNS = {"union_by_name", "report_age_share"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return (0, "")
        if isinstance(x, (int, float)) and not isinstance(x, bool):
            return (1, round(float(x), 9))
        return (2, str(x)[:19] if hasattr(x, "isoformat") else str(x))
    return sorted(tuple(v(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "events_delta" in df.columns


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_plan_and_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    check_plan_shape(name, df)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle")
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    want = cur.fetchall()
    if name not in UNORDERED_COLUMNS:
        assert df.columns == cols
    assert canon(df.columns, rows) == canon(cols, want)


def test_events_last_day_equals_panel_max(spark):
    from pyspark.sql import functions as F
    from cumulus.plans import standins as S
    for sf in (SF, SF.replace("sf0.001", "sf0.01")):
        if not os.path.isdir(sf):
            continue
        panel_max = S.events_panel(spark, sf).agg(F.max("Date")).first()[0]
        raw = spark.range(1).select(S.events_last_day(spark, sf).alias("d")).first()[0]
        assert raw == panel_max


@pytest.mark.parametrize("package", ["xxhash", "numpy", "public_tokenizers", "tokenizers"])
def test_core_queries_work_without_a_package_of_the_text_operators(package):
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r}); sys.modules[{package!r}] = None\n"
            "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) >= len(catalog.QUERIES)
