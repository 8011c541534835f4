"""The projections' scans: two dates pushed down, the history read twice."""

import re

import pytest
from pyspark.sql import functions as F

from cumulus.operators.snapshots import two_snapshots
from cumulus.plans import reports as R, standins as S

from .snapshots_fixture import AS_OF, dim, history


@pytest.fixture(scope="module")
def stored_history(spark):
    return S.stored(history(spark), "history_scans")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_snapshots_pushes_two_dates(spark, stored_history):
    text = plan(two_snapshots(stored_history, latest=AS_OF))
    assert re.search(r"PushedFilters: \[.*In\(Date, \[2021-07-14,2021-07-21\]\)", text) \
        or re.search(r"PushedFilters: \[.*In\(Date, \[2021-07-21,2021-07-14\]\)", text)


def history_scans(df) -> int:
    """Scans of the history in the plan that ran; a reused one counts once."""
    df.collect()
    text = plan(df)
    text = text.partition("== Initial Plan ==")[0] if "== Initial" in text else text
    return len(re.findall(r"FileScan parquet \[[^\]]*Location", text))


@pytest.mark.parametrize("name", ["target", "supply"])
def test_projection_scans_the_history_at_most_twice(spark, stored_history, name):
    if name == "target":
        out = R.report_target(stored_history, None, dim(spark), F.lit(AS_OF), latest=AS_OF)
    else:
        out = R.report_supply(stored_history, dim(spark), F.lit(AS_OF), latest=AS_OF)
    logical = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[", logical)) >= 1
    assert history_scans(out) <= 2
