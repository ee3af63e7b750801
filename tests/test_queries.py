"""Every registered query against its SQL on the smallest tables, and what its plan must not contain.

Spark's own broadcasts are switched off, as if every table were large; explicit, bounded ones stay.
"""

import re

import pytest
from compare import connect, diff

from scoreloom.plans.catalog import ORACLES, QUERIES

ALLOWED_SINGLE = {
    # each of these brings only a small, bounded table to one place
    "w05_percentile_rank",  # histogram of whole scores
    "l01_recent_events", "l02_archive_page", "a14_l03_listing",  # a page of n rows
    "a04_positions",  # sums over files
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module", autouse=True)
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def main_plan(df):
    """The main plan; a scalar subquery ends in one aggregate row by nature."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"Subquery(?:.|\n)*", "", text) if "Subquery " in text else text


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    text = main_plan(df)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text
    assert name in ALLOWED_SINGLE or "SinglePartition" not in text
    assert diff(df, con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
