"""Every registered query against its SQL, and the physical plans of all of them."""

import pytest

import check
from __spark_entry__ import entry
from cotejo.catalog import QUERIES, SQL
from conftest import plan_of

FOLDER = "/root/testdata/sf0.001"
# Queries whose feature finds nothing in so small a folder.
MAY_BE_EMPTY = {"range_overflow"}


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    assert check.compare(spark, con, FOLDER, name) == ("no rows on either side" if name in MAY_BE_EMPTY else "")


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_flagship(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_on_the_engine(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert node not in plan, node


def test_filters_reach_the_scan(spark):
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in _formatted(spark, "project_existing")


def _formatted(spark, name):
    return plan_of(QUERIES[name](spark, FOLDER))
