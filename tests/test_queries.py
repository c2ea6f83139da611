"""Every registered query against its SQL, on the smallest shared tables."""

import os

import pytest

import __spark_entry__ as driver
from checks import compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="shared tables are not here")


@pytest.fixture(scope="module")
def db():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    found = compare.difference(spark, db, driver.queries()[name], driver.oracle_sql()[name], FOLDER)
    assert found is None, found


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 200 and all(r.status for r in rows)
    assert any(r.status.startswith("Rank #") for r in rows)


def test_scan_reads_only_what_it_needs(spark):
    from checks import views

    plan = views.universe(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" in plan and "l_comment" not in plan and "l_shipdate" not in plan
