"""Every registered query against its SQL, and what the others return."""

import parity
import pytest

from codexflow.plans.registry import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, con, name):
    assert parity.difference(QUERIES[name](spark, SF_DIR), con, ORACLE_SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).columns == ["doc_id", "score"]
