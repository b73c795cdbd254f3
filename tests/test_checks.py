"""Every named query gives the rows its SQL gives."""

import pytest

import comparing
from tablewright.checks import CHECKS, load

load()


@pytest.fixture(scope="module")
def con():
    return comparing.duck()


@pytest.mark.parametrize("name", list(CHECKS))
def test_check(spark, con, name):
    check = CHECKS[name]
    assert check.sql, f"{name} has no SQL"
    assert comparing.compare(spark, con, check) > 0


def test_entry(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).columns == ["host", "urls"]
