"""Every registered query against independent SQL."""

import pytest

import __spark_entry__ as registered
from checks.compare import compare, duck
from checks.fixtures import Warehouse
from tests.conftest import CHECKED, SMALL

SQL = registered.oracle.all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(CHECKED)


def test_every_query_has_sql():
    assert set(SQL) == set(registered.own_queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    rows, difference = compare(spark, CHECKED, registered.own_queries()[name], SQL[name], con)
    assert not difference
    assert rows > 0


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0
    assert SMALL  # entry reads the smallest folder


SOURCES = {
    "u01": "customer_master", "u02": "customer_master", "u03": "customer_master", "u04": "raw_order", "u05": "raw_order",
    "u06": "customer_master", "u07": "customer_master", "u08": "raw_address", "u09": "data_quality_log", "u10": "customer_master",
    "u11": "customer_master", "d01": "customer_master", "d02": "raw_order", "d03": "raw_order", "d04": "raw_address",
    "d05": "raw_customer", "d06": "customer_master", "d07": "raw_order_item", "d08": "customer_staging",
    "d09": "data_quality_log", "d11": "raw_address", "d12": "raw_order", "d13": "raw_order", "d15": "raw_order",
    "d16": "customer_master_dup", "d17": "raw_order_item", "d18": "customer_master", "d19": "data_quality_log",
    "d20": "customer_master",
}


@pytest.mark.parametrize("name", [n for n in sorted(SQL) if n[0] in "ud"])
def test_every_change_changes_something(spark, name):
    given = getattr(Warehouse(spark, CHECKED), SOURCES[name[:3]])()
    new = registered.own_queries()[name](spark, CHECKED)
    # The rebuilt customer table has no mark of deleted rows.
    both = [c for c in given.columns if c in new.columns]
    given, new = given.select(*both), new.select(*both)
    assert given.exceptAll(new).limit(1).count() + new.exceptAll(given).limit(1).count() > 0
