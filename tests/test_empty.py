"""Every registered query on empty tables."""

import pytest

import __spark_entry__ as registered
from rowloom.sources.tables import SCHEMAS

OTHERS = {
    "customer_master_dup": SCHEMAS["customer_master"],
    "scripts": "dir_file string, content string",
    "documents": "doc_id bigint, text string",
    "benchmark": "item_id bigint, text string",
}


class Empty:
    """The tables of a warehouse without a row."""

    def __init__(self, spark, folder):
        self.spark = spark

    def __getattr__(self, name):
        return lambda: self.spark.createDataFrame([], {**SCHEMAS, **OTHERS}[name])


@pytest.mark.parametrize("name", sorted(registered.own_queries()))
def test_empty_input(spark, monkeypatch, name):
    monkeypatch.setattr(registered, "Warehouse", Empty)
    found = registered.own_queries()[name](spark, "nowhere").collect()
    assert len(found) == (1 if name == "l23_run_summary" else 0)
