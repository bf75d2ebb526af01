"""Long statements in pieces give the token table of plain windows."""

import random

import pytest
from pyspark.sql import functions as F

from checks.fixtures import Warehouse
from rowloom.plans import lineage, statements, tokens
from rowloom.sources.tables import kept
from tests.conftest import SMALL

WORDS = ["WITH", "SELECT", "FROM", "JOIN", "a.b", "c1", "c2", "AS", "(", ")", "(", ")", ",", "USING", "INSERT", "DISTINCT", "x", "ON",
         "RECURSIVE", "sum", "WHERE", ";", "''", "UNION"]


def texts(seed, n=40):
    rng = random.Random(seed)
    rows = [("/f", i, " ".join(rng.choices(WORDS, k=rng.choice([0, 1, 5, 60, 300])))) for i in range(n)]
    chain = ", ".join(f"n{i} AS (SELECT * FROM (SELECT f(x FROM y) FROM n{i - 1}, t{i}) q JOIN u{i} USING (k))" for i in range(60))
    return [*rows, ("/g", 1, f"INSERT INTO z WITH {chain} SELECT * FROM n59"), ("/g", 2, ") ) WITH c (a, b) AS (SELECT 1 FROM d) SELECT ( ( FROM c")]


@pytest.mark.parametrize("piece", [1, 7, 100])
@pytest.mark.parametrize("long", [0, 150])
def test_same_token_table(spark, rows, monkeypatch, piece, long):
    monkeypatch.setattr(tokens, "PIECE", piece)
    df = kept(spark.createDataFrame(texts(piece + long), "dir_file string, stmt_no int, query_text string"), "statements")
    want = tokens.token_table(df)
    got = tokens.token_table(df, long)
    assert got.columns == want.columns
    assert rows(got) == rows(want) and want.count() > 1000
    assert rows(tokens.reads_and_ctes(df, long).withColumn("reads", F.sort_array("reads"))) == rows(
        tokens.reads_and_ctes(df).withColumn("reads", F.sort_array("reads"))
    )


def test_same_lineage_of_the_scripts(spark, rows, monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 5)
    files = Warehouse(spark, SMALL).scripts()
    stored, temps = statements.scan_once(files)
    plain = lineage.lineage(stored, temps, {}, "DETAIL", "r", "2024-01-01 00:00:00", long=None)
    cut = lineage.lineage(stored, temps, {}, "DETAIL", "r", "2024-01-01 00:00:00", long=60)
    assert rows(plain) == rows(cut) and plain.count() > 60


def test_no_piece_is_large(spark, monkeypatch):
    """One generated statement of 200,000 tokens beside small ones: its rows are spread over pieces."""
    monkeypatch.setattr(tokens, "PIECE", 10_000)
    body = " UNION ALL ".join(f"SELECT a FROM t{i}" for i in range(40_000))
    df = kept(spark.createDataFrame([("/f", 1, body), ("/f", 2, "SELECT 1 FROM x")], "dir_file string, stmt_no int, query_text string"), "s")
    table = tokens.tokens(df.filter("stmt_no = 1"), True)
    sizes = [r["count"] for r in table.groupBy("__piece").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 10_000
    reads = tokens.reads_and_ctes(df, 1000).filter("stmt_no = 1").select(F.size("reads")).first()[0]
    assert reads == 40_000


def test_statements_and_temporary_names_come_from_one_pass(spark, rows):
    files = Warehouse(spark, SMALL).scripts()
    files = files.unionByName(spark.createDataFrame([(None, "CREATE TEMP TABLE nowhere (a INT);"), ("/e.sql", "")], "dir_file string, content string"))
    stored, temps = statements.scan_once(files)
    assert rows(stored) == rows(statements.split_statements(files))
    assert rows(temps) == rows(statements.temp_objects(files)) and temps.count() > 1
    plan = lineage.lineage(stored, temps, {}, "SIMPLE", "r", "2024-01-01 00:00:00")._jdf.queryExecution().executedPlan().toString()
    # Nothing after the pass reads a script.
    assert SMALL not in plan
