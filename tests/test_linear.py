"""Text passes whose time must grow with the text, not with its square."""

import random
import time

import pytest
from pyspark.sql import functions as F

from rowloom.plans import lineage, statements


def seconds(spark, content: str) -> float:
    one = spark.createDataFrame([("/x/a.sh", content)], "dir_file string, content string").cache()
    one.count()
    best = 1e9
    for _ in range(2):
        started = time.perf_counter()
        statements.split_statements(one).agg(F.count(F.lit(1))).collect()
        best = min(best, time.perf_counter() - started)
    one.unpersist()
    return best


@pytest.mark.parametrize(
    "line", ["hdfs dfs -rm /data/in/x/* -- note 'q'\n", "select a from t where x = 1 order by a_long_name, another\n"]
)
def test_long_scripts(spark, line):
    small, large = (seconds(spark, line * (n // len(line))) for n in (1_000_000, 5_000_000))
    assert large < 10 and large < 12 * small + 2


def test_open_block_is_kept(spark):
    texts = ["a /* b */ c /* d -- e\n'--f' -- g\n/* h", "/*/ x", "'/* ' -- y\n/* '*/ z /*", "x '/*' \" */ \" /* -- 1\n2"]
    df = spark.createDataFrame([(t,) for t in texts], "c string").select(statements.clean_text(F.col("c")).alias("c"))
    assert [r.c for r in df.collect()] == ["a  c /* d \n'--f' \n/* h", "/*/ x", "'/* ' \n z /*", "x '/*' \" */ \" /* \n2"]


@pytest.mark.parametrize("blanks", [1, 9, 10, 50])
def test_on_update_is_no_target(spark, blanks):
    text = f"CREATE TABLE c (k INT REFERENCES d ON{' ' * blanks}UPDATE CASCADE); "
    one = spark.createDataFrame([(text, "SELECT a FROM b FOR\n\tUPDATE OF a")], "a string, b string")
    row = one.select(lineage.target_names(F.col("a")), lineage.target_names(F.col("b"))).first()
    assert list(row) == [["c"], []]


@pytest.mark.parametrize(
    "body, depths",
    [
        ("a AS (SELECT * FROM b), b AS (SELECT * FROM x)", {"A": 2, "B": 1}),
        ("a AS (SELECT * FROM a)", {"A": 2}),
        ("a AS (SELECT * FROM b), b AS (SELECT * FROM a)", {"A": 2, "B": 2}),
        ("a AS (SELECT * FROM d), b AS (SELECT * FROM a), c AS (SELECT 1), d AS (SELECT * FROM c)", {"A": 3, "B": 4, "C": 1, "D": 2}),
        ("a AS (SELECT * FROM b), b AS (SELECT * FROM c JOIN b), c AS (SELECT * FROM x)", {"A": 3, "B": 2, "C": 1}),
        # Two rings, one above the other, and names above and below them.
        (
            "a AS (SELECT * FROM b), b AS (SELECT * FROM a, d), c AS (SELECT * FROM a), d AS (SELECT * FROM e), "
            "e AS (SELECT * FROM f, d), f AS (SELECT * FROM g), g AS (SELECT 1), h AS (SELECT * FROM c, g)",
            {"A": 2, "B": 3, "C": 3, "D": 2, "E": 3, "F": 2, "G": 1, "H": 4},
        ),
    ],
)
def test_depth_in_any_order(spark, body, depths):
    files = spark.createDataFrame([("/x/a.sql", f"WITH {body} SELECT * FROM a;")], "dir_file string, content string")
    facts = lineage.statement_facts(statements.split_statements(files))
    assert facts.select(lineage.cte_depths().alias("d")).first().d == depths


def plain_depths(reads):
    """Depths of names 0 to n - 1 from the names each one reads: rings count as 1 to themselves."""
    reach = {c: set(r) for c, r in reads.items()}
    for k in reads:
        for c in reads:
            if k in reach[c]:
                reach[c] |= reach[k]
    depth = dict.fromkeys(reads, 1)
    for _ in reads:
        depth = {c: 1 + max([1 if c in reach[s] else depth[s] for s in r], default=0) for c, r in reads.items()}
    return depth


@pytest.mark.parametrize("seed", range(12))
def test_depths_of_random_lists(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([1, 2, 6, 25])
    reads = {c: sorted({rng.randrange(n) for _ in range(rng.choice([0, 0, 1, 1, 2, 3]))}) for c in range(n)}
    if seed % 3:
        # Without rings, in an order of their own.
        place = rng.sample(range(n), n)
        reads = {c: [s for s in r if place[s] < place[c]] for c, r in reads.items()}
    rows = [([f"C{c}" for c in range(n)], [(f"C{c}", f"c{s}") for c, r in reads.items() for s in r] + [(None, "c0"), ("C0", "x")])]
    df = spark.createDataFrame(rows, "ctes array<string>, reads array<struct<owner:string,name:string>>")
    got = df.select(lineage.cte_depths().alias("d")).first().d
    assert got == {f"C{c}": d for c, d in plain_depths(reads).items()}


@pytest.mark.parametrize("order", ["written", "reversed"])
def test_long_chains_of_names(spark, order):
    def seconds_for(n):
        names = [f"C{i}" for i in range(n)]
        reads = [(f"C{i}", f"c{i - 1}") for i in range(1, n)]
        rows = [(names if order == "written" else names[::-1], reads)]
        df = spark.createDataFrame(rows, "ctes array<string>, reads array<struct<owner:string,name:string>>").cache()
        df.count()
        best = 1e9
        for _ in range(3):
            started = time.perf_counter()
            found = df.select(lineage.cte_depths().alias("d")).first().d
            best = min(best, time.perf_counter() - started)
        assert found == {f"C{i}": i + 1 for i in range(n)}
        df.unpersist()
        return best

    one, two = seconds_for(1000), seconds_for(2000)
    assert one < 2 and two < 3 * one + 0.5
