"""Script scanning: files, lines, statements, tokens, edges."""

import pytest
from pyspark.sql import functions as F

from rowloom.functions.names import resolve, schema_part, table_part
from rowloom.operators.ranking import spread_ids
from rowloom.plans import lineage, lines, statements, tokens
from rowloom.sources import scripts


def files(spark, *contents):
    return spark.createDataFrame([(f"/x/f{i}.sql", c) for i, c in enumerate(contents)], "dir_file string, content string")


def texts(spark, content):
    return [r["query_text"] for r in statements.split_statements(files(spark, content)).orderBy("stmt_no").collect()]


def facts(spark, *contents):
    """(targets, sources) of each single-statement script."""
    out = lineage.statement_facts(statements.split_statements(files(spark, *contents)))
    return {r["dir_file"]: r for r in out.collect()}


def sources(spark, *contents):
    known = facts(spark, *contents)
    return [known[f"/x/f{i}.sql"]["sources"] for i in range(len(contents))]


def test_scan(spark, tmp_path, rows):
    (tmp_path / "a b+c").mkdir()
    (tmp_path / "a b+c" / "One.SQL").write_bytes(b"select 1;\r\nkey\xff_MST\n")
    (tmp_path / "two.hql").write_bytes("select '한글';".encode())
    (tmp_path / "three.txt").write_text("select 3;")
    (tmp_path / "empty.sh").write_text("")
    root = str(tmp_path)
    out = {r["dir_file"]: r["content"] for r in scripts.scan_scripts(spark, root).collect()}
    assert out == {
        f"{root}/a b+c/One.SQL": "select 1;\r\nkey_MST\n",
        f"{root}/two.hql": "select '한글';",
    }
    found = lines.script_keyword_lines(scripts.scan_lines(spark, root))
    assert rows(found) == [(f"{root}/a b+c", "One.SQL", f"{root}/a b+c/One.SQL", "key_mst", "key_MST")]


def test_variables(spark, tmp_path):
    path = tmp_path / "names.env"
    path.write_text("# c\n\nDW=dwh\nTMP = x\nA='one'\nB=\"two \"\nDW=dwh2\nbad line\nC=\n")
    variables = scripts.variable_map(scripts.scan_variables(spark, str(path)))
    assert spark.range(1).select(variables.alias("v")).first().v == {"DW": "dwh2", "A": "one", "B": "two", "C": ""}


def test_many_variables(spark, tmp_path):
    path = tmp_path / "names.env"
    path.write_text("".join(f"V{i}=s{i}\n" for i in range(12_000)))
    rows = spark.createDataFrame([("$V11999.a", "${V7}.b")], "source string, target string")
    found = lineage.with_resolved_names(rows, scripts.variable_map(scripts.scan_variables(spark, str(path)))).first()
    assert (found.src_schema, found.tgt_schema, found.src_table) == ("s11999", "s7", "a")


def test_hidden_and_empty_scripts(spark, tmp_path):
    (tmp_path / "_old").mkdir()
    for name, text in (("a.sql", "select 1;"), ("_b.sql", "x"), (".c.sql", "x"), ("_old/d.sql", "x"), ("e.SQL", ""), ("f.txt", "")):
        (tmp_path / name).write_text(text)
    root = str(tmp_path)
    assert scripts.list_scripts(spark, root) == scripts.Listing(scripts=5, empty=1, hidden=3)
    with pytest.raises(ValueError, match="3 scripts"):
        scripts.scan_scripts(spark, root)
    assert [r.dir_file for r in scripts.scan_scripts(spark, root, skip_hidden=True).collect()] == [f"{root}/a.sql"]


@pytest.mark.parametrize(
    "name, schema, table",
    [
        ("${DW}.t", "dwh", "t"),
        ("$DW.t.u", "dwh", "t.u"),
        ("${NO}.t", "${NO}", "t"),
        ("p_${DW}_$TMP", "", "p_dwh_tmp"),
        ("$NO", "", "$NO"),
        ("${VIA}.t", "dwh", "t"),
        ("t", "", "t"),
        ("", "", ""),
    ],
)
def test_resolved_names(spark, name, schema, table):
    resolved = resolve(F.col("n"), {"DW": "dwh", "TMP": "tmp", "VIA": "$DW"})
    row = spark.createDataFrame([(name,)], "n string").select(schema_part(resolved), table_part(resolved)).first()
    assert tuple(row) == (schema, table)


def test_keyword_lines(spark, rows):
    df = files(spark, "　 a DEFAULT b\x0b\r\nKey_Mst default\rnothing\n")
    assert rows(lines.keyword_lines(lines.lines_with(df, lines.KEYWORDS))) == [
        ("/x/f0.sql", "default", "Key_Mst default"),
        ("/x/f0.sql", "default", "a DEFAULT b"),
        ("/x/f0.sql", "key_mst", "Key_Mst default"),
    ]
    assert rows(lines.keyword_lines(lines.lines_with(df, ["DEFAULT"], True), ["DEFAULT"], True)) == [
        ("/x/f0.sql", "DEFAULT", "a DEFAULT b")
    ]


def test_clean_text(spark):
    content = (
        "  # shell\n\n\tdbms_output.put('x');\n /* one line */ \nSELECT '--no' || '/* no */', \"#\" -- yes\n"
        "/* two\nlines */ FROM t; it's -- odd\n/* a */ b /* c */\n/*/\n"
    )
    [row] = files(spark, content).select(statements.clean_text(F.col("content")).alias("c")).collect()
    assert row["c"] == "\nSELECT '--no' || '/* no */', \"#\" \n FROM t; it's \n"


def test_statement_split(spark):
    assert texts(spark, "x SELECT 1 FROM t WHERE a = 'b;c';  with no end") == ["SELECT 1 FROM t WHERE a = 'b;c';"]
    assert texts(spark, "UPDATED; unselect 1; select 2 from t;") == ["select 2 from t;"]
    assert texts(spark, "create or replace global temporary view v as select 1 from a;") == [
        "create or replace global temporary view v as select 1 from a;"
    ]
    # Only the start word of an open quote is lost.
    assert texts(spark, "INSERT INTO a VALUES ('x; DELETE FROM b;") == ["DELETE FROM b;"]


def test_dynamic_statements_come_last(spark):
    content = "EXECUTE IMMEDIATE 'INSERT INTO a SELECT ''x'' FROM b'; TRUNCATE TABLE c; execute immediate '  ';"
    assert texts(spark, content) == ["TRUNCATE TABLE c;", "INSERT INTO a SELECT 'x' FROM b"]


def test_left_out_statements(spark):
    assert texts(spark, "SELECT sysdate FROM dual; select extract(year from d) from DUAL;") == []
    kept = "SELECT a FROM t UNION SELECT 1 FROM DUAL;"
    assert texts(spark, kept) == [kept]
    assert texts(spark, "SELECT * FROM SIDTEST.ad1901_rgb_ac190212_svc;") == []
    own = statements.split_statements(files(spark, "SELECT * FROM my.t;"), excluded=["MY.T"])
    assert own.count() == 0


def test_many_literals_in_one_statement(spark):
    content = "INSERT INTO t VALUES (" + ",".join("'it''s'" for _ in range(60_000)) + ");"
    assert texts(spark, content) == [content]


@pytest.mark.parametrize(
    "text, kind, crud",
    [
        ("insert into a select 1;", "INSERT", "C"),
        ("WITH x AS (SELECT 1) SELECT * FROM x;", "SELECT", "R"),
        ("WITH x AS (SELECT 1) DELETE FROM y;", "DELETE", "D"),
        ("WITH x AS (SELECT 'insert') SELECT * FROM x;", "SELECT", "R"),
        ("SELECT 1 FROM a INSERT INTO b;", "INSERT", "C"),
        ("SELECT f(INSERT) FROM a;", "SELECT", "R"),
        ("SELECT 1) INSERT INTO b;", "INSERT", "C"),
        ("BEGIN x := 1; UPDATE t SET a = 1; END;", "UPDATE", "U"),
        ("DECLARE x;", "UNKNOWN", "R"),
        ("TRUNCATE TABLE a;", "TRUNCATE", "D"),
        ("ALTER TABLE a ADD b;", "ALTER", "U"),
        ("EXECUTE p;", "EXECUTE", "C"),
        ("UPSERT INTO a;", "UPSERT", "C"),
        ("", "UNKNOWN", "R"),
    ],
)
def test_statement_kinds(spark, text, kind, crud):
    df = spark.createDataFrame([(text,)], "query_text string")
    row = statements.classify(df).first()
    assert (row["sql_type"], row["crud_type"]) == (kind, crud)


def test_sources(spark):
    cases = {
        # Lists, joins, subqueries at any depth.
        "SELECT * FROM a, b x, c AS y JOIN d ON 1 = 1;": ["a", "b", "c", "d"],
        "SELECT * FROM (SELECT * FROM (SELECT * FROM s.a) q) r, b;": ["b", "s.a"],
        "SELECT (SELECT max(x) FROM a), b FROM c;": ["a", "c"],
        "SELECT a FROM t UNION (SELECT b FROM u);": ["t", "u"],
        "SELECT coalesce((SELECT x FROM a), 0) FROM b;": ["a", "b"],
        # Words that are no source.
        "SELECT extract(year FROM d), trim(both 'x' FROM e) FROM t WHERE a IS DISTINCT FROM b;": ["t"],
        "SELECT valid_from from_date, x FROM t WHERE is_on = 1;": ["t"],
        "CREATE TABLE n (a int) USING PARQUET;": [],
        "SELECT * FROM t JOIN u USING (k) WHERE a IN ('FROM v');": ["t", "u"],
        "INSERT INTO t (a, b) VALUES (1, 2);": [],
        "SELECT a FROM t GROUP BY a, b ORDER BY c, d;": ["t"],
        "SELECT * FROM t CLUSTER BY a, b;": ["t"],
        "SELECT * FROM t LATERAL VIEW explode(x) e AS c1, c2;": ["t"],
        # Changes.
        "MERGE INTO a USING b ON a.k = b.k;": ["b"],
        "DELETE FROM a USING b, c WHERE 1 = 1;": ["a", "b", "c"],
        "UPDATE a SET x = (SELECT y FROM b) FROM c;": ["b", "c"],
        # Names.
        "SELECT * FROM `d`.`t`, ${S}.u, $V, 한글.표, 1x, a@link;": ["$V", "${S}.u", "`d`.`t`", "a@link", "한글.표"],
        # Stray brackets do not shift depths.
        "SELECT 1 ) FROM a, b;": ["a", "b"],
    }
    assert sources(spark, *cases) == list(cases.values())


def test_with_names(spark):
    cases = {
        "INSERT INTO t WITH a AS (SELECT * FROM x), b AS (SELECT * FROM a JOIN y ON 1=1) SELECT * FROM b;": (
            ["A", "B"], {("A", "x"), ("B", "a"), ("B", "y"), (None, "b")},
        ),
        "WITH RECURSIVE a (k, v) AS (SELECT * FROM x), b(k) AS (SELECT (1) FROM a) SELECT * FROM b, z;": (
            ["A", "B"], {("A", "x"), ("B", "a"), (None, "b"), (None, "z")},
        ),
        "CREATE VIEW v AS (WITH a AS (SELECT * FROM x) SELECT * FROM a);": (["A"], {("A", "x"), (None, "a")}),
        "SELECT sum(x) OVER w1 FROM t WINDOW w1 AS (ORDER BY a), w2 AS (ORDER BY b);": ([], {(None, "t")}),
    }
    known = facts(spark, *cases)
    for i, (ctes, reads) in enumerate(cases.values()):
        row = known[f"/x/f{i}.sql"]
        assert row["ctes"] == ctes
        assert {(r["owner"], r["name"]) for r in row["reads"]} == reads


def test_targets(spark):
    cases = {
        "INSERT OVERWRITE TABLE a PARTITION (d) SELECT 1;": ["a"],
        "INSERT INTO a(x) VALUES (1);": ["a"],
        "CREATE TABLE IF NOT EXISTS s.a AS SELECT 1;": ["s.a"],
        "ALTER VIEW v AS SELECT 1;": ["v"],
        "REPLACE VIEW v AS SELECT 1;": ["v"],
        "UPSERT INTO u VALUES (1);": ["u"],
        "MERGE a USING b ON 1=1 WHEN MATCHED THEN UPDATE SET x = 1;": ["a"],
        "CREATE TABLE c (x int REFERENCES p ON UPDATE CASCADE);": ["c"],
        "SELECT * FROM t WHERE a = 'update the' FOR UPDATE NOWAIT;": [],
        "DROP VIEW IF EXISTS v;": ["v"],
        "INSERT INTO \"S\".\"T\" SELECT 1;": ["\"S\".\"T\""],
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, q string")
    out = {r["i"]: r["t"] for r in df.select("i", lineage.target_names(F.col("q")).alias("t")).collect()}
    assert [out[i] for i in range(len(cases))] == list(cases.values())


def edge_rows(spark, content, mode):
    out = lineage.edges(statements.split_statements(files(spark, content)), mode)
    return {(r["source"], r["target"], r["depth"]) for r in out.collect()}


def test_edges(spark):
    text = (
        "INSERT INTO t WITH a AS (SELECT * FROM x), b AS (SELECT * FROM a, a), c AS (SELECT * FROM b, x) SELECT * FROM c;"
    )
    simple = {("x", "t", 1)}
    assert edge_rows(spark, text, "SIMPLE") == simple
    # Inner reads count as reads of the statement, so every name feeds the target.
    assert edge_rows(spark, text, "DETAIL") == simple | {
        ("x", "A", 1), ("a", "B", 2), ("b", "C", 3), ("x", "C", 3), ("a", "t", 2), ("b", "t", 3), ("c", "t", 4),
    }
    with pytest.raises(ValueError):
        edge_rows(spark, text, "OTHER")


def test_edges_with_a_side_missing(spark):
    assert edge_rows(spark, "SELECT * FROM a;", "DETAIL") == {("a", None, 1)}
    assert edge_rows(spark, "DROP TABLE a;", "DETAIL") == {(None, "a", 1)}
    assert edge_rows(spark, "SELECT 1;", "DETAIL") == set()
    # Only a WITH name is read: a row without names, and nothing more without a target.
    assert edge_rows(spark, "WITH a AS (SELECT 1) SELECT * FROM a;", "DETAIL") == {(None, None, 1)}
    # Nothing is read at all: every WITH name counts as feeding the target.
    assert edge_rows(spark, "INSERT INTO t WITH a AS (SELECT 1) SELECT 2;", "DETAIL") == {(None, "t", 1), ("A", "t", 2)}


def test_temporary_names_win_over_tables_and_lose_to_with_names(spark):
    df = files(
        spark,
        "CREATE TEMP TABLE tt AS SELECT 1 FROM src;",
        "INSERT INTO o WITH TT AS (SELECT 1 FROM i) SELECT * FROM tt; INSERT INTO o SELECT * FROM Tt;",
    )
    out = lineage.lineage(
        statements.split_statements(df), statements.temp_objects(df), {}, "DETAIL", "r", "2024-01-01 00:00:00"
    )
    types = {(r["source_table"], r["target_table"]): (r["source_type"], r["target_type"]) for r in out.collect()}
    assert types[("src", "tt")] == ("TABLE", "TEMP")
    assert types[("tt", "o")] == ("CTE", "TABLE")
    assert types[("Tt", "o")] == ("TEMP", "TABLE")


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "dir_file string, content string")
    cut = statements.split_statements(df)
    assert lineage.edges(cut, "DETAIL").count() == 0
    assert statements.query_text(cut, "2024-01-01 00:00:00").count() == 0
    summary = lineage.run_summary(df).first().asDict()
    assert set(summary.values()) == {0}


def test_ids_are_consecutive(spark):
    df = spark.range(300).selectExpr("concat('f', id % 40) AS f", "id")
    df = df.selectExpr("f", "CAST(row_number() OVER (PARTITION BY f ORDER BY id) AS INT) AS n")
    out = spread_ids(df, "f", "n", "id", digits=1).collect()
    assert sorted(r["id"] for r in out) == list(range(1, 301))
    by_file = {}
    for r in out:
        by_file.setdefault(r["f"], set()).add(r["id"] - r["n"])
    assert all(len(v) == 1 for v in by_file.values())


def test_lineage_plan_has_no_python_and_one_exchange_of_tokens(spark):
    df = files(spark, "SELECT * FROM a;")
    plan = tokens.reads_and_ctes(statements.split_statements(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert plan.count("Exchange") == 1
