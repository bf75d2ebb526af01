"""Many words in many texts, against the plain search."""

import random
import time

import pytest
from pyspark.sql import functions as F

from rowloom.operators import wordsearch
from rowloom.plans import lines


def plain(texts, words, case_sensitive):
    def look(s):
        return s if case_sensitive else s.lower()

    return sorted(
        (n, t, w) for n, t in texts if t is not None for w in {w for w in words if w} if look(w) in look(t)
    )


@pytest.fixture(scope="module")
def many():
    rng = random.Random(2)
    letters = "abcdeABé "
    texts = [(n, "".join(rng.choices(letters, k=rng.choice([0, 1, 3, 10, 60])))) for n in range(300)]
    texts += [(300, None), (301, "the very same line"), (301, "the very same line"), (302, "x" * 500), (303, "line\twith\x00odd İ ß")]
    words = ["".join(rng.choices(letters, k=rng.randint(1, 6))) for _ in range(400)]
    words += [None, "", "the", "same", "THE VERY SAME LINE", "the", "xxxxx", "x", "xx", "not there at all", "odd İ"]
    return texts, words


@pytest.mark.parametrize("case_sensitive", [False, True])
@pytest.mark.parametrize("share", [0.0, 1.0])
def test_equals_the_plain_search(spark, many, case_sensitive, share):
    texts, words = many
    df = spark.createDataFrame(texts, "n int, line string").repartition(4)
    table = spark.createDataFrame([(w,) for w in words], "w string")
    got = wordsearch.find_words(df, table, "line", case_sensitive, share)
    # Lower case of Spark and Python differs for dotted capitals only.
    want = [(n, t, w) for n, t, w in plain(texts, words, case_sensitive) if case_sensitive or "İ" not in w]
    found = [tuple(r) for r in got.collect()]
    assert sorted(f for f in found if case_sensitive or "İ" not in f[2]) == want


def test_without_a_broadcast(spark, many):
    texts, words = many
    df = spark.createDataFrame(texts, "n int, line string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = wordsearch.find_words(df, spark.createDataFrame([(w,) for w in words], "w string"), case_sensitive=True)
        assert sorted(tuple(r) for r in found.collect()) == plain(texts, words, True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_no_words_and_no_texts(spark):
    texts = spark.createDataFrame([(1, "a")], "n int, line string")
    none = spark.createDataFrame([(None,), ("",)], "w string")
    assert wordsearch.find_words(texts, none).collect() == []
    assert wordsearch.find_words(texts.limit(0), spark.createDataFrame([("a",)], "w string")).collect() == []


def test_ten_thousand_words_in_one_pass(spark, tmp_path):
    """The texts are scanned once for the search and once for the sample, however many words there are."""
    path = str(tmp_path / "texts")
    spark.range(20_000).select("id", F.concat_ws(" ", *[F.md5((F.col("id") * 5 + i).cast("string")) for i in range(3)]).alias("line")).write.parquet(path)
    texts = spark.read.parquet(path)
    words = spark.range(10_000).select(F.substring(F.md5((F.col("id") * 7).cast("string")), 3, 9).alias("w"))
    got = lines.keyword_table_lines(texts, words)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("texts") == 1 and "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan
    # A word of the list comes from one of the texts' own hashes wherever the numbers meet.
    want = {(n // 5, n) for n in range(0, 70_000, 7) if n % 5 < 3 and n // 5 < 20_000}
    found = {(r.id, r.keyword) for r in got.collect()}
    import hashlib

    assert {(i, hashlib.md5(str(n).encode()).hexdigest()[2:11]) for i, n in want} <= found


def test_one_very_long_line(spark):
    """A letter is not looked up by its number in the whole text: that took minutes here."""
    body = "abcdefg hij " * 20_000
    line = f"first{body}middle word{body}last"
    texts = spark.createDataFrame([(1, line), (2, "Last")], "n int, line string")
    words = ["first", "FIRSTab", "middle word", "dle wo", "g hij a", "ast", "last", "t", "j m", "none", "lasts", " " * 40, "g hij abc" * 20]
    began = time.monotonic()
    found = wordsearch.find_words(texts, spark.createDataFrame([(w,) for w in words], "w string")).select("n", "word").collect()
    assert time.monotonic() - began < 100
    assert sorted(map(tuple, found)) == sorted((n, w) for n, t in ((1, line), (2, "last")) for w in words if w.lower() in t)


def test_words_over_the_ends_of_pieces(spark):
    """A pair comes once, also if a word stands again where another piece begins, or begins with what a text is filled up with."""
    whole = ["𝄞é" * 10 + " " * n + " ab cd ef" * 9 + " ab" for n in range(8, 50, 3)]
    texts = [(n, t) for n, t in enumerate([*whole, *[t[n + 20 :] for n, t in enumerate(whole)], "ab cd"])]
    words = [" ab", "ab", " ab cd ef", "cd ef ab cd", "é ", "𝄞é𝄞", " ", "  ", " ab cd ef" * 9, "  ab"]
    table = spark.createDataFrame([(w,) for w in words], "w string")
    found = wordsearch.find_words(spark.createDataFrame(texts, "n int, line string"), table, case_sensitive=True)
    assert sorted(tuple(r) for r in found.collect()) == plain(texts, words, True)


def test_the_same_as_keyword_lines(spark):
    df = spark.createDataFrame([("f", " a Default key_mst "), ("g", "none"), ("f", "DEFAULT")], "dir_file string, line string")
    few = lines.keyword_lines(df).select("dir_file", "keyword", "line").collect()
    words = spark.createDataFrame([(w,) for w in lines.KEYWORDS], "w string")
    assert sorted(few) == sorted(lines.keyword_table_lines(df, words).select("dir_file", "keyword", "line").collect())


@pytest.mark.parametrize(
    "case_sensitive, share, alone, most", [(False, 0.0, 256, 64), (True, 0.2, 0, 64), (False, 0.2, 256, 2), (False, 1.0, 256, 64), (True, 1.0, 1, 2)]
)
def test_texts_of_tokens(spark, monkeypatch, case_sensitive, share, alone, most):
    """Words stand in common tokens, in others, in long ones and in most texts; a pair comes once whichever way it is found."""
    monkeypatch.setattr(wordsearch, "ALONE", alone)
    monkeypatch.setattr(wordsearch, "MOST", most)
    rng = random.Random(5)
    tokens = ["".join(rng.choices("abcdeABé", k=rng.choice([1, 2, 3, 5, 9]))) for _ in range(150)]
    tokens += ["ab" * 40 + "cd", "e" * 70, "a" * 33 + "é" + "b" * 40]
    texts = [(n, "".join(rng.choice(tokens) + rng.choice([" ", ". ", "\n", "\x00", "--", "ß", "7"]) for _ in range(rng.choice([0, 1, 8, 40])))) for n in range(120)]
    texts += [(200, None), (201, ""), (202, " . "), (203, tokens[0]), (203, tokens[0]), (204, "\x00ab\x00\x00AB")]
    words = ["".join(rng.choices("abcdeABé", k=rng.randint(1, 7))) for _ in range(300)] + ["a", "A", "e" * 65, "abcd", None, ""]
    df = spark.createDataFrame(texts, "n int, line string").repartition(3)
    got = wordsearch.find_words(df, spark.createDataFrame([(w,) for w in words], "w string"), "line", case_sensitive, share)
    assert sorted(tuple(r) for r in got.collect()) == plain(texts, words, case_sensitive)


def rows_made(df):
    """The rows that each Generate of the executed plan made, from the last one to the first."""
    df.collect()
    made = []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            return walk(node.plan())
        if node.nodeName() == "Generate":
            made.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return made


def test_common_tokens_are_not_searched_again(spark, tmp_path):
    """The search makes rows for the tokens of a text, not for each of its letters and sizes of gram."""
    tokens = [f"{a}{b}{c}tion" for a in ("con", "re", "trans") for b in ("struc", "la", "forma") for c in ("", "ver")]
    texts = [(n, " ".join(tokens[n % 5 :] * 2)) for n in range(2000)]
    path = str(tmp_path / "texts")
    spark.createDataFrame(texts, "n int, line string").write.parquet(path)
    words = ["tion", "con", "format", "re", "la", "s", "verti", "none"]
    table = spark.createDataFrame([(w,) for w in words], "w string")
    got = wordsearch.find_words(spark.read.parquet(path), table, case_sensitive=True)
    assert sorted(tuple(r) for r in got.collect()) == plain(texts, words, True)
    assert max(rows_made(got)) < 2000 * 2 * len(tokens) < sum(len(t) for _, t in texts) / 5


def test_one_file_is_searched_by_many_tasks(spark, tmp_path):
    """A file of one row group is one task of the scan; the words are looked for in as many as the session deals."""
    import __spark_entry__ as registered

    docs = [(n if n % 9 else None, f"line {n}\nof ink {n % 7}\n\nInk" if n % 5 else None) for n in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    words = spark.createDataFrame([(1, "line ink, IN e 7"), (2, None), (3, "nowhere Ink")], "item_id int, text string")
    words.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = registered.queries()["l02_keyword_table"](spark, str(tmp_path))
    found = {}
    for i, t in docs:
        for line in (t or "").split("\n") if t is not None else []:
            for w in {"line", "ink", "IN", "e", "nowhere", "Ink"}:
                if w.lower() in line.lower():
                    found.setdefault(w, []).append(i)
    assert sorted(tuple(r) for r in got.collect()) == sorted((w, len(d), len({*d} - {None})) for w, d in found.items())
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "REPARTITION_BY_NUM" in plan
