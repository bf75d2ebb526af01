import math
from collections import Counter

from pyspark.sql import functions as F

from rowloom.llm.quality_rules import apply_rules, binomial_tail
from tests.llm.fixtures import WORD, empty_docs, labels, odd_docs, odd_texts


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeat = len(covered)
    failed = len(words) < 20 or 100 * repeat > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat, failed,
    )


def test_odd_rows_against_plain_counts(spark):
    rows = apply_rules(odd_docs(spark), labels(spark)).collect()
    got = sorted((r.doc_id or -99, *tuple(r)[1:7]) for r in rows)
    assert got == sorted((d or -99, *counts(t)) for d, t, *_ in odd_texts())
    assert all(not r.kept for r in rows if r.base_failed)
    assert apply_rules(empty_docs(spark), labels(spark)).collect() == []
    rows = apply_rules(odd_docs(spark), labels(spark, [])).collect()
    assert all(r.kept != r.base_failed for r in rows)


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 5, 300, 4000, 10**6) for k in sorted({0, 1, n // 200, n // 120, n // 101}) if k < n * 0.01]
    df = spark.createDataFrame(cases, "k long, n long").withColumn("t", binomial_tail(F.col("k"), F.col("n"), 0.01))
    for r in df.collect():
        term = math.exp(r.n * math.log1p(-0.01))
        want = math.fsum(
            math.exp(math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1) + j * math.log(0.01) + (r.n - j) * math.log1p(-0.01))
            for j in range(r.k + 1)
        )
        assert abs(r.t - want) <= 1e-6 * max(want, term) + 1e-300


def test_risk_is_kept(spark):
    """Good documents with some symbols by chance are hardly rejected, junk is."""
    base = " ".join(f"word{i}" for i in range(50))
    rows = [(i, base + " %" * (i % 4), "en") for i in range(4000)] + [(10_000 + i, base + " %%%" * 25, "en") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    given = labels(spark, [(i, 1, 0) for i in range(4000) if i % 5 < 3] + [(10_000 + i, 0, 0) for i in range(50)])
    found = apply_rules(docs, given).collect()
    assert sum(not r.kept for r in found if r.doc_id < 10_000) <= 0.04 * 4000
    assert not any(r.kept for r in found if r.doc_id >= 10_000)


def test_repeated_windows(spark):
    texts = ["a b c d e f g h a b c d e f g h", "a " * 30, "a b c d e f g", "x a b c d e f g h i y a b c d e f g h i z"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = {r.doc_id: r.n_repeat_words for r in apply_rules(docs, labels(spark, [])).collect()}
    assert found == {i: counts(t)[4] for i, t in enumerate(texts)} == {0: 16, 1: 30, 2: 0, 3: 18}
