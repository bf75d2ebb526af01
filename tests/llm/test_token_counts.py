import random

from pyspark.sql import functions as F

from rowloom.llm import token_counts as tc
from tests.llm.fixtures import empty_docs, odd_docs, odd_texts

CODE = tc.encoder(tc.VOCABULARY)


def full(text: str) -> int:
    return len(CODE.encoding.encode_ordinary(text))


def test_random_edits_equal_full_encoding():
    rng = random.Random(7)
    alphabet = ["a", "b", " ", "  ", "\n", "'s", "'", "1", "23", ".", "é", "😀", "\t", " the", "!!", "word", "   \n "]
    for _ in range(300):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 500)))
        tree = tc.Tree(*CODE.leaves(text))
        assert int(tree.tokens[1]) == full(text)
        for _ in range(4):
            a = rng.randint(0, len(text))
            put = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 2, 60])))
            tree, text, _ = tc.edit(tree, text, a, a + rng.choice([0, 1, 3, 200]), put, CODE)
            assert int(tree.tokens[1]) == full(text)
            assert int(tree.chars[1]) == len(text)


def test_small_edit_of_long_text_is_local():
    text = "some ordinary words in a row, " * 5000
    tree = tc.Tree(*CODE.leaves(text))
    tree, text, encoded = tc.edit(tree, text, 70_000, 70_004, "other", CODE)
    assert encoded < 1500 and int(tree.tokens[1]) == full(text)


def test_all_documents(spark):
    docs = tc.sample_edits(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    edited = {r.doc_id: r for r in docs.collect()}
    found = tc.query(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(edited)
    for r in found:
        text = edited[r.doc_id].text
        assert r.n_tokens == full(text)
        for e in edited[r.doc_id].edits:
            text = text[: e.start] + e.put + text[e.end :]
        assert r.n_tokens_after == full(text)


def test_odd_rows(spark):
    edits = spark.createDataFrame(
        [(1, 1, 5, 9, "put in"), (2, 1, None, None, "first"), (2, 2, 0, 3, None), (99, 1, 0, 0, "x"), (None, 1, 0, 0, "x"), (6, 1, 3, 3, " !")],
        "doc_id long, step int, start int, end int, put string",
    )
    rows = tc.count_with_edits(odd_docs(spark), edits).collect()
    assert len(rows) == len(odd_texts())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].text == "put in" and by_id[2].text == "st"
    assert all(r.n_tokens_after == full(r.text) for r in rows)
    assert all(r.n_encoded == 0 for r in rows if r.doc_id in (None, 10))
    assert tc.count_with_edits(empty_docs(spark), edits).collect() == []
    assert len(tc.count_with_edits(odd_docs(spark), edits.filter(F.lit(False))).collect()) == len(odd_texts())
