import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from checks.compare import compare, duck
from rowloom.llm import registry
from rowloom.llm.mixing import mix_sources
from rowloom.llm.pii import remove_personal_data
from rowloom.llm.quality_classifier import classify
from rowloom.llm.simhash import near_duplicates
from tests.conftest import CHECKED
from tests.llm.fixtures import empty_docs, odd_docs
from tests.llm.test_decontamination import brute as leaks

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    rows, difference = compare(spark, CHECKED, registry.queries()[name], SQL[name], duck(CHECKED))
    assert not difference and rows > 0


def test_all_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registered.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in registered.queries()


def test_stages(spark, tmp_path):
    """Each stage's decisions on what the stage before it kept."""
    docs = spark.read.parquet(f"{CHECKED}/documents.parquet")
    steps = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, CHECKED).write.parquet(str(tmp_path / str(n)))
        steps.append((docs, spark.read.parquet(str(tmp_path / str(n)))))
        docs = steps[-1][1]

    def ids(df):
        return {r.doc_id for r in df.select("doc_id").collect()}

    given, left = steps[0]
    scored = classify(given, spark.read.parquet(f"{CHECKED}/labels.parquet"))
    assert ids(left) == ids(scored.filter("predicted = 1")) < ids(given)
    given, left = steps[1]
    assert ids(left) == ids(near_duplicates(given).filter("doc_id = component_id")) < ids(given)
    assert left.count() == left.select(F.lower("text")).distinct().count()
    given, left = steps[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{CHECKED}/benchmark.parquet").limit(3).collect()]
    some = leaks([(r.doc_id, r.text) for r in given.limit(60).collect()], items)
    assert ids(left) < ids(given) and not ids(left) & {d for d, _ in some}
    given, left = steps[3]
    assert ids(left) == ids(given)
    want = {r.doc_id: r.text for r in remove_personal_data(given).collect()}
    assert all(r.text == want[r.doc_id] and r.n_chars == len(r.text) for r in left.collect())
    given, mixed = steps[4]
    assert {r.doc_id: r.taken for r in mixed.collect()} == {r.doc_id: r.taken for r in mix_sources(given).collect()}
    assert all(list(out.columns) == list(first.columns) for first, out in steps[:4])
    assert {r.doc_id: r.taken for r in corpus_pipeline.run(spark, CHECKED).collect()} == {r.doc_id: r.taken for r in mixed.collect()}


@pytest.mark.parametrize("n", range(5))
def test_stages_on_odd_and_empty_documents(spark, n):
    stage = corpus_pipeline.STAGES[n][1]
    docs = odd_docs(spark).withColumn("n_chars", F.length("text").cast("long"))
    out = stage(spark, docs, CHECKED)
    assert out.count() > 0 and (n == 4 or out.columns == docs.columns)
    assert stage(spark, empty_docs(spark).withColumn("n_chars", F.lit(0)), CHECKED).collect() == []
