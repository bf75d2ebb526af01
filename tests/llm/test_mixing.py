from collections import defaultdict

import pytest

from rowloom.llm.mixing import mix_sources
from tests.llm.fixtures import WORD, empty_docs, odd_docs, odd_texts


def test_odd_rows_and_targets(spark):
    rows = mix_sources(odd_docs(spark)).collect()
    assert len(rows) == len(odd_texts())
    sizes = sorted((r[0] or -99, len(WORD.findall(r[1] or ""))) for r in odd_texts())
    assert sorted((r.doc_id or -99, r["size"]) for r in rows) == sizes
    taken = defaultdict(int)
    for r in rows:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    target = {r.source: r.target for r in rows}
    source_size = {r.source: r.source_size for r in rows}
    for s in target:
        assert abs(taken[s] - target[s]) <= 1
        assert target[s] <= 3 * source_size[s] + 1e-6
    assert sum(target.values()) == pytest.approx(sum(source_size.values()))
    assert sorted(rows, key=repr) == sorted(mix_sources(odd_docs(spark).repartition(1)).collect(), key=repr)


def test_water_filling_against_rounds(spark):
    sizes = {"a": 10, "b": 2000, "c": 30, "d": 500, None: 1}
    docs = spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())], "doc_id long, text string, source string")
    found = {r.source: r.target for r in mix_sources(docs).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2], strict=True))
    want, open_, left = {}, set(sizes), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
        open_ -= over
    assert found == pytest.approx(want)


def test_better_documents_come_first(spark):
    docs = spark.createDataFrame(
        [(i, ("word " if i % 2 else "%%%% ") * 10, "a") for i in range(2000)], "doc_id long, text string, source string"
    )
    rows = mix_sources(docs, share=0.3).collect()
    good = sum(r.taken for r in rows if r.doc_id % 2)
    assert good > 0.8 * sum(r.taken for r in rows)


def test_empty(spark):
    assert mix_sources(empty_docs(spark)).collect() == []
    nothing = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mix_sources(nothing).collect()] == [(0, 0.0)]
