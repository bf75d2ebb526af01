import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import simhash
from rowloom.llm.components import components
from tests.llm.fixtures import empty_docs, fingerprint, groups, odd_docs, odd_texts, sentence


def test_golay_indices_are_shared_within_two_bits():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 23, 3000)
    one, two = rng.integers(0, 23, 3000), rng.integers(0, 23, 3000)
    y = x ^ (1 << one) ^ np.where(one == two, 0, 1 << two)
    for a, b in zip(simhash.golay_indices(x), simhash.golay_indices(y), strict=True):
        assert set(a) & set(b) and len(set(a)) <= 6


def as_long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("bucket", [24, 2])
def test_links_connect_what_differs_in_two_bits(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(3)
    fps = {0}
    for _ in range(60):
        fps.add(rng.getrandbits(64))
    for f in list(fps)[:25]:
        for _ in range(12):
            for b in rng.sample(range(64), rng.choice([1, 2, 3])):
                f ^= 1 << b
            fps.add(f)
    # A crowd of many fingerprints around one.
    fps |= {(1 << a | 1 << b) for a in range(0, 64, 3) for b in range(64)}
    fps = sorted(fps)
    want = groups(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2])
    links = simhash.links(spark.createDataFrame([(as_long(f),) for f in fps], "fp long"))
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in pairs)
    assert groups(fps, pairs) == want
    assert len(pairs) < 65 * len(fps)
    found = {r.node % (1 << 64): r.component % (1 << 64) for r in components(links).collect()}
    again = {f: found.get(f, f) for f in fps}
    by = {}
    for f in fps:
        by.setdefault(want[f], set()).add(again[f])
    assert all(len(v) == 1 for v in by.values()) and len({*again.values()}) == len({*want.values()})


def test_components_of_a_long_path(spark):
    ids = list(range(200))
    random.Random(1).shuffle(ids)
    path = spark.createDataFrame([*zip(ids, ids[1:], strict=False), (7, 7), (None, 3), (500, 501), (501, 500)], "a long, b long")
    found = {r.node: r.component for r in components(path).collect()}
    assert found == {**{i: 0 for i in ids}, 500: 500, 501: 500}
    assert components(path.filter(F.lit(False))).collect() == []


def test_odd_rows(spark):
    rows = simhash.near_duplicates(odd_docs(spark)).collect()
    given = odd_texts()
    assert len(rows) == len(given)
    assert sorted(r.fingerprint for r in rows) == sorted(f"{fingerprint(t):016x}" for _, t, *_ in given)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert {by_id[i].component_id for i in (1, 2, 3)} == {1}
    assert by_id[7].component_id == by_id[6].component_id == 6
    assert simhash.near_duplicates(empty_docs(spark)).collect() == []
    left = [r.doc_id for r in simhash.keep_one(odd_docs(spark)).collect()]
    # One of the null ids shares a text with documents 6 and 7.
    assert left.count(None) == 1 and left.count(6) == 1 and not {2, 3, 7} & set(left)


def test_one_row_of_a_group(spark):
    """Repeated rows, null ids and other texts under a kept id leave one row a group; columns may be of any type."""
    rng = random.Random(6)
    a, b = sentence(rng, 80), sentence(rng, 80)
    rows = [(6, a), (6, a), (6, b), (7, a), (3, b), (None, a), (None, b), (None, "alone"), (None, "alone"), (8, None), (9, " ")]
    docs = spark.createDataFrame([(*r, {"n": i}) for i, r in enumerate(rows)], "doc_id long, text string, of map<string,int>")
    left = simhash.keep_one(docs)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.of["n"]) for r in left.collect()), key=repr)
    assert got == sorted([(6, a, 0), (3, b, 4), (None, "alone", 7), (8, None, 9)], key=repr)
    assert simhash.keep_one(empty_docs(spark)).collect() == []


def test_keep_one_on_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fps = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    ids = sorted(fps)
    want = groups(ids, [(a, b) for a in ids for b in ids if b < a and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == sorted(set(want.values()))


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    fps = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    ids = sorted(fps)
    want = groups(ids, [(a, b) for a in ids for b in ids if b < a and (fps[a] ^ fps[b]).bit_count() <= 2])
    rows = simhash.query(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {d: (f"{fps[d]:016x}", want[d]) for d in ids}
