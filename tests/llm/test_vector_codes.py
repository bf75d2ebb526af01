"""Dual-tree assignment and whole rounds against plain ones."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import vector_codes as vc
from rowloom.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def plain_nearest(rows, entries):
    apart = ((rows[:, None, :] - entries[None]) ** 2).sum(axis=2)
    return np.argmin(apart, axis=1)


@pytest.mark.parametrize("n", [1, 31, 64, 500, 4096])
@pytest.mark.parametrize("kind", ["spread", "clusters", "ties", "same"])
def test_assignment(n, kind):
    rng = np.random.default_rng(n)
    k, d = (1, 3) if n == 1 else (min(n, 256), 16) if kind != "ties" else (min(n, 100), 2)
    if kind == "spread":
        rows = rng.integers(-900, 900, (n, d))
    elif kind == "clusters":
        rows = rng.integers(-9000, 9000, (7, d))[rng.integers(0, 7, n)] + rng.integers(-5, 5, (n, d))
    elif kind == "ties":
        rows = rng.integers(-2, 3, (n, d))
    else:
        rows = np.full((n, d), 4)
    entries = rows[rng.permutation(n)[:k]]
    height = vc.height_of(n, vc.LEAF)
    order = vc.order_of(rows, height)
    assert sorted(order.tolist()) == list(range(n))
    rows = rows[order]
    chosen, sums, counts = vc.assign(rows, vc.Boxes.over(rows, height), vc.Codebook(entries))
    want = plain_nearest(rows, entries)
    assert chosen.tolist() == want.tolist()
    assert counts.tolist() == np.bincount(want, minlength=k).tolist()
    for e in range(k):
        assert sums[e].tolist() == rows[want == e].sum(axis=0).tolist()


def test_whole_nodes_are_assigned_without_looking_at_their_vectors(monkeypatch):
    """Far clusters: sums come from the boxes, so no vector is compared."""
    rows = np.repeat(np.arange(8) * 100_000, 512)[:, None] + np.random.default_rng(0).integers(0, 50, (4096, 4))
    entries = np.repeat(np.arange(8) * 100_000, 1)[:, None] + np.zeros((8, 4), np.int64)
    height = vc.height_of(len(rows), vc.LEAF)
    boxes = vc.Boxes.over(rows, height)
    want = plain_nearest(rows, entries)
    sums = np.array([rows[want == e].sum(axis=0) for e in range(8)])
    hidden = np.full_like(rows, 10**9)
    _, got, counts = vc.assign(hidden, boxes, vc.Codebook(entries))
    assert got.tolist() == sums.tolist() and counts.tolist() == [512] * 8


def brute(rows, k=256, rounds=4):
    """Rows (vec_id, vector, label) as rows (vec_id, code, error, label_error, digest)."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    whole = np.array([[math.floor(1024 * x) for x in r[1]] for r in rows], np.int64)
    step = -(-whole.shape[1] // 4)
    parts = [whole[:, p * step : (p + 1) * step] for p in range(4)]
    books = [p[:k].copy() for p in parts]
    for _ in range(rounds):
        for part, book in zip(parts, books, strict=True):
            near = plain_nearest(part, book)
            for e in set(near.tolist()):
                some = part[near == e]
                book[e] = [int(s) // len(some) for s in some.sum(axis=0)]
    near = [plain_nearest(p, b) for p, b in zip(parts, books, strict=True)]
    errors = sum(((p - b[n]) ** 2).sum(axis=1) for p, b, n in zip(parts, books, near, strict=True))
    text = ",".join(str(x) for b in books for x in b.ravel().tolist())
    digest = hashlib.sha256(text.encode()).hexdigest()
    of_label = {}
    for r, e in zip(rows, errors.tolist(), strict=True):
        of_label[r[2]] = of_label.get(r[2], 0) + e
    return sorted(
        (
            (r[0], "".join(f"{n[i]:02x}" for n in near), int(errors[i]), of_label[r[2]], digest)
            for i, r in enumerate(rows)
        ),
        key=repr,
    )


def found(spark, monkeypatch, docs):
    monkeypatch.setattr(vc, "table", lambda *_: docs)
    out = vc.query(spark, "")
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_query_against_plain_rounds(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "embeddings").select("vec_id", "embedding", "label").collect()]
    got = sorted((tuple(r) for r in vc.query(spark, FOLDER).collect()), key=repr)
    assert len(got) == len(rows) and got == brute(rows)


def test_odd_vectors(spark, monkeypatch):
    """Nulls everywhere, non-finite components, repeated rows and ids, negative zero, other lengths, clashing names."""
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(0, 1, 8).tolist(), int(i) % 3) for i in range(300)]
    rows += [rows[7], rows[7], (7, rows[8][1], None), (None, rows[3][1], None), (None, rows[3][1], 1), (900, None, 2)]
    rows += [(901, [1.0] * 7 + [None], 1), (902, [math.nan] + [0.0] * 7, 1), (903, [math.inf] * 8, 1), (904, [-math.inf] * 8, 1)]
    rows += [(905, [1.0, 2.0], 5), (906, [], 5), (907, [-0.0] * 8, 5), (908, [-1e-9] * 8, 5)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    docs = docs.withColumns({c: F.lit("clash") for c in ["vector", "code", "error", "codes", "ids", "rows", "part", "of"]})
    want = brute(rows)
    assert found(spark, monkeypatch, docs) == want and len(want) == len(rows) - 7


@pytest.mark.parametrize("length", [1, 3, 6])
def test_few_vectors_and_other_lengths(spark, monkeypatch, length):
    rng = np.random.default_rng(length)
    rows = [(i, rng.normal(0, 3, length).tolist(), 1) for i in range(5)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    given = [tuple(r) for r in docs.collect()]
    assert found(spark, monkeypatch, docs) == brute(given)


def test_no_vectors(spark, monkeypatch):
    for rows in ([], [(1, None, 1)], [(1, [math.nan], 1)]):
        docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
        assert found(spark, monkeypatch, docs) == []


def test_too_large_components_are_refused(spark):
    docs = spark.createDataFrame([(1, [1e200, 0.0, 0.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(ValueError, match="too large"):
        vc.compress(docs)


def test_a_hot_vector(spark, monkeypatch):
    """A third of all rows is one vector under one label."""
    rng = np.random.default_rng(9)
    rows = [(i, [0.5] * 8 if i % 3 == 0 else rng.normal(0, 1, 8).tolist(), 0 if i % 3 == 0 else i) for i in range(6000)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    assert found(spark, monkeypatch, docs) == brute(rows)
