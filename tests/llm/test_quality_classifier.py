from zlib import crc32

import numpy as np

from rowloom.llm import quality_classifier as qc
from tests.llm.fixtures import empty_docs, labels, odd_docs, odd_texts


def test_features():
    places, values = qc.features("a b a b c c")
    assert places[-1] == 1 << qc.BITS and values[-1] == 1
    assert len(set(places)) == len(places) and abs((values[:-1] ** 2).sum() - 1) < 1e-6
    assert [len(x) for x in qc.features(None)] == [1, 1]
    # A word followed by itself is one pair, whichever word it is.
    assert len({*qc.features("x x")[0]} & {*qc.features("y y")[0]}) == 2


def test_update_is_ftrl():
    """One place against the closed form, step by step."""
    model, g_all, n, w = qc.Ftrl(4), [], 0.0, 0.0
    z = 0.0
    for label in (1, 0, 0, 1, 1):
        p = 1 / (1 + np.exp(-w * 0.5))
        g = (p - label) * 0.5
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / qc.ALPHA * w
        n += g * g
        w = 0.0 if abs(z) <= qc.L1 else -(z - np.sign(z) * qc.L1) / ((qc.BETA + np.sqrt(n)) / qc.ALPHA + qc.L2)
        model.learn(np.array([3]), np.array([0.5]), label)
        g_all.append(g)
        assert abs(model.weights()[3] - w) < 1e-12


def test_held_out_quality(spark):
    rows = {r.doc_id: r for r in qc.query(spark, "/root/testdata/sf0.1").collect()}
    given = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    held = [(rows[r.doc_id].score, r.quality) for r in given if rows[r.doc_id].held_out]
    assert all(r.held_out == (crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    auc = np.mean([g > b for g in good for b in bad])
    assert auc > 0.98
    assert np.mean([s >= 0.3 for s in good]) > 0.98 and np.mean([s < 0.3 for s in bad]) > 0.7


def test_held_out_labels_are_never_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").drop("n_chars")
    rows = [(r.doc_id, r.quality, 0) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()]
    turned = [(d, 1 - q if crc32(str(d).encode()) % 5 == 0 else q, t) for d, q, t in rows]
    assert turned != rows
    first, second = (qc.train(docs, labels(spark, x)) for x in (rows, turned))
    assert np.array_equal(first, second) and first.any()


def test_odd_rows(spark):
    found = qc.classify(odd_docs(spark), labels(spark)).collect()
    assert len(found) == len(odd_texts())
    assert all(0 < r.score < 1 for r in found) and {r.predicted for r in found} <= {0, 1}
    assert len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1
    assert all(r["size"] == "clash" for r in found)
    assert {r.score for r in qc.classify(odd_docs(spark), labels(spark, [])).collect()} == {0.5}
    assert qc.classify(empty_docs(spark), labels(spark)).collect() == []


def test_scores_of_the_query_against_a_plain_loop(spark):
    """Training and scoring of the whole query, number by number, with nothing but dictionaries."""
    import math

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    known = {}
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        if r.quality in (0, 1) and r.doc_id in texts and crc32(str(r.doc_id).encode()) % 5:
            known.setdefault(r.doc_id, []).append(r.quality)
    order = sorted(known, key=lambda d: (crc32(f"order {d}".encode()), d))
    assert 10 < len(order) < qc.SHARD_ROWS

    def of(text):
        places, values = qc.features(text)
        return [(int(p), float(np.float32(v))) for p, v in zip(places, values, strict=True)]

    rows = [(of(texts[d]), int(sum(known[d]) / len(known[d]) >= 0.5)) for d in order]
    z, n = {}, {}

    def weight(p):
        if abs(z.get(p, 0.0)) <= qc.L1:
            return 0.0
        sign = math.copysign(1, z[p])
        return -(z[p] - sign * qc.L1) / ((qc.BETA + math.sqrt(n[p])) / qc.ALPHA + qc.L2)

    for _ in range(max(qc.PASSES, min(qc.MOST_PASSES, qc.STEPS // len(rows)))):
        for given, label in rows:
            w = [weight(p) for p, _ in given]
            margin = sum(a * v for a, (_, v) in zip(w, given, strict=True))
            chance = 1 / (1 + math.exp(-min(max(margin, -35), 35)))
            for a, (p, v) in zip(w, given, strict=True):
                g = (chance - label) * v
                before = n.get(p, 0.0)
                z[p] = z.get(p, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / qc.ALPHA * a
                n[p] = before + g * g
    got = {r.doc_id: r for r in qc.query(spark, folder).collect()}
    assert set(got) == set(texts)
    for d, text in texts.items():
        want = 1 / (1 + math.exp(-min(max(sum(weight(p) * v for p, v in of(text)), -35), 35)))
        assert abs(got[d].score - want) < 1e-4, d
        assert abs(want - 0.3) < 1e-4 or got[d].predicted == (want >= 0.3)
