import random

import numpy as np
import pytest

from rowloom.llm import suffix_dedup as sd
from tests.llm.fixtures import empty_docs, odd_docs, odd_texts, sentence, sha


def brute(docs, length):
    first = {}
    for d, t in sorted(docs):
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], d)
    out = {}
    for d, t in docs:
        gone = np.zeros(len(t) + 1, np.int8)
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = 1
        rest = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out[d] = (len(t), int(gone.sum()), int((np.diff(np.append(0, gone)) == 1).sum()), sha(rest))
    return out


def test_boundaries_are_common_prefixes():
    rng = np.random.default_rng(0)
    for trial in range(100):
        text = np.append(rng.integers(97, 99 + trial % 3, rng.integers(2, 300)), sd.SEPARATOR).astype(np.uint8)
        length = int(rng.integers(2, 20))
        order = sd.suffix_order(text, length)
        fewer = sd.boundaries(text, order, length)
        raw = text.tobytes()
        for i in range(1, len(text)):
            a, b = raw[order[i - 1] :][:length], raw[order[i] :][:length]
            if sd.SEPARATOR not in a and sd.SEPARATOR not in b:
                assert a <= b and fewer[i] == (a != b)


def test_dropping_intervals_of_one_document_changes_no_result():
    """Classes of strings of several documents are the same with and without the documents' own intervals."""
    rng = np.random.default_rng(1)
    for trial in range(150):
        length = int(rng.integers(2, 20))
        texts = [rng.integers(97, 99 + trial % 3, rng.integers(1, 60)).astype(np.uint8) for _ in range(rng.integers(1, 12))]
        texts += [texts[0][: rng.integers(0, 60)] for _ in range(trial % 3)]
        joined = np.concatenate([np.append(t, np.uint8(sd.SEPARATOR)) for t in texts])
        owners = np.repeat(rng.integers(0, 4, len(texts)), [len(t) + 1 for t in texts])
        order = sd.suffix_order(joined, length)
        depths = np.full(len(joined), sd.FAR, np.int64)
        fewer = sd.boundaries(joined, order, length, owners, depths)
        places = np.arange(len(joined))
        alone = np.minimum.accumulate((depths + places)[::-1])[::-1] - places <= length
        raw, holders = joined.tobytes(), {}
        for i in range(len(raw) - length + 1):
            if b"\xff" not in raw[i : i + length]:
                holders.setdefault(raw[i : i + length], set()).add(owners[i])
        seen, classes = {}, np.cumsum(fewer)
        for c, i in zip(classes.tolist(), order.tolist(), strict=True):
            string = raw[i : i + length]
            if string not in holders:
                continue
            # A string of one document is told alone or has a class of its own; one of several never is told alone.
            assert not (alone[i] and len(holders[string]) > 1)
            if not alone[i]:
                assert seen.setdefault(c, string) == string


def test_segments_hold_every_string_once():
    rng = random.Random(1)
    for n in (0, 49, 50, 51, 64, 3000):
        data = np.frombuffer(bytes(rng.choices(b"abc", k=n)), np.uint8)
        anchors, opens, closes = sd.segments(data, 50)
        held = [i for a, b in zip(opens, closes, strict=True) for i in range(a, b + 1)]
        assert held == list(range(max(0, n - 49)))
        assert len(anchors) == len(opens)


@pytest.mark.parametrize("hot", [sd.HOT, 64])
def test_documents_against_brute_force(spark, hot):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id < 500")
    want = brute([(r.doc_id, r.text.encode()) for r in docs.collect()], sd.LENGTH)
    rows = sd.suffix_dedup(docs, hot=hot, block_bytes=50_000).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == want


def test_hot_anchors_take_the_other_route(spark):
    rng = random.Random(3)
    shared = sentence(rng, 30)
    texts = [(i, f"{sentence(rng, 12)} {shared} {sentence(rng, i % 9)}") for i in range(800)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert sd.hot_anchors(docs, sd.LENGTH, 256) and not sd.hot_anchors(docs, sd.LENGTH, sd.HOT)
    want = brute([(d, t.encode()) for d, t in texts], sd.LENGTH)
    for hot in (256, sd.HOT):
        assert {r.doc_id: tuple(r)[1:5] for r in sd.suffix_dedup(docs, hot=hot).collect()} == want


def test_odd_rows(spark):
    rows = sd.suffix_dedup(odd_docs(spark)).collect()
    assert len(rows) == len(odd_texts())
    given = [(d, (t or "").encode()) for d, t, *_ in odd_texts()]
    want = brute([x for x in given if x[0] is not None], sd.LENGTH)
    for r in rows:
        if r.doc_id is None:
            assert r.n_removed == 0 and r.n_bytes > 0
        else:
            assert tuple(r)[1:5] == want[r.doc_id]
    assert sd.suffix_dedup(empty_docs(spark)).collect() == []
