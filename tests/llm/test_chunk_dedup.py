import random

import numpy as np

from rowloom.llm.chunk_dedup import GEAR, LONGEST, MASK, RUN, boundaries, chunk_dedup, without_repeats
from tests.llm.fixtures import empty_docs, odd_docs, odd_texts, sentence


def slow_boundaries(data: bytes) -> list[int]:
    """The rolling hash byte by byte."""
    h, ends, last = 0, [], 0
    for i, b in enumerate(data):
        h = ((h << 1) + int(GEAR[b])) & 0xFFFF
        if i >= 15 and h & int(MASK) == 0:
            while i + 1 - last > LONGEST:
                last += LONGEST
                ends.append(last)
            ends.append(i + 1)
            last = i + 1
    while len(data) - last > LONGEST:
        last += LONGEST
        ends.append(last)
    if len(data) > last:
        ends.append(len(data))
    return ends


def test_boundaries():
    rng = random.Random(1)
    for n in (0, 1, 15, 16, 17, 300, 5000):
        data = bytes(rng.randrange(256) for _ in range(n))
        assert boundaries(data).tolist() == slow_boundaries(data)
    assert boundaries(b"x" * 1000).tolist() == slow_boundaries(b"x" * 1000)


def brute(docs):
    """Removed runs of each document, by a dictionary of chunks."""
    seen = {}
    cut = {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        data = (t or "").encode()
        ends = boundaries(data).tolist()
        cut[d] = [(a, b, data[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
        for *_, c in cut[d]:
            seen.setdefault(c, d)
    out = {}
    for d, pieces in cut.items():
        runs = []
        for a, b, c in pieces:
            if seen[c] < d:
                if runs and runs[-1][1] == a:
                    runs[-1][1] = b
                else:
                    runs.append([a, b])
        out[d] = ",".join(f"{a}:{b}" for a, b in runs if b - a >= RUN)
    return out


def test_against_dictionary(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.spans for r in chunk_dedup(docs).collect()} == want
    assert any(want.values())


def test_passage_survives_insertion(spark):
    rng = random.Random(2)
    passage = sentence(rng, 70)
    changed = passage[:150] + "inserted words " + passage[150:]
    texts = [sentence(rng, 200), sentence(rng, 50) + " " + passage, sentence(rng, 80) + " " + changed + sentence(rng, 9), sentence(rng, 300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    removed = {r.doc_id: r.n_removed for r in chunk_dedup(docs).collect()}
    assert removed[0] == removed[1] == removed[3] == 0
    assert removed[2] > len(passage) * 0.4
    left = {r.doc_id: r.text for r in without_repeats(docs).collect()}
    assert len(left[2]) == len(texts[2]) - removed[2] and left[1] == texts[1]


def test_odd_rows(spark):
    rows = chunk_dedup(odd_docs(spark)).collect()
    assert len(rows) == len(odd_texts())
    assert all(r.n_removed == 0 for r in rows if r.doc_id in (None, -3, 1, 2, 3, 4, 5, 10))
    assert all(r.n_removed > 600 for r in rows if r.doc_id == 7)
    assert len(without_repeats(odd_docs(spark)).collect()) == len(odd_texts())
    assert chunk_dedup(empty_docs(spark)).collect() == []
    assert np.all([r.n_bytes >= r.n_removed for r in rows])
