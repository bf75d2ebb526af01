"""Quotient filters against plain counts, and phrases against a plain program."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowloom.llm import phrases
from rowloom.llm.common import table
from tests.llm.fixtures import empty_docs, odd_docs, odd_texts


@pytest.mark.parametrize("bits", [1, 7, 33, 64])
@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_filter_keeps_everything(bits, n):
    rng = np.random.default_rng(bits * n)
    top = (1 << bits) - 1
    keys = np.unique(rng.integers(0, top, n, np.uint64, endpoint=True))
    if n > 1:
        keys = np.unique(np.append(keys, np.array([0, top], np.uint64)))
    counts = rng.choice([1, 2, 254, 255, 256, 1 << 40], len(keys)).astype(np.int64)
    again, times = phrases.from_filter(phrases.to_filter(keys, counts, bits))
    assert again.tolist() == keys.tolist() and times.tolist() == counts.tolist()


def test_filters_merge():
    rng, want, filters = random.Random(1), Counter(), []
    for _ in range(20):
        part = Counter(rng.choices(range(300), k=rng.choice([1, 50, 400])))
        want += part
        keys = np.array(sorted(part), np.uint64)
        filters.append(phrases.to_filter(keys, np.array([part[int(k)] for k in keys]), 20))
    keys, counts = phrases.merged(filters)
    assert keys.tolist() == sorted(want) and dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want


@pytest.mark.parametrize(("ids", "ngrams"), [(1, 10), (3, 1 << 30), (60_000, 10**8), ((1 << 21) - 1, 1), (1 << 24, 10**13), ((1 << 32) - 1, 10**14)])
def test_packing_is_invertible(ids, ngrams):
    packing = phrases.Packing.fitting(ids, ngrams)
    assert packing.key_bits <= 64 and 0 <= packing.ranges <= packing.bits
    rng = np.random.default_rng(3)
    words = [rng.integers(0, ids, 3000, np.uint64, endpoint=True) for _ in range(3)]
    ranges, keys = packing.pack(*words)
    assert int(ranges.max()) < 1 << packing.ranges
    if packing.key_bits < 64:
        assert int(keys.max()) < 1 << packing.key_bits
    for r in np.unique(ranges).tolist()[:50]:
        at = ranges == r
        for got, want in zip(packing.unpack(r, keys[at]), words, strict=True):
            assert got.tolist() == want[at].tolist()


def test_ranges_are_even():
    """Neighbouring ids, which words in the order of their files have, are spread."""
    packing = phrases.Packing.fitting(5000, 64 << 20)
    first = np.repeat(np.arange(1, 301, dtype=np.uint64), 300)
    ranges, _ = packing.pack(first, np.tile(np.arange(1, 301, dtype=np.uint64), 300), np.zeros(90_000, np.uint64))
    sizes = np.bincount(ranges.astype(np.int64), minlength=1 << packing.ranges)
    assert packing.ranges >= 5 and sizes.max() < 1.3 * sizes.mean() and sizes.min() > 0.7 * sizes.mean()


def brute(rows, least=10, share=50, top=2000):
    """Rows (lang, text) as result rows."""
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        of = counts.setdefault(lang, Counter())
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                of.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = set()
    for lang, of in counts.items():
        long = [(p, a) for p, a in of.items() if len(p) == 3 and a >= least]
        gone = {q for p, a in long for q in (p[:2], p[1:]) if 100 * a >= share * of[q]}
        found = []
        for p, a in of.items():
            if len(p) > 1 and a >= least and p not in gone:
                score, k = min((1_000_000 * a * a // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return out


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def found(df):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_against_a_plain_program(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("lang", "text").collect()
    got = found(phrases.query(spark, "/root/testdata/sf0.001"))
    assert len(got) > 100 and got == brute(map(tuple, docs))


def test_small_blocks_and_ranges(spark, monkeypatch):
    """Phrases counted over many blocks and ranges, ties in score and count, breaks of all kinds, lists cut short."""
    monkeypatch.setattr(phrases, "BLOCK", 300)
    monkeypatch.setattr(phrases, "RANGE", 50)
    monkeypatch.setattr(phrases, "STRETCH", 7)
    rng = random.Random(7)
    words = ["a", "b", "c", "New", "york", "city", "\x01x", "é", "a\x1cb", "-"]
    marks = [" ", " ", "  ", "\t", ", ", "\n", ";", " . ", "\x0b"]
    rows = []
    for _ in range(150):
        text = "".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(0, 40)))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), rng.choice([text, text + " New York City ", None])))
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(phrases.collocations(docs)) == brute(rows)
    assert found(phrases.collocations(docs, least=2, share=90, top=7)) == brute(rows, 2, 90, 7)


def test_odd_and_empty_tables(spark):
    """Nulls, an id column of any kind, clashing names, one very frequent phrase, no frequent word."""
    docs = odd_docs(spark).withColumns({c: F.lit("clash") for c in ["a", "l", "r", "w1", "id", "word", "of", "sequence"]})
    rows = [(lang, text) for _, text, lang, _ in odd_texts()]
    assert found(phrases.collocations(docs, least=2)) == brute(rows, 2)
    assert phrases.collocations(empty_docs(spark)).collect() == []
    alone = spark.createDataFrame([("en", "every word once"), ("de", None)], "lang string, text string")
    assert phrases.collocations(alone).collect() == []
    hot = spark.createDataFrame([("en", "yes no " * 50_000), ("en", "yes no")], "lang string, text string")
    assert found(phrases.collocations(hot)) == brute([("en", "yes no " * 50_000), ("en", "yes no")])


def test_scores_are_exact_beyond_64_bits(spark):
    big = 3 * 10**12
    rows = [(big, big + 1, big + 7), (big, big, big), (10, 10**12, 10**12)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in df.select(phrases._score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1_000_000 * a * a // (left * right) for a, left, right in rows]
