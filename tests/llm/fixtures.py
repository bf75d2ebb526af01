"""Small tables with everything that may go wrong, and plain Python versions of the contracts."""

from __future__ import annotations

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that the operators use inside.
CLASHING = (
    "size source_size target taken key slice fp fingerprint component_id first score predicted label w h p s n spans "
    "start end words seed place found_id leaked_id stratum n_words base_failed kept digest block edits edited __id"
).split()


def sentence(rng: random.Random, n: int) -> str:
    letters = "abcdefghijklmnopqrstuvwxyz"
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(n))


def odd_texts() -> list[tuple[int | None, str | None, str | None, str | None]]:
    """(doc_id, text, lang, source): nulls, empty and very long texts, repeated rows, copies, ties."""
    rng = random.Random(5)
    passage = sentence(rng, 60)
    copy = sentence(rng, 120)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "b"), (None, sentence(rng, 30), "en", "a"), (None, copy, None, None),
        (4, "one", "en", "a"), (5, "one two", "de", "b"), (6, copy, "en", "a"), (6, copy, "en", "a"), (7, copy, "en", "c"),
        (8, sentence(rng, 40) + " " + passage + " " + sentence(rng, 40), "en", "c"),
        (9, sentence(rng, 25) + " " + passage + " " + sentence(rng, 90), "en", None),
        (10, sentence(rng, 30_000), "en", "a"), (11, "é😀" * 200, "fr", "b"), (12, "x" * 20_000, "fr", "b"),
        (13, "Mail a.b@c.example.com or +1 (212) 555-0100, 4111 1111 1111 1111 at 10.0.0.1.", "en", "a"),
        (14, "the same line here\n" * 40, "en", "a"), (15, "A\x00B\x1c C\x85 D", "en", "b"), (-3, copy[:200], "en", "b"),
    ]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def odd_docs(spark):
    docs = spark.createDataFrame(odd_texts(), SCHEMA).repartition(3)
    return docs.withColumns({c: F.lit("clash") for c in CLASHING})


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=None):
    return spark.createDataFrame(
        rows if rows is not None else [(i, i % 2, 0) for i in range(1, 16)] + [(None, 1, 0), (6, 0, 1), (99, None, 0)],
        "doc_id long, quality int, toxic int",
    )


def fingerprint(text: str | None, shingle: int = 3) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    many = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    ones = [0] * 64
    for s in many:
        h = xxhash.xxh64(s.encode("utf-8", "surrogatepass"), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(many))


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def groups(nodes, linked) -> dict:
    """Smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
