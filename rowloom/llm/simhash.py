"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of at most 23 bits.  The binary Golay code is perfect: every 23-bit word has
exactly one codeword within three bits, named by a 12-bit index.  A segment is hashed to the indices of all words
within one bit of it, one to six of them, so segments that differ in at most two bits always share an index.

Two fingerprints with at most two different bits agree in at least one whole segment (pigeonhole), and the segment
after that one differs in at most two bits.  A key is therefore a segment's number, the segment itself, and one
of the indices of the next segment.  Fingerprints that share a key are candidates; their distance is verified.

Everything works on distinct fingerprints, so copies cost nothing.  Keys are counted before the join, which drops the many that
occur once.  Keys shared by more than ``BUCKET`` fingerprints, where pairs would be too many, are not
paired: their fingerprints are tied through the words within one bit of them, of which two fingerprints share one exactly if
they differ in at most two bits.  That way is exact and needs 65 rows a fingerprint, and no group
in it can hold more than 65.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from rowloom.llm.common import kept, table, text_of
from rowloom.llm.components import components

#: Generator polynomial and length of the code, seed of the hash.
POLYNOMIAL, LENGTH, SEED = 0b101011100011, 23, 42
#: First bit and number of bits of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one key up to which they are paired.
BUCKET = 24


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial: their syndromes."""
    rest = words.copy()
    for bit in range(LENGTH - 1, 10, -1):
        rest ^= np.where(rest >> bit & 1, POLYNOMIAL << (bit - 11), 0)
    return rest


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """For each of the 2048 syndromes the one pattern of at most three bits that has it."""
    patterns = [0]
    for _ in range(3):
        patterns = sorted({p ^ (1 << b) for p in patterns for b in range(LENGTH)} | set(patterns))
    patterns = np.array(patterns, np.int64)
    table = np.zeros(2048, np.int64)
    table[_remainders(patterns)] = patterns
    return table


def golay_indices(segments: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each segment and to each of its 23 neighbours: an (n, 24) array."""
    flips = np.array([0, *(1 << b for b in range(LENGTH))], np.int64)
    near = segments.astype(np.int64)[:, None] ^ flips[None, :]
    # The code is systematic: the 12 high bits name the codeword.
    return (near ^ _errors()[_remainders(near)]) >> 11


def keys_of(fingerprint: np.ndarray) -> list[np.ndarray]:
    """The keys of each fingerprint: segment number, the segment itself, an index of the next one."""
    parts = [(fingerprint >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    found = []
    for i, part in enumerate(parts):
        found.append((i << 34) | (part[:, None] << 12) | golay_indices(parts[(i + 1) % len(parts)]))
    return [np.unique(row) for row in np.concatenate(found, axis=1)]


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of all shingles of a text, repeats included, as a signed 64-bit number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    hashes = np.fromiter(
        (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)),
        np.uint64,
        len(starts),
    )
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` with a column ``fp``, a signed 64-bit number."""

    @F.pandas_udf(T.LongType())
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.withColumn("fp", fp(text_of(text_col)))


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``, enough to connect all that differ in at most two bits."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                keys = keys_of(rows["fp"].to_numpy(np.int64).view(np.uint64))
                sizes = [len(k) for k in keys]
                yield pd.DataFrame({"key": np.concatenate(keys), "fp": np.repeat(rows["fp"].to_numpy(), sizes)})

    keys = kept(fps.select("fp").mapInPandas(keyed, "key long, fp long"), "simhash-keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    several = keys.join(shared, "key")
    # A list holds at most BUCKET fingerprints: larger keys are filtered out before.
    lists = several.filter(F.col("n") <= BUCKET).groupBy("key").agg(F.sort_array(F.collect_list("fp")).alias("of"))
    pairs = F.flatten(
        F.transform(
            "of",
            lambda x, i: F.transform(
                F.filter(F.slice("of", i + 2, BUCKET), lambda y: F.bit_count(x.bitwiseXOR(y)) <= 2),
                lambda y: F.struct(x.alias("a"), y.alias("b")),
            ),
        )
    )
    paired = lists.select(F.explode(pairs).alias("p")).select("p.a", "p.b")
    masks = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    crowded = several.filter(F.col("n") > BUCKET).select("fp").distinct()
    centres = crowded.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("centre"))
    # At most 65 fingerprints lie within one bit of a centre.
    around = centres.groupBy("centre").agg(F.collect_list("fp").alias("of")).filter(F.size("of") > 1)
    tied = around.select(F.array_min("of").alias("a"), F.explode("of").alias("b")).filter("a <> b")
    return paired.unionByName(tied)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``, the smallest id that links lead to.

    A null text counts as empty; texts without words have fingerprint 0 and are linked like others.  A null id is
    never the smallest of a group that has others.  Repeated rows are rows of one group.  Empty input gives no rows.  Other columns are
    not read.
    """
    seen = kept(
        with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")), "text", shingle)
        .select("doc_id", "fp"),
        "simhash",
    )
    groups = kept(seen.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    member = components(links(groups))
    named = (
        groups.join(member.withColumnRenamed("node", "fp"), "fp", "left")
        .withColumn("component", F.coalesce("component", "fp"))
        .select("fp", "component", "first")
    )
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_fp = named.join(smallest, "component").select(F.col("fp").alias("f"), "component_id")
    # Rows of a hot fingerprint meet one row each here; Spark splits that side.
    return seen.join(of_fp, F.col("fp") == F.col("f")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row of ``docs`` for each group of ``near_duplicates``: that with the smallest id, then text digest; null ids come last.

    Of repeated rows one stays, of rows that share id and text the one that is smallest as JSON.  A null text counts as
    empty, and texts without words are linked like others.  Empty input gives no rows.
    """
    given = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    given = given.withColumn("digest", F.xxhash64("text"))
    marked = with_fingerprints(given.select("doc_id", "digest", "text"), "text", shingle).select("doc_id", "digest", "fp")
    # Rows of one id and text are counted first, so that a hot text is few rows.
    seen = kept(marked.groupBy("fp", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n")), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "n")
    groups = kept(seen.groupBy("fp").agg(F.min(order).alias("first")), "simhash-distinct")
    member = components(links(groups)).withColumnRenamed("node", "fp")
    first = (
        groups.join(member, "fp", "left")
        .groupBy(F.coalesce("component", "fp").alias("component"))
        .agg(F.min("first").alias("f"))
        .select(F.col("f.doc_id").alias("first_id"), F.col("f.digest").alias("first_digest"), F.col("f.n").alias("n"))
    )
    first = kept(first, "simhash-first")
    same = given["doc_id"].eqNullSafe(first["first_id"]) & (given["digest"] == first["first_digest"])
    left = given.join(first, same)
    repeated = left.filter("n > 1").groupBy("first_id", "first_digest").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return left.filter("n = 1").select("row.*").unionByName(repeated.select("row.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
