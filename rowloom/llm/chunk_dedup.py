"""Substring dedup by content-defined chunking.

A gear rolling hash runs over the bytes of a text: it is shifted left and the byte's number from a fixed table is added, so
its lower 16 bits depend on the last 16 bytes alone.  A chunk ends where chosen bits are zero, on average every 32 bytes, so an
insertion moves the boundaries next to it and no others.  Chunks are deduplicated by digest: one is a repeat if a document with a
smaller id has it.  Neighbouring repeats form runs; runs of at least ``RUN`` bytes are removed, shorter ones stay, since
single short chunks repeat by chance in clean text.

All positions of a text are hashed at once with four shifted additions.  Digests are counted before they meet the chunks again,
so a passage that a third of all documents share is one row per task in the shuffle, and the chunk side of the join is
one that Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rowloom.llm.common import kept, table, text_of

#: A boundary where these bits of the hash are zero: one place in 32.
MASK = np.uint16(0b1111_1000_0000_0000)
#: Bytes of the hash's window, and the longest chunk.
WINDOW, LONGEST = 16, 256
#: Bytes from which a run of repeated chunks is removed.
RUN = 100
#: One number per byte value, from a hash of the value.
GEAR = np.array([xxh64_intdigest(bytes([b]), 1) & 0xFFFF for b in range(256)], np.uint16)


def boundaries(data: bytes) -> np.ndarray:
    """Ends of the chunks of ``data``, the last one its length; none for no bytes."""
    if not data:
        return np.zeros(0, np.int64)
    h = GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8):
        shifted = np.zeros_like(h)
        shifted[step:] = h[:-step] << np.uint16(step)
        h = h + shifted
    # The first bytes have not filled the window, and a boundary must not depend on where a text starts.
    cut = np.flatnonzero((h & MASK) == 0)
    ends = cut[cut >= WINDOW - 1] + 1
    ends = np.union1d(ends, [len(data)])
    gaps = np.diff(ends, prepend=0)
    if gaps.max() > LONGEST:
        more = [np.arange(e - g + LONGEST, e, LONGEST) for e, g in zip(ends[gaps > LONGEST], gaps[gaps > LONGEST], strict=True)]
        ends = np.union1d(ends, np.concatenate(more))
    return ends


def chunks(docs: DataFrame) -> DataFrame:
    """One row per chunk of ``docs`` (doc_id, text): ``doc_id, end, size, digest``; positions are bytes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), 256):
                part = rows.iloc[at : at + 256]
                texts = [t.encode("utf-8", "surrogatepass") for t in part["text"]]
                found = [boundaries(t) for t in texts]
                digests = []
                for t, ends in zip(texts, found, strict=True):
                    places = [0, *ends.tolist()]
                    digests += [xxh64_intdigest(t[a:b]) for a, b in zip(places, places[1:], strict=False)]
                counts = [len(f) for f in found]
                yield pd.DataFrame(
                    {
                        "doc_id": np.repeat(part["doc_id"].to_numpy(), counts),
                        "end": np.concatenate(found).astype(np.int32),
                        "size": np.concatenate([np.diff(f, prepend=0) for f in found]).astype(np.int32),
                        "digest": np.array(digests, np.uint64).view(np.int64),
                    }
                )

    return docs.mapInPandas(cut, "doc_id long, end int, size int, digest long")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN) -> DataFrame:
    """One row per document with a removed run: ``doc_id, n_chunks`` (repeated ones in runs), ``runs``.

    ``runs`` is an array of (start, end) in bytes, in order.  Ids must be integers and distinct: rows with a null id are left
    out, and rows of one id count as one document, whose runs are those of all its texts.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    pieces = kept(chunks(slim.filter("doc_id IS NOT NULL")), "chunks")
    first = (
        pieces.groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first < last")
        .select("digest", "first")
    )
    repeats = pieces.join(first, "digest").filter("first < doc_id")
    ordered = repeats.groupBy("doc_id").agg(
        F.array_distinct(F.sort_array(F.collect_list(F.struct("end", "size")))).alias("all")
    )
    return ordered.mapInPandas(_runs(run), "doc_id long, n_chunks long, runs array<struct<start:int,end:int>>")


def _runs(least: int):
    def join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = []
            for doc_id, items in zip(rows["doc_id"], rows["all"], strict=True):
                ends = np.array([x["end"] for x in items], np.int64)
                starts = ends - np.array([x["size"] for x in items], np.int64)
                opens = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
                closes = np.append(opens[1:], len(ends))
                runs = [
                    (int(starts[a]), int(ends[b - 1]), b - a)
                    for a, b in zip(opens, closes, strict=True)
                    if ends[b - 1] - starts[a] >= least
                ]
                if runs:
                    spans = [{"start": a, "end": b} for a, b, _ in runs]
                    found.append((doc_id, sum(n for *_, n in runs), spans))
            yield pd.DataFrame(found, columns=["doc_id", "n_chunks", "runs"])

    return join_up


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN) -> DataFrame:
    """``docs`` with the repeated runs cut out of its texts; all rows and columns stay.

    A cut inside a character, possible where two texts share some of its bytes, drops that character.
    """
    found = repeated_runs(docs, id_col, text_col, run).select(F.col("doc_id").alias("found_id"), "runs")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, runs: pd.Series) -> pd.Series:
        made = []
        for text, spans in zip(texts, runs, strict=True):
            if text is None or spans is None:
                made.append(text)
                continue
            data, at, out = text.encode("utf-8", "surrogatepass"), 0, []
            for s in spans:
                out.append(data[at : s["start"]])
                at = s["end"]
            made.append(b"".join([*out, data[at:]]).decode("utf-8", "ignore"))
        return pd.Series(made, dtype=object)

    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    joined = whole.join(found, F.col("id") == F.col("found_id"), "left")
    return joined.select(
        *[cut(F.col("text"), F.col("runs")).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    )


def chunk_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, spans``, spans as start:end in bytes.

    A null text counts as empty.  Rows with a null id have nothing removed.  Repeated rows of an id are one document to the search, so
    none is a repeat of another.  Of equal texts the one with the smallest id stays whole.  Empty input gives no rows.  Other columns
    are not read.
    """
    found = repeated_runs(docs, id_col, text_col, run).select(F.col("doc_id").alias("found_id"), "n_chunks", "runs")
    sizes = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"))
    removed = F.aggregate("runs", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(":", r["start"], r["end"])), ",")
    return sizes.join(found, F.col("doc_id") == F.col("found_id"), "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce(removed, F.lit(0)).alias("n_removed"),
        F.coalesce(F.size("runs"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"),
        F.coalesce(listed, F.lit("")).alias("spans"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup(table(spark, sf_dir, "documents"))


ORACLE_SQL = None
