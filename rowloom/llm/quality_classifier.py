"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text is its words and pairs of neighbouring words (a word followed by itself is one pair, whichever word it is),
hashed to ``2**BITS`` places with the logarithm of their counts, scaled to length one.  FTRL-Proximal (McMahan and others, 2013) goes through the training rows
one by one with a learning rate per place; most places end at exactly zero.  A score is a sparse dot product.

The model is fitted on at most ``SAMPLE`` labelled rows, taken by a hash of the id; the bound keeps the
training tasks small at any size of the corpus.  Features are made where the documents are; each task trains on a shard of
about ``SHARD_ROWS`` rows, and the weights of at most ``SAMPLE / SHARD_ROWS`` shards are averaged.  Scoring covers every row, in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.llm.common import kept, table, text_of

#: Hashed places, plus one for the bias.
BITS = 18
#: Most labelled rows the model is fitted on, and rows of one training task.
SAMPLE, SHARD_ROWS = 20_000, 5_000
#: FTRL-Proximal: learning rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.002, 0.01
#: Passes over the rows of a shard: 5, and up to 20 until a small shard has made so many steps.
PASSES, MOST_PASSES, STEPS = 5, 20, 25_000
#: The pair of any word with itself.
SAME = np.uint32(0x5A5A5A5A)
#: Scores from here on are predicted good.
THRESHOLD = 0.3


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text; the bias, place ``2**bits``, is always there."""
    # bytes.split cuts at exactly the six white-space characters of ASCII.
    words = (text or "").encode("utf-8", "surrogatepass").split()
    one = np.fromiter(map(crc32, words), np.uint32, len(words))
    two = one[:-1] * np.uint32(0x9E3779B1) ^ one[1:] * np.uint32(0x85EBCA6B)
    two[one[:-1] == one[1:]] = SAME
    both = np.concatenate([one, two])
    places, counts = np.unique((both * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits), return_counts=True)
    values = 1 + np.log(counts.astype(np.float32))
    if len(values):
        values /= np.sqrt((values * values).sum())
    return np.append(places.astype(np.int32), np.int32(1 << bits)), np.append(values, np.float32(1))


class Ftrl:
    """The state of one training task: two sums per place."""

    def __init__(self, bits: int):
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, places: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(places)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = (p - label) * values
        n = self.n[places]
        self.z[places] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[places] = n + g * g


def training_rows(labels: DataFrame, label_col: str, sample: int) -> DataFrame:
    """At most ``sample`` ids with one label each; several labels of an id are settled by their mean.

    Held-out ids, those whose CRC-32 as text is a multiple of five, are never among them.
    """
    return (
        labels.select(F.col("doc_id"), F.col(label_col).alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 5 <> 0")
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    bits: int = BITS,
) -> np.ndarray:
    """The weights, ``2**bits + 1`` numbers; all zero if no document is labelled."""
    chosen = kept(training_rows(labels, label_col, sample).withColumnRenamed("doc_id", "labelled"), "quality-sample")
    shards = max(1, round(chosen.count() / SHARD_ROWS))
    # At most `sample` rows of two numbers, so this broadcast has a fixed bound.
    texts = (
        docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )

    def featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [features(t, bits) for t in rows["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"],
                    "label": rows["label"],
                    "shard": [crc32(f"shard {i}".encode()) % shards for i in rows["doc_id"]],
                    "places": [p.tobytes() for p, _ in made],
                    "values": [v.astype(np.float32).tobytes() for _, v in made],
                }
            )

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.assign(at=[crc32(f"order {i}".encode()) for i in rows["doc_id"]]).sort_values(["at", "doc_id"])
        data = [
            (np.frombuffer(p, np.int32), np.frombuffer(v, np.float32).astype(np.float64), y)
            for p, v, y in zip(rows["places"], rows["values"], rows["label"], strict=True)
        ]
        model = Ftrl(bits)
        for _ in range(max(PASSES, min(MOST_PASSES, STEPS // len(data)))):
            for places, values, y in data:
                model.learn(places, values, y)
        return pd.DataFrame({"n": [len(rows)], "weights": [model.weights().astype(np.float32).tobytes()]})

    fitted = (
        texts.mapInPandas(featurize, "doc_id long, label int, shard int, places binary, values binary")
        .groupBy("shard")
        .applyInPandas(fit, "n long, weights binary")
        .collect()
    )
    # One row of a megabyte for each shard.
    total = np.zeros((1 << bits) + 1)
    for row in fitted:
        total += row["n"] * np.frombuffer(row["weights"], np.float32)
    return (total / max(1, sum(row["n"] for row in fitted))).astype(np.float32)


def score(spark: SparkSession, text: Column, weights: np.ndarray, bits: int = BITS) -> Column:
    """The probability of a good document; a text without words gets what the bias says."""
    shared = spark.sparkContext.broadcast(weights)

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        w = shared.value

        def one(t: str) -> float:
            places, values = features(t, bits)
            return float(w[places] @ values.astype(np.float32))

        return pd.Series(1 / (1 + np.exp(-np.clip([one(t) for t in texts], -35, 35))), dtype="float64")

    return scored(text)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` in front of its own columns of other names.

    Ids must be integers.  A null text counts as empty.  A null id is scored and never trained on.  Repeated rows are scored each; of
    several texts of one id the smallest is trained on.  Without labels every score is 0.5.  Empty
    input gives no rows.  Columns of docs named score or predicted are replaced.
    """
    weights = train(docs, labels, id_col, text_col, label_col)
    scored = docs.withColumn("score", score(docs.sparkSession, text_of(text_col), weights))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.expr("crc32(CAST(doc_id AS STRING)) % 5 = 0"), F.lit(False))
    return classify(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", held_out.alias("held_out"), "score", F.col("predicted").cast("int").alias("predicted")
    )


ORACLE_SQL = None
