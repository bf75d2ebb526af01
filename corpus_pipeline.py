"""From raw documents to a mixed corpus: five stages, each an operator of ``rowloom.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm.common import table
from rowloom.llm.decontamination import without_leaks
from rowloom.llm.mixing import mix_sources
from rowloom.llm.pii import remove_personal_data
from rowloom.llm.quality_classifier import classify
from rowloom.llm.simhash import keep_one
from rowloom.session import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is trained on the labels of the documents it is given."""
    labels = table(spark, sf_dir, "labels")
    return classify(docs, labels).filter("predicted = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays, linked where fingerprints differ in two bits or fewer."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with the benchmark go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; the lengths follow."""
    cleaned = remove_personal_data(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mix_sources(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal_data),
    ("mixing", mix),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on the documents of ``sf_dir``."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
