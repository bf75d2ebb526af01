"""What several operators share: tables, words, kept tables, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.sources.tables import kept

__all__ = ["WORD", "bounded", "kept", "table", "text_of", "words"]

# What a word is, and what stands between words.
WORD = r"[^\x20\x09-\x0D]+"
BETWEEN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty if null."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order; none for a null text."""
    pieces = F.split(F.coalesce(text, F.lit("")), BETWEEN)
    return F.filter(pieces, lambda w: w != "")


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else left to Spark's join choice.

    The rows are counted up to the bound only, so ``df`` should be cheap to compute or a kept table.
    """
    if df.limit(rows + 1).count() <= rows:
        return F.broadcast(df)
    return df
