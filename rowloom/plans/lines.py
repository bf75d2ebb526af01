"""Keyword lines of scripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.functions.text import file_lines, has_keyword, strip
from rowloom.operators.wordsearch import find_words
from rowloom.sources.scripts import split_path

# The words looked for in every script.
KEYWORDS = ("default", "key_mst")
JOB_WORDS = ("EMRPUTF", "EMRPUT")


def has_any(text: Column, words: Sequence[str], case_sensitive: bool = False) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | has_keyword(text, word, case_sensitive)
    return found


def lines_with(
    files: DataFrame, words: Sequence[str], case_sensitive: bool = False, key: str = "dir_file", text: str = "content"
) -> DataFrame:
    """(key, line) of texts held as one row per file; texts without any word are not split."""
    hit = files.filter(has_any(F.col(text), words, case_sensitive))
    return hit.select(key, F.explode(file_lines(F.col(text))).alias("line"))


def keyword_lines(
    lines: DataFrame, keywords: Sequence[str] = KEYWORDS, case_sensitive: bool = False
) -> DataFrame:
    """Every line holding a keyword, once per keyword, trimmed; one pass for all keywords.

    ``lines`` comes from ``lines_with`` or, for files too large to hold as one row, from
    ``rowloom.sources.scripts.scan_lines``.
    """
    line = F.col("line")
    hits = F.array_compact(F.array(*[F.when(has_keyword(line, k, case_sensitive), k) for k in keywords]))
    rest = [c for c in lines.columns if c != "line"]
    return (
        lines.filter(has_any(line, keywords, case_sensitive))
        .select(*rest, F.explode(hits).alias("keyword"), "line")
        .withColumn("line", strip(line))
    )


def keyword_table_lines(lines: DataFrame, keywords: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """``keyword_lines`` for a table of keywords, of one column and any number of rows."""
    found = find_words(lines, keywords, "line", case_sensitive)
    rest = [c for c in lines.columns if c != "line"]
    return found.select(*rest, F.col("word").alias("keyword"), strip(F.col("line")).alias("line"))


def job_word(line: Column) -> Column:
    """The job word of a line; the longer one contains the shorter one, so it is tried first."""
    longer, shorter = JOB_WORDS
    return F.when(F.contains(line, F.lit(longer)), longer).when(F.contains(line, F.lit(shorter)), shorter)


def emrput_lines(lines: DataFrame) -> DataFrame:
    """Lines with a job word, upper case only."""
    found = lines.withColumn("emrput_type", job_word(F.col("line"))).filter(F.col("emrput_type").isNotNull())
    return split_path(found.select("dir_file", "emrput_type", strip(F.col("line")).alias("emrput_line")))


def script_keyword_lines(lines: DataFrame, keywords: Sequence[str] = KEYWORDS) -> DataFrame:
    return split_path(keyword_lines(lines, keywords))


def count_lines(content: Column, test) -> Column:
    """How many lines of a text pass ``test``."""
    return F.size(F.filter(file_lines(content), test))
