"""Copy-on-write by file: a change of some rows replaces the files that hold them and leaves all others as they are.

Spark tells each row's file (``_metadata.file_path``).  A first pass finds the files of the rows a change may touch; it reads
the columns its condition names, and the statistics of the files skip what cannot match.  The change then runs over the rows of
these files alone, from old rows to new ones as for a whole table, and one commit puts the new files in the place of the
old (``rowloom.sources.commits``).  Inserted rows come with the new files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.operators.joins import keys_of
from rowloom.sources.commits import Change
from rowloom.sources.tables import write_partitioned

#: The column that tells the file of a row, for ``touched``: a number made of its name.
FILE = "__file"


class Changed(NamedTuple):
    """Names below the table: files that went, and files that came."""

    removed: list[str]
    added: list[str]


def rows_with(keys: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """The rows whose key occurs in the only column of ``keys``, which has the key's name.  A NULL is no key."""
    [key] = keys.columns
    return lambda table: table.join(keys_of(keys, key), key, "left_semi")


def files_of(table: DataFrame, touched: Column | Callable[[DataFrame], DataFrame]) -> list[str]:
    """The full names of the files of ``table`` that hold a row of ``touched``: a condition, or a function from the
    table, with the column ``__file``, to its rows that may change.  The list is names, never rows.

    The function joins as a rule, and a name in each row is most of what a join holds; so its rows carry the hash of the
    name, and a second look, at these files alone and at none of their columns, tells the names.  Names of one
    hash come together, which names more files and never fewer.
    """
    name = F.col("_metadata.file_path")
    if isinstance(touched, Column):
        found = table.filter(touched)
    else:
        numbers = touched(table.withColumn(FILE, F.xxhash64(name))).select(FILE).distinct().collect()
        if not numbers:
            return []
        found = table.filter(F.xxhash64(name).isin([r[0] for r in numbers]))
    return sorted(r[0] for r in found.select(name).distinct().collect())


def change_files(
    table: DataFrame,
    path: str,
    touched: Column | Callable[[DataFrame], DataFrame],
    change: Callable[[DataFrame], DataFrame],
    partition_by: Sequence[str] = (),
) -> Changed:
    """Apply ``change`` to the files of ``path`` that hold a row of ``touched``.

    ``table`` reads ``path``, all columns, nothing filtered.  ``touched`` may name more rows than change, never fewer; rows of
    the same files that do not change are written again as they are.  ``change`` gets the rows of these files and returns
    the new ones, with the same columns in any order; it may move rows to other partitions and add rows, also if no file is touched.
    Tables with buckets are not for this: their file names carry the bucket.  A failed change leaves the table as it was.
    """
    step = Change(table.sparkSession, path)
    names = files_of(table, touched)
    part = table.filter(F.col("_metadata.file_path").isin(names)) if names else table.limit(0)
    try:
        new = change(part)
        if partition_by:
            write_partitioned(new, step.staging, partition_by)
        else:
            new.write.parquet(step.staging)
        removed = [step.files.relative(unquote(n)) for n in names]
        added = _with_rows(table, step, removed)
    except BaseException:
        step.abandon()
        raise
    if removed or added:
        step.commit(removed, added)
    else:
        step.abandon()
    return Changed(removed, added)


def _with_rows(table: DataFrame, step: Change, removed: list[str]) -> list[str]:
    """The staged files; those without rows stay behind, but for one if the table would be left without a file."""
    staged = step.staged()
    if not staged:
        return []
    rows = table.sparkSession.read.schema(table.schema).parquet(step.staging)
    full = {step.files.relative(unquote(r[0])) for r in rows.select(F.col("_metadata.file_path")).distinct().collect()}
    added = [n for n in staged if f"{step.new}/{n}" in full]
    if added:
        return added
    others = [n for n in step.files.listed("") if not any(part.startswith(("_", ".")) for part in n.split("/"))]
    return [] if set(others) - set(removed) else staged[:1]
