"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F


def group_apart(df: DataFrame, *columns: str) -> GroupedData:
    """Group by ``columns`` for a join on them; get them back with ``.select("__key.*", ...)``.

    Spark would use the shuffle of the grouping for the join as well, and then cannot cut the
    join at a hot key, because it only cuts what comes straight from a shuffle.  Grouping by one
    struct of the columns leaves the join its own shuffle, of one row per key.
    """
    return df.groupBy(F.struct(*columns).alias("__key"))


def keys_of(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct keys, for a join on them; reduced inside each map task before any shuffle."""
    return df.select(F.struct(*columns).alias("__key")).distinct().select("__key.*")


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a side with many rows per key.

    Spark can cut a hot partition of an outer join only on the kept side.  Here the
    many-side is the other one, so the join is written as an inner join, which it can
    cut on both sides, plus the left rows without a partner.
    """
    on = list(on)
    partnered = left.join(right, on, "inner")
    alone = left.join(keys_of(right, *on), on, "left_anti")
    return partnered.unionByName(alone, allowMissingColumns=True)


def mark_members(df: DataFrame, key: str, members: DataFrame, mark: str) -> DataFrame:
    """Add ``mark``: TRUE where ``df.key`` occurs in the only column of ``members``.

    The members are made distinct first, so no row of ``df`` is repeated and a key that
    is hot in ``members`` costs one row per map task.
    """
    [column] = members.columns
    known = keys_of(members, column).select(F.col(column).alias(key), F.lit(True).alias(mark))
    return df.join(known, key, "left").withColumn(mark, F.coalesce(F.col(mark), F.lit(False)))


def not_in(df: DataFrame, key: str, members: DataFrame, mark: str) -> DataFrame:
    """Add ``mark`` with the value of ``key NOT IN (members)``, NULL included.

    TRUE for every row if there are no members; otherwise NULL where the key is NULL or
    where it is absent while the members hold a NULL.  Spark's own null-aware anti join
    has to broadcast the members, this one shuffles both sides.
    """
    [column] = members.columns
    facts = (
        members.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("nulls"))
        .select(F.struct((F.col("n") == 0).alias("empty"), (F.col("nulls") > 0).alias("has_null")))
        .scalar()
    )
    marked = mark_members(df, key, members.filter(F.col(column).isNotNull()), mark)
    value = (
        F.when(facts["empty"], F.lit(True))
        .when(F.col(key).isNull(), F.lit(None).cast("boolean"))
        .when(F.col(mark), F.lit(False))
        .when(facts["has_null"], F.lit(None).cast("boolean"))
        .otherwise(F.lit(True))
    )
    return marked.withColumn(mark, value)


def drop_members(df: DataFrame, key: str, members: DataFrame, when: Column | None = None) -> DataFrame:
    """Remove rows whose key occurs in ``members`` (and for which ``when`` is TRUE).

    Rows with a NULL key, or an unknown condition, stay.  ``when`` names columns of ``df``.
    """
    [column] = members.columns
    known = keys_of(members, column).select(F.col(column).alias("__member"))
    match = F.col(key) == F.col("__member")
    return df.join(known, match if when is None else match & when, "left_anti")
