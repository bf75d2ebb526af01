"""Row numbers and running sums for groups too large for one task.

A group of more than ``HOT`` rows is cut into pieces by splitters of its order, which come from a sample of its rows, as many as
its size asks for.  Sums inside a piece are shifted by the totals of the pieces before it.  All other groups go through one
plain window.  Which way a group goes changes the cost, never the result.

Tables given to these functions are read several times, narrow first: give them kept tables (``sources.tables.kept``).
Sizes, splitters and the rows of hot groups are kept tables too, so nothing above is computed twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowloom.operators.joins import group_apart
from rowloom.sources.tables import kept

#: Rows of a group from which it is cut; pieces of a group at most; sampled rows for each piece.
HOT, PIECES, SAMPLE = 1_000_000, 4096, 100
#: Splitters that are compared one by one: a row is compared with the first of each block, then inside one block.
BLOCK = 64
SEED = 42


def _above(array: Column, value: Column) -> Column:
    """How many elements are below ``value``."""
    return F.size(F.filter(array, lambda x: x < value))


def hot_groups(df: DataFrame, keys: Sequence[str], hot: int) -> DataFrame | None:
    """The groups of more than ``hot`` rows, ``keys`` and ``__size``, as a kept table; None if there are none."""
    sizes = group_apart(df, *keys).agg(F.count(F.lit(1)).alias("__size")).filter(F.col("__size") > hot)
    found = kept(sizes.select("__key.*", "__size"), "hot-groups")
    return None if found.isEmpty() else found


def _splitters(rows: DataFrame, keys: Sequence[str], hot: int) -> DataFrame:
    """``keys`` and ``__splits``, blocks of splitters, from ``rows`` with ``__size`` and the order ``__at``.

    A group's sample has ``SAMPLE`` rows a piece on average, whatever its size.
    """
    pieces = F.least(F.lit(PIECES), F.ceil(F.col("__size") / hot)).cast("int")
    sampled = rows.select(*keys, "__at", pieces.alias("__pieces"), "__size").filter(
        F.rand(SEED) < F.col("__pieces") * SAMPLE / F.col("__size")
    )
    lists = sampled.groupBy(*keys).agg(F.sort_array(F.collect_list("__at")).alias("all"), F.max("__pieces").alias("n"))
    chosen = F.expr(
        """array_distinct(transform(filter(sequence(1, n), i -> i < n),
                                    i -> all[least(size(all) - 1, CAST(i * size(all) DIV n AS INT))]))"""
    )
    blocks = F.expr(
        f"transform(sequence(0, greatest(size(cut) - 1, 0) DIV {BLOCK}), i -> slice(cut, i * {BLOCK} + 1, {BLOCK}))"
    )
    return kept(lists.select(*keys, chosen.alias("cut")).select(*keys, blocks.alias("__splits")), "splitters")


def _cut(df: DataFrame, keys: Sequence[str], order: Sequence[Column], groups: DataFrame, hot: int) -> DataFrame:
    """The rows of hot groups with ``__piece``, a kept table."""
    inside = df.join(groups, list(keys)).withColumn("__at", F.struct(*order))
    splits = _splitters(inside, keys, hot)
    at, blocks = F.col("__at"), F.col("__splits")
    # A sample may have missed a group: it stays one piece.
    block = F.greatest(_above(F.transform(blocks, lambda b: F.try_element_at(b, F.lit(1))), at) - 1, F.lit(0))
    piece = block * BLOCK + _above(F.get(blocks, block), at)
    placed = df.withColumn("__at", F.struct(*order)).join(groups.select(*keys), list(keys)).join(splits, list(keys), "left")
    return kept(placed.withColumn("__piece", F.coalesce(piece, F.lit(0))).drop("__at", "__splits"), "hot-rows")


def _shifted(rows: DataFrame, keys: Sequence[str], weight: Column, inside: Column, name: str) -> DataFrame:
    """``inside``, a sum over a piece, plus the weights of the pieces before it."""
    earlier = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "__piece").agg(F.sum(weight).alias("__all"))
    starts = totals.select(*keys, "__piece", F.coalesce(F.sum("__all").over(earlier), F.lit(0)).alias("__start"))
    shifted = rows.withColumn("__in", inside).join(starts, [*keys, "__piece"])
    return shifted.withColumn(name, F.col("__start") + F.col("__in")).drop("__start", "__in", "__piece")


def _apart(df: DataFrame, keys: Sequence[str], groups: DataFrame) -> DataFrame:
    """The rows of all other groups."""
    return df.join(groups.select(*keys), list(keys), "left_anti")


def weight_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], weight: str, name: str, hot: int = HOT
) -> DataFrame:
    """Sum of ``weight`` over the rows of a group that come before a row and its peers.

    ``order`` are ascending values, NULL first; they must tell apart the rows of a hot group, as peers share a piece.
    Keys must not be NULL.
    """
    keys = list(keys)

    def before(*parts: str) -> Column:
        # The default frame of an ordered window includes the peers of a row.
        through = F.sum(weight).over(Window.partitionBy(*parts).orderBy(*order))
        return through - F.sum(weight).over(Window.partitionBy(*parts, *order))

    groups = hot_groups(df, keys, hot)
    if groups is None:
        return df.withColumn(name, before(*keys))
    cut = _cut(df, keys, order, groups, hot)
    return (
        _apart(df, keys, groups)
        .withColumn(name, before(*keys))
        .unionByName(_shifted(cut, keys, F.col(weight), before(*keys, "__piece"), name))
    )


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, hot: int = HOT) -> DataFrame:
    """Row numbers from 1 inside each group, ties in any order.

    ``order`` are ascending values, NULL first; they must tell apart the rows of a hot group.  Keys must not be NULL.
    """
    keys = list(keys)

    def number(*parts: str) -> Column:
        return F.row_number().over(Window.partitionBy(*parts).orderBy(*order)).cast("long")

    groups = hot_groups(df, keys, hot)
    if groups is None:
        return df.withColumn(name, number(*keys))
    cut = _cut(df, keys, order, groups, hot)
    return (
        _apart(df, keys, groups)
        .withColumn(name, number(*keys))
        .unionByName(_shifted(cut, keys, F.lit(1), number(*keys, "__piece"), name))
    )


def spread_ids(df: DataFrame, group: str, place: str, name: str, digits: int = 3) -> DataFrame:
    """Add consecutive ids 1..N without a global sort.

    ``place`` numbers the rows of one ``group`` value from 1.  Groups are ordered by the
    first hex ``digits`` of their MD5 and then by name: one window numbers the groups
    inside each of the 16^digits buckets, a second one adds up the buckets, which are a
    fixed number of rows whatever the size of ``df``.

    The sizes of the groups are kept once, and all sums read them; the rows of ``df`` only meet the first id of their group.
    """
    bucket = F.substring(F.md5(F.col(group)), 1, digits)
    sizes = kept(df.groupBy(group).agg(F.count(F.lit(1)).alias("__size")).withColumn("__bucket", bucket), "group-sizes")
    in_bucket = Window.partitionBy("__bucket").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    all_buckets = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        sizes.groupBy("__bucket")
        .agg(F.sum("__size").alias("__all"))
        .select("__bucket", F.coalesce(F.sum("__all").over(all_buckets), F.lit(0)).alias("__bucket_start"))
    )
    starts = (
        sizes.withColumn("__in_bucket", F.coalesce(F.sum("__size").over(in_bucket), F.lit(0)))
        # At most 16^digits rows: the one broadcast here has a fixed bound.
        .join(F.broadcast(buckets), "__bucket")
        .select(group, (F.col("__bucket_start") + F.col("__in_bucket")).alias("__start"))
    )
    return df.join(starts, group).withColumn(name, F.col("__start") + F.col(place)).drop("__start")
