"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an exponential variate and divides it by its quality weight; the documents of a
source in the order of these keys are a weighted sample without replacement, whatever their number
(Efraimidis and Spirakis).  A source's word budget is first spent on complete epochs; what is left goes to
the documents with the smallest keys, found by a prefix sum of their sizes.

No source is sorted as a whole.  The keys are cut into slices by a function that keeps their order; slice
totals, a few thousand rows a source, show the one slice in which the budget ends, and only the documents of
that slice are sorted.  A source with a third of all rows therefore costs one aggregation like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.llm.common import BETWEEN, bounded, kept, table, text_of

#: Slices of the keys of one source.
SLICES = 4096
#: Sources up to this number are broadcast: one short row each.
SOURCE_ROWS = 50_000


def word_count(text: Column) -> Column:
    """Number of words.  A text is cut once; empty pieces at its ends are not words."""
    pieces = F.split(text, BETWEEN)
    ends = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0) + F.when(
        (F.size(pieces) > 1) & (F.element_at(pieces, -1) == ""), 1
    ).otherwise(0)
    return (F.size(pieces) - ends).cast("long")


def quality_weight(text: Column) -> Column:
    """Share of letters among the characters, from 0.05 for no letter to 1."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return F.lit(0.05) + F.lit(0.95) * letters / F.greatest(F.length(text), F.lit(1))


def sampling_key(name: Column, weight: Column, seed: str) -> Column:
    """An exponential variate, the same in every run, divided by the weight."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(name.cast("string"), F.lit("")))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    return -F.log(uniform) / weight


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add the target of each source; ``sources`` has source and source_size, one row each.

    Sources by code point, null last, take the weights in turn.  Targets are ``share`` of all sizes by
    weight; a target above ``most`` times its source's size stops there and the excess is shared
    again by weight.  With sources ordered by the level at which they fill up, the level for all is the
    highest one that no later source exceeds, so no rounds are needed.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    full = (
        sources.withColumn("turn", F.row_number().over(by_name) - 1)
        .withColumn("weight", turn)
        .withColumn("most", F.col("source_size") * F.lit(float(most)))
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("all", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("spent", F.sum("most").over(by_level.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("sharing", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn(
            "level", (F.col("all") * F.lit(float(share)) - F.coalesce("spent", F.lit(0.0))) / F.col("sharing")
        )
    )
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(Window.partitionBy())
    return full.withColumn("at", level).select(
        "source",
        "source_size",
        F.least("most", F.col("weight") * F.coalesce("at", F.lit(float("inf")))).alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (1, 2, 3),
    share: float = 1.0,
    most: float = 3,
    seed: str = "mix:",
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, epochs, taken``.

    ``taken`` are the words the mix takes: ``epochs`` times the whole document, and once more if its key is
    inside what is left of the budget.  The document in which the budget ends gives only the words up to it,
    so the taken words of a source are its target rounded to a word.

    A null text counts as empty.  Documents without a word are taken with 0 words.  A null source is
    a source of its own.  Repeated rows are documents of their own; rows with one id share a key and
    are taken in the order of their sizes.  Empty input gives no rows.  Other columns are not read.
    """
    text = text_of(text_col)
    slim = kept(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text.alias("text"))
        .select("doc_id", "source", word_count(F.col("text")).alias("size"), quality_weight(F.col("text")).alias("w"))
        .withColumn("key", sampling_key(F.col("doc_id"), F.col("w"), seed))
        .withColumn("slice", F.floor(F.col("key") / (F.col("key") + 1) * SLICES).cast("int"))
        .drop("w"),
        "mix-sizes",
    )
    slices = kept(slim.groupBy("source", "slice").agg(F.sum("size").alias("in_slice")), "mix-slices")
    wanted = (
        targets(slices.groupBy("source").agg(F.sum("in_slice").alias("source_size")), weights, share, most)
        .withColumn(
            "epochs",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
        )
        .withColumn("left", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long"))
    )
    in_order = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        slices.withColumn("before", F.coalesce(F.sum("in_slice").over(in_order), F.lit(0)))
        .withColumnRenamed("source", "s")
        .join(wanted, F.col("s").eqNullSafe(F.col("source")))
        .groupBy("source")
        .agg(
            *[F.first(c).alias(c) for c in ("source_size", "target", "epochs", "left")],
            F.max(F.when(F.col("before") < F.col("left"), F.struct("slice", "before"))).alias("end"),
        )
        .withColumnRenamed("source", "s")
    )
    known = slim.join(bounded(kept(ends, "mix-ends"), SOURCE_ROWS), F.col("s").eqNullSafe(F.col("source"))).drop("s")
    last = F.coalesce(F.col("end.slice"), F.lit(-1))
    outside = known.filter(F.col("slice") != last).withColumn(
        "more", F.when(F.col("slice") < last, F.col("size")).otherwise(0)
    )
    by_key = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("left") - F.col("end.before") - F.coalesce(F.sum("size").over(by_key), F.lit(0))
    inside = known.filter(F.col("slice") == last).withColumn("more", F.greatest(F.lit(0), F.least("size", room)))
    return outside.unionByName(inside).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "epochs",
        (F.col("epochs") * F.col("size") + F.col("more")).cast("long").alias("taken"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         0.05::DOUBLE + 0.95::DOUBLE * length(regexp_replace(coalesce(text, ''), '[^\p{L}]', '', 'g'))
           / greatest(length(coalesce(text, '')), 1) AS w,
         (('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT + 0.5::DOUBLE)
           / 4503599627370496::DOUBLE AS u
  FROM documents),
keyed AS (SELECT doc_id, source, size, -ln(u) / w AS key FROM sized),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM keyed GROUP BY source),
turns AS (SELECT *, [1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
          source_size * 3.0::DOUBLE AS most FROM sources),
levels AS (SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
           FROM turns WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
wanted AS (SELECT source, source_size,
             least(most, weight * max(CASE WHEN level <= most / weight THEN level END) OVER ()) AS target FROM levels),
spent AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM wanted),
ranked AS (
  SELECT k.*, s.source_size, s.target, s.epochs,
         CAST(floor(s.target - s.epochs * s.source_size + 0.5) AS BIGINT)
           - coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM keyed k JOIN spent s ON k.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, source_size, target, epochs,
       CAST(epochs * size + greatest(0, least(size, room)) AS BIGINT) AS taken
FROM ranked
"""
