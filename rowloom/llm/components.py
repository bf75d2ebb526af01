"""Connected components of a table of links, by alternating large and small stars.

Kiveris and others, "Connected Components in MapReduce and Beyond" (2014).  In a large-star step every node ties its larger
neighbours to the smallest node around it; in a small-star step every node ties its smaller neighbours likewise.
A fixed point is one star per component.  The number of rounds grows with the logarithm of the longest path.
Each step is two aggregations and a join over the links; a node with very many links is summed before the
shuffle, and its side of the join is one Spark can split.  Links stay tables throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import kept


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (a, b) are tied at ``a``: every b of an a goes to the smallest of them and a itself."""
    lowest = links.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("at"), F.least("a", "low").alias("low")
    )
    tied = links.join(lowest, F.col("a") == F.col("at"))
    if large:
        return tied.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    others = tied.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    own = lowest.filter("at <> low").select(F.col("at").alias("a"), F.col("low").alias("b"))
    return others.unionByName(own)


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (a, b); a component is named by its smallest node.

    Links may be repeated, point either way or at their own node; a null on either side drops
    the link.  No links give no rows.
    """
    down = (
        links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = kept(down, "links")
    before = None
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, large=True).distinct()
        small = _star(large, large=False).distinct()
        state = kept(small, "links")
        # Sums of hashes of all links: equal sums twice in a row mean that nothing has moved.
        found = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == before:
            break
        before = found
    roots = state.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
