"""Connected components by joins: labels fall to the smallest node and are shortened by jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """Rows node, root (smallest node of its component) for all nodes of edges (a, b).

    Alternates large-star and small-star: every node hands its larger neighbours, then its smaller ones, to the smallest
    node it knows. A round costs two aggregations and joins on narrow rows and is written to the shared folder;
    the number of rounds grows with the logarithm of the longest chain.
    """
    links = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links")
    before = _state(links)
    while True:
        both = links.union(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo"))).toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("_least")).select("node", F.least("node", "_least").alias("_least"))
        large = both.join(least, "node").where("other > node and other <> _least").select(F.col("other").alias("hi"), F.col("_least").alias("lo"))
        below = large.groupBy("hi").agg(F.min("lo").alias("_least"))
        small = large.join(below, "hi")
        starred = small.select(F.when(F.col("lo") == F.col("_least"), F.col("hi")).otherwise(F.col("lo")).alias("hi"), F.col("_least").alias("lo"))
        after = saved(starred.distinct(), "links")
        state = _state(after)
        if state == before:
            break
        links, before = after, state
    roots = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return saved(roots.union(links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()), "components")


def _state(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    mixed = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mixed), F.sum(F.col("hi").cast("decimal(38,0)"))).first())
