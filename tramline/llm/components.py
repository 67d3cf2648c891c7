"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for the links ``a, b`` (longs): the smallest node that a node reaches.

    Alternating large-star and small-star steps: every step hangs neighbours
    on the smallest one, so the links stay as many as they were and a hub never
    meets in one group. Nulls and links of a node to itself are ignored; nodes
    without another link do not appear. An empty list gives an empty result.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    links = checkpointed(links)
    seen = None
    while (now := links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()) != seen:
        seen = now
        both = links.union(links.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").filter("a < b")
        large = large.distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("m").alias("x"), "a").filter("x < a").union(least.select("m", "b"))
        links = checkpointed(small.toDF("a", "b").distinct())
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")) \
        .union(links.select("a", "a").distinct())
