"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quality_lake.sources import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links (a long, b long)``: ``label`` is the
    smallest node that can be reached.

    Each round, a node takes the smallest label among its own, its neighbours' and
    its label's label (pointer jumping), and the node that a label names takes the
    smallest label next to any node of that label (hooking), so whole trees merge in
    a round and the rounds grow with the logarithm of the longest path only.  Both
    sides of the joins on a node are tables (the round before, written to the shared
    folder), so skew handling splits a node with very many neighbours, and
    aggregation is partial before its shuffle.
    """
    both = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "links")
    held = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                 .select("node", F.least("node", "least").alias("label")), "labels")
    null = F.lit(None).cast("long").alias("was")
    while True:
        jumped = held.join(held.select(F.col("node").alias("label"), F.col("label").alias("next")), "label").select("node", F.col("next").alias("label"))
        told = both.join(held.select(F.col("node").alias("a"), "label"), "a").groupBy(F.col("b").alias("node")).agg(F.min("label").alias("label"))
        hooked = told.join(held.select("node", F.col("label").alias("root")), "node").select(F.col("root").alias("node"), "label")
        own = held.select("node", "label", F.col("label").alias("was"))
        made = stage(own.unionByName(jumped.select("node", "label", null)).unionByName(told.select("node", "label", null))
                     .unionByName(hooked.select("node", "label", null))
                     .groupBy("node").agg(F.min("label").alias("label"), F.max("was").alias("was")), "labels")
        if made.filter("label <> was").isEmpty():
            return made.select("node", "label")
        held = made.select("node", "label")
