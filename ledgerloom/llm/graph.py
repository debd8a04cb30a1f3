"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import discard, staged

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b); the root is the
    smallest node of its component, and points at itself.

    Each round hangs every node's neighbours on the smallest of them. A node's minimum
    is summed before the shuffle and handed back by an equi-join, so a node that a third
    of the edges touch is split by Spark like any skewed join key. Each round is a table
    in the shared folder. Ids may be of any type that can be ordered.
    """
    now = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(MOST_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        large = staged(large, "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        )
        small = staged(small, "edges")
        discard(now)
        discard(large)
        now = small
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
