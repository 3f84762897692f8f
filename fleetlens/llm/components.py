"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import discard, keep


def _hang(pairs: DataFrame, own: bool) -> DataFrame:
    """Hang every ``b`` of a node ``a`` (and ``a`` too, if ``own``) on the least node among them."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")).withColumnRenamed("a", "_a")
    hung = pairs.join(least, pairs["a"] == least["_a"])
    out = hung.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    if own:
        out = out.unionByName(least.where("_a <> least").select(F.col("_a").alias("a"), F.col("least").alias("b")))
    return out.distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(a, b) links between numbered nodes -> (node, root): root is the least node of the component.

    Nodes without a link to another node don't appear. The number of rounds grows with the logarithm of
    the number of nodes; each is written to the shared checkpoint folder. A step emits at most two rows
    per link, so a star whose centre a third of all nodes share stays linear (and its join may be split).
    """
    now = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")).withColumnRenamed("a", "_a")
        large = both.join(least, both["a"] == least["_a"]).where("b > a AND b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        then = keep(_hang(large, True), name)
        size = then.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        discard(now)
        now = then
        if size == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = size
