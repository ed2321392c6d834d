"""Connected components of a table of links, by label spreading with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import checkpoint


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of longs -> (id, component): each linked id with the smallest id it reaches.

    Each round gives every id the smallest label among itself and its neighbours, then that label's label, so the number
    of rounds grows with the logarithm of the longest path.  Rounds are kept in the shared folder, which cuts lineage.
    """
    ends = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    # Exploded, not united, so that links are computed once; each id is its own neighbour.
    both = links.where("a != b").select(F.explode(F.array(ends("a", "b"), ends("b", "a"), ends("a", "a"), ends("b", "b"))).alias("l"))
    both = checkpoint(both.select("l.a", "l.b").distinct())
    labels = checkpoint(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label")))
    while True:
        own = F.min(F.when(F.col("a") == F.col("b"), F.col("label")))
        lower = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(own.alias("label"), F.min("label").alias("new"))
        jump = lower.select(F.col("id").alias("new"), F.col("new").alias("far"))
        moved = checkpoint(lower.join(jump, "new", "left").select("id", "label", F.least("new", F.coalesce("far", "new")).alias("new")))
        if moved.where("new != label").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
        labels = moved.select("id", F.col("new").alias("label"))
