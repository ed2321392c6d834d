"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.shared import checkpoint


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (id, component): each linked id with the smallest id that it reaches.

    In each round every id takes the smallest label among its neighbours', and then that label's own label, so the number
    of rounds grows as the logarithm of the longest path.  Each round is checkpointed.
    """
    ends = lambda a, b: F.struct(F.col(a).alias("a"), F.col(b).alias("b"))
    # Exploded, not united: a union would compute the links twice.
    both = links.where("a != b").select(F.explode(F.array(ends("a", "b"), ends("b", "a"))).alias("l"))
    both = checkpoint(both.select("l.a", "l.b").distinct())
    state = checkpoint(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")))
    while True:
        lowest = both.join(state.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("low"))
        taken = state.join(lowest, "id").withColumn("low", F.least("label", "low"))
        jumps = state.select(F.col("id").alias("low"), F.col("label").alias("jump"))
        after = checkpoint(taken.join(jumps, "low", "left").select("id", "label", F.least("low", F.coalesce("jump", "low")).alias("next")))
        if after.where("next != label").isEmpty():
            return state.withColumnRenamed("label", "component")
        state = after.select("id", F.col("next").alias("label"))


def merged(stored: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) after new links: components that they join are merged, and ids that are new come in.

    ``stored``: id, component, as ``components`` gives them; an id without a row is a component of its own.  Only the links
    and the components that they touch go through the rounds, whatever the number of stored ids.  Links may come in any
    batches: the result is that of all of them at once.
    """
    name = lambda side: stored.select(F.col("id").alias(side), F.col("component").alias(f"_{side}"))
    named = links.select("a", "b").join(name("a"), "a", "left").join(name("b"), "b", "left")
    ends = checkpoint(named.select("a", "b", F.coalesce("_a", "a").alias("x"), F.coalesce("_b", "b").alias("y")))
    moved = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("id").alias("_old"), F.col("component").alias("_new"))
    after = stored.join(moved, F.col("component") == F.col("_old"), "left").select("id", F.coalesce("_new", "component").alias("component"))
    ids = ends.where("a != b").select(F.explode(F.array("a", "b")).alias("id")).distinct().join(stored.select("id"), "id", "left_anti")
    new = ids.join(moved, F.col("id") == F.col("_old"), "left").select("id", F.coalesce("_new", "id").alias("component"))
    return after.unionByName(new)
