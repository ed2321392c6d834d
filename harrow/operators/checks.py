"""Rules that rows must keep: those that don't are set aside with the rules they break, and counted in the same job."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from harrow.shared import delete, rename

GOOD, BAD = "kept", "set_aside"


def broken(rules: Mapping[str, Column]) -> Column:
    """array<string>: names, in order, of the rules that don't hold; what is null doesn't hold."""
    names = F.array(*(F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()))
    return F.filter(names, lambda n: n.isNotNull())


def write_checked(rows: DataFrame, rules: Mapping[str, Column], path: str, *, facts: Mapping[str, Column] | None = None, guard: Callable[[dict], str | None] | None = None) -> dict:
    """Writes the rows that keep all rules to ``path``/outcome=kept and the others, with ``broken``, to
    ``path``/outcome=set_aside, in one pass over the rows; gives the numbers of rows, of kept ones and of breaches by rule.

    ``facts`` are columns of which aggregates over the kept rows are taken in the same pass; how, the first word of their
    names says (``AGGREGATES``).  ``guard`` gets the counts and facts and names what
    is wrong with them; then nothing is published, and what was at ``path`` stays.
    """
    spark, seen = rows.sparkSession, Observation(f"checked-{uuid.uuid4().hex}")
    marked = rows.withColumn("broken", broken(rules))
    kept = F.size("broken") == 0
    counts = [F.count("*").alias("rows"), F.count(F.when(kept, 1)).alias(GOOD), *(F.count(F.when(F.array_contains("broken", n), 1)).alias(f"broken {n}") for n in rules)]
    over = {n: F.col(f"_fact_{n}") for n in facts or {}}
    named = marked.withColumns({f"_fact_{n}": F.when(kept, c) for n, c in (facts or {}).items()})
    observed = named.observe(seen, *counts, *(AGGREGATES[n.split(" ", 1)[0]](c).alias(n) for n, c in over.items()))
    new = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    observed.drop(*(f"_fact_{n}" for n in over)).withColumn("outcome", F.when(kept, GOOD).otherwise(BAD)).write.partitionBy("outcome").parquet(new)
    found = dict(seen.get)
    if guard and (wrong := guard(found)):
        delete(spark, new)
        raise ValueError(wrong)
    delete(spark, path)
    rename(spark, new, path)
    return found


#: What a fact's name begins with says how it is aggregated.
AGGREGATES: dict[str, Callable[[Column], Column]] = {"least": F.min, "most": F.max, "sum": F.sum, "distinct": lambda c: F.approx_count_distinct(c, 0.01)}


def kept_rows(rows: DataFrame) -> DataFrame:
    """Of a table as ``write_checked`` leaves it, the rows that kept all rules."""
    return rows.where(F.col("outcome") == GOOD).drop("outcome", "broken")


def set_aside(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("outcome") == BAD).drop("outcome")
