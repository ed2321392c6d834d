"""Windows over long series: a symbol's rows are cut in ranges, so that no task holds a series whole.

A range is a span of time; ranges are summarised (how many rows, the last value), and a scan over a series' summaries, one
row a range, carries to each what came before it.  Frames of rows or days get the rows that precede their range as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days (or units of a number) of a range, and rows of a chunk.
SPAN, CHUNK = 64, 4096


def range_of(rows: DataFrame, on: str, span: int = SPAN) -> Column:
    """The number of a row's range; rows without a time are one of their own, the first."""
    kind = rows.schema[on].dataType.simpleString()
    value = F.unix_date(F.to_date(on)) if kind.startswith(("date", "timestamp", "string")) else F.col(on)
    return F.coalesce(F.floor(value / span).cast("long"), F.lit(-(1 << 62)))


def joined(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with what is carried to their range; keys may be null."""
    named = carried.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return rows.join(named, on, "left").drop(*(f"_key_{k}" for k in keys))


def with_ordinal(rows: DataFrame, by: str, on: str, name: str, *, span: int = SPAN) -> DataFrame:
    """The rows with their place in the series, from 0."""
    dealt = rows.withColumn("_range", range_of(rows, on, span))
    counts = dealt.groupBy(by, "_range").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select(by, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy(by, "_range").orderBy(on))
    return joined(dealt, carried, [by, "_range"]).withColumn(name, F.col("_before") + here - 1).drop("_range", "_before")


def in_chunks(rows: DataFrame, by: str, on: str, before: int, *, size: int = CHUNK, span: int = SPAN) -> DataFrame:
    """The rows dealt to ``_chunk`` s of ``size`` rows of a series, each led by the ``before`` rows that precede it, which are
    not ``_own``; ``_n`` is a row's place in the series.  Frames of so many rows can be taken by series and chunk."""
    numbered = with_ordinal(rows, by, on, "_n", span=span).withColumn("_home", F.floor(F.col("_n") / size))
    chunks = F.when(F.col("_n") % size >= size - before, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    return numbered.withColumn("_chunk", F.explode(chunks)).withColumn("_own", F.col("_chunk") == F.col("_home")).drop("_home")


def in_spans(rows: DataFrame, by: str, on: str, days: int, *, span: int) -> DataFrame:
    """The rows dealt to ``_range`` s of ``span`` days, each led by the rows of the ``days`` before it, which are not ``_own``."""
    home = range_of(rows, on, span)
    ranges = F.sequence(home, F.coalesce(F.floor((F.unix_date(F.to_date(on)) + days) / span).cast("long"), home))
    return rows.withColumns({"_home": home, "_range": F.explode(ranges)}).withColumn("_own", F.col("_range") == F.col("_home")).drop("_home")


def last_before(rows: DataFrame, by: str, on: str, order: list[Column], value: str, name: str, *, span: int = SPAN, forward: bool = False) -> DataFrame:
    """The rows with the last ``value`` that isn't null of the rows up to them in ``order``, which has to begin with ``on``;
    with ``forward``, with the first one of those from them on (``order`` then goes down)."""
    dealt = rows.withColumn("_range", range_of(rows, on, span))
    given = F.when(F.col(value).isNotNull(), F.col(on))
    summary = dealt.groupBy(by, "_range").agg((F.min_by if forward else F.max_by)(value, given).alias("_value"))
    at = F.desc("_range") if forward else F.asc("_range")
    before = Window.partitionBy(by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(by, "_range", F.last("_value", ignorenulls=True).over(before).alias("_carried"))
    here = F.last(value, ignorenulls=True).over(Window.partitionBy(by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return joined(dealt, carried, [by, "_range"]).withColumn(name, F.coalesce(here, F.col("_carried"))).drop("_range", "_carried")
