"""Generic DataFrame -> DataFrame operators: keyed upserts, as-of joins, balanced top-k, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harrow.operators import series


def last_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Of each key the row that comes last in ``order``.  Tasks keep one row a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*(o.desc() for o in order))
    return rows.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def upsert(stored: DataFrame, updates: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Stored rows with updates put in by key: an update wins over what is stored, a later update over an earlier."""
    seq = F.col(order) if order else F.lit(0)
    both = stored.withColumns({"_new": F.lit(0), "_seq": seq}).unionByName(updates.withColumns({"_new": F.lit(1), "_seq": seq}))
    return last_wins(both, keys, [F.col("_new"), F.col("_seq")]).drop("_new", "_seq")


def replace_by(stored: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Stored rows without those whose key is updated, and the updates."""
    return stored.join(updates.select(key).distinct(), key, "left_anti").unionByName(updates)


def asof_backward(left: DataFrame, right: DataFrame, *, by: str, on: str, value: str, name: str, strict: bool, span: int = series.SPAN) -> DataFrame:
    """Left rows with the last right ``value`` of the same ``by`` at or (if ``strict``, only) before ``on``.

    Both sides are sorted once together by key and range of ``on``: no pairs are made, and no task holds a key whole.
    """
    cols = left.columns
    l = left.select(F.struct(*cols).alias("_row"), F.col(by), F.col(on), F.lit(0 if strict else 1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias("_value"))  # noqa: E741
    r = right.select(F.lit(None).cast(l.schema["_row"].dataType).alias("_row"), F.col(by), F.col(on), F.lit(1 if strict else 0).alias("_side"), F.col(value).alias("_value"))
    found = series.last_before(l.unionByName(r), by, on, [F.col(on), F.col("_side")], "_value", "_found", span=span)
    return found.where(F.col("_row").isNotNull()).select("_row.*", F.col("_found").alias(name))


def balanced_top(rows: DataFrame, *, limit: int, news_limit: int, order: Sequence[Column]) -> DataFrame:
    """The best ``limit`` rows by ``section``: news up to its own limit; of the rest press and notice half each, and
    whichever leaves places free is filled from the other's next rows.

    Ranks are made with one row limit per section that tasks apply before the shuffle.
    """
    w = Window.partitionBy("section").orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= limit)
    news = ranked.where("section = 'news'").where(F.col("_rank") <= news_limit)
    capacity = F.lit(limit) - F.col("_news")
    counted = ranked.where("section != 'news'").join(F.broadcast(news.agg(F.count("*").cast("int").alias("_news"))), F.lit(True))
    quota = F.when(F.col("section") == "press", F.floor((capacity + 1) / 2)).otherwise(F.floor(capacity / 2))
    flagged = counted.withColumn("_in", F.col("_rank") <= quota)
    fill = Window.partitionBy("_in").orderBy(*order)  # at most 2 * limit rows come here
    everything = Window.partitionBy(F.lit(1))
    filled = flagged.withColumns({"_extra": F.row_number().over(fill), "_chosen": F.count(F.when(F.col("_in"), 1)).over(everything)})
    official = filled.where(F.col("_in") | (F.col("_extra") <= capacity - F.col("_chosen"))).select(*rows.columns)
    return official.unionByName(news.select(*rows.columns)).orderBy(*order).limit(limit)


def page(rows: DataFrame, number: int, size: int, order: Sequence[Column]) -> DataFrame:
    """One page of the ordered rows; ``number`` is kept between 1 and the last page."""
    total = max(1, -(-rows.count() // size))
    return rows.orderBy(*order).offset((min(max(number, 1), total) - 1) * size).limit(size)


def ordered_distinct(rows: DataFrame, value: str, order: str) -> DataFrame:
    """Distinct values in the order of their first place."""
    return rows.groupBy(value).agg(F.min(order).alias(order)).orderBy(order)


def in_order(rows: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows with ``place``, from 0, among those of one ``by``."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long") - 1)


def in_lanes(rows: DataFrame, by: str, order: Sequence[Column], lanes: int) -> DataFrame:
    """The rows with ``lane``: those of one ``by`` are dealt to the lanes in turn."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1
    return rows.withColumn("lane", (place % lanes).cast("long"))


def page_numbers(current: Column, last: Column | int) -> Column:
    """Pages to show, in order: all of up to 7; else the first, the last, the current and its neighbours, with an ellipsis
    for each gap."""
    last = (last if isinstance(last, Column) else F.lit(last)).cast("long")
    near = F.filter(F.array(*(current.cast("long") + d for d in (-1, 0, 1))), lambda p: p.between(1, last))
    few = F.sequence(F.lit(1).cast("long"), F.greatest(last, F.lit(1)))
    shown = F.when(last <= 7, few).otherwise(F.array_sort(F.array_distinct(F.concat(F.array(F.lit(1).cast("long"), last), near))))
    words = F.transform(shown, lambda p, i: F.when((i > 0) & (p - F.get(shown, i - 1) > 1), F.concat(F.lit("… "), p.cast("string"))).otherwise(p.cast("string")))
    return F.array_join(words, " ")
