"""Keywords from a table, matched in texts as substrings in any case; every match is kept.

Keywords of up to ``LARGEST`` characters together go to all tasks, as one automaton that reads a text once, however many
keywords there are.  More than that are joined: each keyword is looked for where its rarest n-gram stands, and found there
by comparison.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.shared import checkpoint

#: Characters of keywords that go to all tasks at most (an automaton takes some 100 bytes for each), and of an n-gram.
LARGEST, GRAM = 2_000_000, 4

_LAST: list = [None, None]  # the keywords that a worker has last made an automaton of, and that


def automaton(words: Broadcast):
    """The automaton of the keywords, made once by a worker; the last one alone is kept."""
    if _LAST[0] is not words.value:
        import ahocorasick

        made = ahocorasick.Automaton()
        for place, word in enumerate(words.value):
            made.add_word(word, place)
        made.make_automaton()
        _LAST[:] = words.value, made
    return _LAST[1]


def places_column(low: Column, words: Broadcast) -> Column:
    """array<int>: places, in order, of the keywords that a lower-case text holds."""

    @F.arrow_udf("array<int>")
    def places(texts: pa.Array) -> pa.Array:
        found = automaton(words)
        return pa.array([sorted({place for _, place in found.iter(t)}) if t else [] for t in texts.to_pylist()], pa.list_(pa.int32()))

    return places(low)


def table_matches(docs: DataFrame, text: Column, keywords: DataFrame, *, largest: int = LARGEST) -> DataFrame:
    """The documents with ``matched_keywords``: all keywords that the text holds, in the order of their ``place``.

    ``keywords``: keyword, place.  Of keywords that differ in case alone the first counts; empty ones and nulls don't.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    named = keywords.where("keyword != ''").groupBy(F.lower("keyword").alias("_low")).agg(F.min_by("keyword", "place").alias("keyword"), F.min("place").alias("place"))
    listed = checkpoint(named)
    total = listed.agg(F.coalesce(F.sum(F.char_length("_low")), F.lit(0))).first()[0]
    if total <= largest:
        rows = listed.orderBy("place", "_low").collect()
        if not rows:
            return docs.withColumn("matched_keywords", F.array().cast("array<string>"))
        words = docs.sparkSession.sparkContext.broadcast([r["_low"] for r in rows])
        shown = docs.sparkSession.sparkContext.broadcast([r["keyword"] for r in rows])

        @F.arrow_udf("array<string>")
        def spelled(places: pa.Array) -> pa.Array:
            return pa.array([[shown.value[p] for p in row] for row in places.to_pylist()], pa.list_(pa.string()))

        return docs.withColumn("matched_keywords", spelled(places_column(low, words)))
    return joined_matches(docs, low, listed)


def grams(text: Column, size: int) -> Column:
    """Distinct n-grams of a text; none of a text that is shorter."""
    starts = F.when(F.char_length(text) >= size, F.sequence(F.lit(1), F.char_length(text) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(size))))


def joined_matches(docs: DataFrame, low: Column, listed: DataFrame) -> DataFrame:
    """As ``table_matches``, for any number of keywords: a join by rarest n-grams, and comparison."""
    if listed.isEmpty():
        return docs.withColumn("matched_keywords", F.array().cast("array<string>"))
    rows = checkpoint(docs.select(F.monotonically_increasing_id().alias("_row"), low.alias("_text"), F.struct(*docs.columns).alias("_doc")))
    sizes = sorted(r[0] for r in listed.select(F.least(F.char_length("_low"), F.lit(GRAM))).distinct().collect())  # 1 to GRAM
    of_text = F.flatten(F.array(*(grams(F.col("_text"), n) for n in sizes)))
    of_word = F.flatten(F.array(*(F.when(F.least(F.char_length("_low"), F.lit(GRAM)) == n, grams(F.col("_low"), n)).otherwise(F.array().cast("array<string>")) for n in sizes)))
    needed = listed.select("_low", F.explode(of_word).alias("gram"))
    standing = checkpoint(rows.select("_row", F.explode(of_text).alias("gram")).join(needed.select("gram").distinct(), "gram", "left_semi"))
    counts = standing.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = needed.join(counts, "gram", "left").groupBy("_low").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    candidates = standing.join(rarest, "gram").select("_row", "_low")
    hits = candidates.join(rows.select("_row", "_text"), "_row").where(F.contains("_text", "_low")).select("_row", "_low")
    found = hits.join(listed, "_low").groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("place", "_low", "keyword"))).alias("_hits"))
    matched = F.coalesce(F.transform("_hits", lambda h: h["keyword"]), F.array().cast("array<string>"))
    return rows.drop("_text").join(found, "_row", "left").select("_doc.*", matched.alias("matched_keywords"))
