"""Documents gathered from feeds: a search for each keyword, merged; the whole feed where searches find nothing; news."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators.documents import match_keywords, merge_keywords
from harrow.shared import new_path
from harrow.sources.http import register
from harrow.sources.readers import feed_documents, feed_items


def answers(spark: SparkSession, url: str, keywords: Sequence[str], **options: str) -> DataFrame:
    """keyword, xml, error of each request, made once and kept in the shared folder: plans that are run again, or tasks of
    lost executors, ask no server twice."""
    register(spark)
    path = new_path(spark, "feeds")
    spark.read.format("harrow_feed").options(url=url, keywords=json.dumps(list(keywords)), **options).load().write.parquet(path)
    return spark.read.schema("keyword string, xml string, error string").parquet(path)


def warning_of(feeds: DataFrame) -> str | None:
    """What went wrong, by keyword; for a handful of requests."""
    failed = [f"{r['keyword'] or 'feed'}: {r['error']}" for r in feeds.where("error is not null").select("keyword", "error").orderBy("keyword").collect()]
    return " | ".join(failed) or None


def collect_feed(spark: SparkSession, url: str, keywords: Sequence[str], *, source: str, source_type: str = "official", section: str = "press", as_of: str, most: int = 60, **options: str) -> tuple[DataFrame, str | None]:
    """Documents that searches of a feed find, newest first, and a warning.

    Each keyword is a request of its own, with the limit in it.  Hits of several keywords are one document with all of
    them.  Where no search finds anything, the whole feed is read and its documents matched here.
    """
    place = F.array_position(F.array(*(F.lit(k) for k in keywords)), F.col("keyword"))

    def documents(feeds: DataFrame) -> DataFrame:
        items = feed_items(feeds.where("xml is not null"), "xml")
        return feed_documents(items, source=source, source_type=source_type, section=section, keyword=F.col("keyword"), as_of=as_of)

    feeds = answers(spark, url, keywords, most=str(most), **options)
    warning, found = warning_of(feeds), documents(feeds)
    if found.isEmpty():
        whole = answers(spark, url, [], **options)
        warning = " | ".join(filter(None, [warning, warning_of(whole)])) or None
        rows = documents(whole).drop("keyword", "seq").withColumn("matched_keywords", F.array().cast("array<string>"))
        found = match_keywords(rows, keywords)
    else:
        found = merge_keywords(found.withColumn("seq", place * 1_000_000 + F.col("seq"))).drop("merge_key")
    return found.orderBy(F.desc("published_at"), F.desc("title"), F.desc("id")), warning


def collect_news(spark: SparkSession, url: str, keywords: Sequence[str], *, days: int, as_of: str, most: int = 80, **options: str) -> tuple[DataFrame, str | None]:
    """The first ``most`` news of a search for any of the keywords in the last days; all are trusted."""
    feeds = answers(spark, url, keywords, search="news", days=str(days), **options)
    items = feed_items(feeds.where("xml is not null").select("xml"), "xml").orderBy("seq").limit(most)
    rows = feed_documents(items, source="", source_type="news", section="news", keyword="", as_of=as_of).withColumn("trusted", F.lit(True))
    return rows.drop("keyword", "seq"), warning_of(feeds)
