"""Retention of stored documents as keywords change, by indexes: a keyword that is added or dropped touches its own documents.

Two tables in Parquet, in buckets of a hash, which reads are pruned by: which documents each n-gram stands in, and which
documents each keyword holds (``hits``: in title or summary, or as a stored match).  A new keyword's documents are among
those of its rarest n-gram, and are found by reading these alone; a dropped keyword's hits are left out.  Documents whose
last keyword goes are what is evicted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators.keywords import grams
from harrow.shared import new_path

GRAM, BUCKETS = 3, 64


def bucket(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(BUCKETS)).cast("int")


def low_text(title: str = "title", summary: str = "summary") -> Column:
    return F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit(""))))


class Index:
    """The indexes of one collection of documents (id, kind, title, summary, matched_keywords)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, rows: DataFrame, name: str, by: str) -> None:
        rows.withColumn("_bucket", bucket(F.col(by))).repartition("_bucket", F.xxhash64("id") % 8).write.mode("append").partitionBy("_bucket").parquet(f"{self.path}/{name}")

    def add(self, docs: DataFrame, keywords: dict[str, Sequence[str]]) -> None:
        """Takes new documents in; ``keywords`` are those allowed now, by the documents' kind."""
        text = docs.select("id", "kind", low_text().alias("low"), F.transform(F.coalesce("matched_keywords", F.array().cast("array<string>")), lambda k: F.lower(F.trim(k))).alias("matched"))
        self.write(text.select("id", F.explode(grams(F.col("low"), GRAM)).alias("gram")), "grams", "gram")
        self.write(text.select("id", "kind", F.explode("matched").alias("keyword")).distinct().withColumn("stored", F.lit(True)), "hits", "keyword")
        allowed = self.spark.createDataFrame([(kind, k.lower()) for kind, words in keywords.items() for k in words], "kind string, keyword string")
        found = text.join(F.broadcast(allowed), "kind").where(F.contains("low", "keyword")).select("id", "kind", "keyword").distinct()
        self.write(found.withColumn("stored", F.lit(False)), "hits", "keyword")

    def read(self, name: str, by: str, values: Sequence[str], schema: str) -> DataFrame:
        """Rows of some n-grams or keywords: of their buckets, no others are read."""
        wanted = self.spark.createDataFrame([(v,) for v in values], "v string")
        buckets = [r[0] for r in wanted.select(bucket(F.col("v")).alias("b")).distinct().collect()] if values else []
        rows = self.spark.read.schema(f"{schema}, _bucket int").parquet(f"{self.path}/{name}")
        return rows.where(F.col("_bucket").isin(buckets) & F.col(by).isin(list(values))).drop("_bucket")

    def candidates(self, keyword: str) -> DataFrame | None:
        """id of the documents with the keyword's rarest n-gram; None where it is too short to have one."""
        low = keyword.lower()
        names = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
        if not names:
            return None
        standing = self.read("grams", "gram", names, f"id {self.id_type()}, gram string")
        counts = {r["gram"]: r["n"] for r in standing.groupBy("gram").agg(F.count("*").alias("n")).collect()}
        return standing.where(F.col("gram") == min(names, key=lambda g: (counts.get(g, 0), g))).select("id")

    def id_type(self) -> str:
        return self.spark.read.parquet(f"{self.path}/grams").schema["id"].dataType.simpleString()

    def allow(self, docs: DataFrame, kind: str, keyword: str) -> None:
        """Looks a new keyword up and keeps its hits.  Of the documents, those of its rarest n-gram are compared."""
        near = self.candidates(keyword)
        some = docs.where(F.col("kind") == kind)
        some = some.join(near, "id", "left_semi") if near is not None else some
        low = keyword.lower()
        found = some.where(F.contains(low_text(), F.lit(low))).select("id", "kind", F.lit(low).alias("keyword"))
        self.write(found.withColumn("stored", F.lit(False)), "hits", "keyword")

    def hits(self, kind: str, keywords: Sequence[str]) -> DataFrame:
        low = sorted({k.lower() for k in keywords})
        return self.read("hits", "keyword", low, f"id {self.id_type()}, kind string, keyword string, stored boolean").where(F.col("kind") == kind)

    def retained(self, keywords: dict[str, Sequence[str]]) -> DataFrame:
        """id of the documents that the keywords allowed now keep."""
        parts = [self.hits(kind, words).select("id") for kind, words in keywords.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.distinct()

    def evicted(self, kind: str, dropped: Sequence[str], left: Sequence[str]) -> DataFrame:
        """id of the documents that the dropped keywords alone kept: read are the hits of both, not the documents."""
        return self.hits(kind, dropped).select("id").distinct().join(self.hits(kind, left).select("id"), "id", "left_anti")


def new_index(spark: SparkSession) -> Index:
    return Index(spark, new_path(spark, "retention"))
