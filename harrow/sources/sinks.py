"""Writers of tables and of single documents."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.sources.documents import write_lines
from harrow.sources.readers import Settings


def write_quotes(quotes: DataFrame, path: str) -> None:
    """The quotes table in Parquet, by symbol; for export, ``write_quotes_csv``."""
    quotes.repartition("symbol").sortWithinPartitions("date").write.mode("overwrite").partitionBy("symbol").parquet(path)


def write_quotes_csv(quotes: DataFrame, path: str) -> None:
    """One CSV file in the order of date and symbol, with a byte order mark, of any size."""
    head = "\ufeff" + ",".join(quotes.columns) + "\n"
    write_lines(quotes, F.to_csv(F.struct(*quotes.columns)), [F.col("date"), F.col("symbol")], path, name="part-00000.csv", head=head.encode(), tail=b"\n" if not quotes.isEmpty() else b"")


def write_settings(spark: SparkSession, settings: Settings, path: str) -> None:
    """Collection settings as one JSON document, under the names by which they are read."""
    fields = {"policyKeywords": list(settings.keywords), "policyLookbackDays": settings.lookback_days, "maxPolicyItems": settings.limit, "maxNewsItems": settings.news_limit}
    spark.createDataFrame([(json.dumps(fields, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_document(items: DataFrame, path: str, order: list[Column], **fields: Column) -> None:
    """One JSON document of the fields and all items in order, of any size."""
    nulls = {"ignoreNullFields": "false"}
    envelope = items.sparkSession.range(1).select(F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())), nulls)).first()[0] if fields else "{}"
    head = envelope[:-1] + ("," if fields else "") + '"items":['
    write_lines(items, F.to_json(F.struct(*items.columns), nulls), order, path, name="part-00000.json", head=head.encode(), between=b",\n", tail=b"]}\n")
