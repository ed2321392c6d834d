"""Market and document tables made of the star schema's tables, in Spark and as DuckDB common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYWORDS = ("the", "la", "der", "que", "tion")
NEWS_KEYWORDS = ("and", "des", "und", "los")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by day and priority as daily quotes."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("symbol")).agg(
        F.max_by("o_totalprice", "o_orderkey").alias("close"), F.min_by("o_totalprice", "o_orderkey").alias("open"), F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low"),
        F.count("*").cast("double").alias("volume"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("trade_value"),
    )


QUOTES = """quotes AS (SELECT o_orderdate::DATE AS date, o_orderpriority AS symbol, arg_max(o_totalprice, o_orderkey) AS close,
  arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low, count(*)::DOUBLE AS volume,
  sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS trade_value FROM orders GROUP BY ALL)"""


def short_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and type as a short series of quotes, with the change to the previous close."""
    e = table(spark, sf_dir, "events")
    at = F.struct("ts", "event_id")
    return e.groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("symbol")).agg(
        F.max_by("value", at).alias("close"), F.min_by("value", at).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
        F.count("*").cast("double").alias("volume"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("trade_value"),
    )


SHORT_QUOTES = """short_quotes AS (SELECT ts::DATE AS date, event_type AS symbol, last(value ORDER BY ts, event_id) AS close,
  first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low, count(*)::DOUBLE AS volume,
  sum(value::DECIMAL(18,2))::DOUBLE AS trade_value FROM events GROUP BY ALL)"""


def with_rate(q: DataFrame) -> DataFrame:
    """Quotes with change and change_rate against the previous close."""
    from harrow.operators.quotes import daily_change

    none = F.lit(None).cast("double")
    return daily_change(q.withColumns({"vendor_change": none, "vendor_rate": none}), vendor_first=True).drop("vendor_change", "vendor_rate")


def rated(source: str) -> str:
    return f"""rated AS (SELECT *, coalesce(floor((close - p) * 10000 + 0.5) / 10000, 0.0) AS change,
  coalesce(floor(((close / nullif(p, 0) - 1) * 100) * 10000 + 0.5) / 10000, 0.0) AS change_rate
  FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS p FROM {source}))"""


def auctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of orders by shipping day and priority, on second Wednesdays, as auctions."""
    line = table(spark, sf_dir, "lineitem").where((F.dayofweek("l_shipdate") == 4) & F.dayofmonth("l_shipdate").between(8, 14))
    joined = line.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    won = F.col("l_returnflag") != "R"
    qty, price = F.col("l_quantity").cast("decimal(18,2)"), F.col("l_extendedprice").cast("decimal(18,2)")
    total = joined.groupBy(F.to_date("l_shipdate").alias("date"), F.col("o_orderpriority").alias("symbol")).agg(
        F.sum(qty).cast("double").alias("offered_quantity"), F.coalesce(F.sum(F.when(won, qty)), F.lit(0)).cast("double").alias("awarded_quantity"),
        F.count_distinct("l_suppkey").cast("double").alias("bidder_count"), F.count_distinct(F.when(won, F.col("l_suppkey"))).cast("double").alias("winner_count"),
        F.max("l_extendedprice").alias("highest_bid"), F.min("l_extendedprice").alias("lowest_bid"), F.sum(price).cast("double").alias("_paid"),
    )
    demand = F.col("offered_quantity") + F.col("awarded_quantity")
    return total.withColumns({"bid_quantity": demand, "bid_ratio": F.floor(demand / F.col("offered_quantity") * 100).cast("double"), "clearing_price": F.when(F.col("winner_count") > 0, F.floor(F.col("_paid") / F.col("bidder_count"))).otherwise(0).cast("double")}).drop("_paid")


AUCTIONS = """auctions AS (SELECT *, offered_quantity + awarded_quantity AS bid_quantity,
  floor((offered_quantity + awarded_quantity) / offered_quantity * 100) AS bid_ratio,
  CASE WHEN winner_count > 0 THEN floor(paid / bidder_count) ELSE 0 END::DOUBLE AS clearing_price FROM
  (SELECT l_shipdate::DATE AS date, o_orderpriority AS symbol, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS offered_quantity,
  coalesce(sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity::DECIMAL(18,2) END), 0)::DOUBLE AS awarded_quantity,
  count(DISTINCT l_suppkey)::DOUBLE AS bidder_count, count(DISTINCT CASE WHEN l_returnflag <> 'R' THEN l_suppkey END)::DOUBLE AS winner_count,
  max(l_extendedprice) AS highest_bid, min(l_extendedprice) AS lowest_bid, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS paid
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE dayofweek(l_shipdate) = 3 AND day(l_shipdate) BETWEEN 8 AND 14 GROUP BY ALL))"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as official notices (English) and news (other languages)."""
    d = table(spark, sf_dir, "documents")
    official = F.col("lang") == "en"
    return d.select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("seq"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")), "yyyy-MM-dd").alias("published_at"),
        F.substring(F.substring_index("text", "\n", 1), 1, 180).alias("title"), F.substring("text", 1, 2000).alias("summary"), "source", F.when(official, "official").otherwise("news").alias("source_type"),
        F.when(~official, "news").when(F.col("doc_id") % 2 == 0, "press").otherwise("notice").alias("section"), F.concat(F.lit("https://"), "source", F.lit(".example/"), (F.col("doc_id") % 700).cast("string")).alias("url"), "text",
    )


DOCUMENTS = """docs AS (SELECT doc_id AS id, doc_id AS seq, strftime(DATE '2024-01-01' + (doc_id % 30)::INT, '%Y-%m-%d') AS published_at,
  left(split_part(text, chr(10), 1), 180) AS title, left(text, 2000) AS summary, source, CASE WHEN lang = 'en' THEN 'official' ELSE 'news' END AS source_type,
  CASE WHEN lang <> 'en' THEN 'news' WHEN doc_id % 2 = 0 THEN 'press' ELSE 'notice' END AS section,
  'https://' || source || '.example/' || (doc_id % 700) AS url, text FROM documents)"""


def briefings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as briefings: the last assistant text as content, the last user text as outlook."""
    c = table(spark, sf_dir, "conversations")
    last = lambda role: F.expr(f"max_by(text, struct(turn, text)) FILTER (WHERE role = '{role}')")
    rows = c.groupBy("conv_id").agg(last("assistant").alias("message"), last("user").alias("outlook"))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("conv_id").cast("int")), "yyyy-MM-dd")
    return rows.select(day.alias("briefingDate"), F.concat(F.lit("  B "), F.col("conv_id").cast("string")).alias("title"), "message", "outlook", F.when(F.col("conv_id") % 3 == 0, "up").otherwise("").alias("market_tone"))


BRIEFINGS = """raw_briefings AS (SELECT strftime(DATE '2024-01-01' + conv_id::INT, '%Y-%m-%d') AS date, '  B ' || conv_id AS title,
  last(text ORDER BY turn, text) FILTER (WHERE role = 'assistant') AS message, last(text ORDER BY turn, text) FILTER (WHERE role = 'user') AS outlook,
  CASE WHEN conv_id % 3 = 0 THEN 'up' ELSE '' END AS market_tone FROM conversations GROUP BY conv_id)"""
