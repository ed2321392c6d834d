"""Queries on sources: feeds, dates, keyword lines, scheduled upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.functions import parsing
from harrow.plans import proxies as P
from harrow.plans.catalog import query
from harrow.sources import readers


@query("""WITH t AS (SELECT event_id, ts, CASE event_id % 4 WHEN 0 THEN strftime(ts::DATE::TIMESTAMP + INTERVAL 20 HOUR, '%a, %-d %b %Y %H:%M:%S') || ' +0000' WHEN 1 THEN strftime(ts, '%Y.%-m.%-d') WHEN 2 THEN strftime(ts, '%Y%m%d') ELSE '-' END AS s FROM events)
  SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts::DATE + 1, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 2 THEN strftime(ts, '%Y-%m-%d') ELSE '2024-01-01' END AS date FROM t""")
def q_feed_date(spark, sf_dir):
    """Business days in Seoul of feed dates in several notations."""
    i, ts = F.col("event_id") % 4, F.col("ts")
    rfc = F.concat(F.date_format(ts, "EEE"), F.lit(", "), F.date_format(ts, "d MMM yyyy"), F.lit(" 20:00:00 +0000"))
    text = F.when(i == 0, rfc).when(i == 1, F.date_format(ts, "yyyy.M.d")).when(i == 2, F.date_format(ts, "yyyyMMdd")).otherwise("-")
    return P.table(spark, sf_dir, "events").select("event_id", parsing.feed_date(text, F.lit("2024-01-01")).alias("date"))


@query(f"""WITH {P.DOCUMENTS}, t AS (SELECT id, trim(regexp_replace(regexp_replace(replace(title, '|', ''), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS title, published_at AS d FROM docs)
  SELECT 'https://x.example/a?id=' || id || '&b=1' AS url, d AS published_at, CASE WHEN length(title) <= 180 THEN title ELSE rtrim(left(title, 179)) || '…' END AS title, left(sha1('https://x.example/a?id=' || id || '&b=1'), 16) AS id FROM t""")
def q_rss_items(spark, sf_dir):
    """Documents out of feeds whose links hold bare ampersands and session ids."""
    d = P.documents(spark, sf_dir)
    safe = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("|"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    item = F.concat(F.lit("<item><title>"), safe(given("title")), F.lit("</title><link>https://x.example/a;jsessionid=7F?id="), given("id"), F.lit("&b=1</link><dc:date>"), given("published_at"), F.lit("</dc:date><description>d</description></item>"))
    feed = F.concat(F.lit('<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>feed</title>'), F.array_join(F.collect_list("item"), ""), F.lit("</channel></rss>"))
    # A file holds the items of a hundred ids, so their number grows with the table and their size doesn't.
    files = d.select(F.coalesce(F.expr("id div 100"), F.xxhash64("text")), item.alias("item")).toDF("file", "item").groupBy("file").agg(feed.alias("xml"))
    docs = readers.feed_documents(readers.feed_items(files, "xml"), source="S", source_type="official", section="press", keyword="", as_of="2024-01-01")
    return docs.select("url", "published_at", "title", "id")


@query("""WITH l AS (SELECT turn, conv_id, trim(text) AS line FROM conversations), w AS (SELECT unnest(str_split_regex(line, '[,;\\t]')) AS word FROM l WHERE line <> '' AND NOT starts_with(line, '#'))
  SELECT trim(word) AS keyword FROM w WHERE trim(word) <> '' GROUP BY 1""")
def q_keyword_lines(spark, sf_dir):
    """Distinct keywords of text lines."""
    lines = P.table(spark, sf_dir, "conversations").select(F.trim("text").alias("value"), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"))
    return readers.keywords_of(lines).select("keyword")


@query("SELECT max(replace(o_orderdate::DATE::VARCHAR, '-', '')) AS day FROM orders")
def q_market_day(spark, sf_dir):
    """The latest day that is written in eight digits."""
    days = P.table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyyMMdd").alias("day"))
    return days.where(F.col("day").rlike(r"^\d{8}$")).agg(F.max("day").alias("day"))


@query(f"""WITH {P.QUOTES}, n AS (SELECT date::VARCHAR AS date, symbol, close, volume FROM quotes WHERE close <= 0) SELECT * FROM n UNION ALL SELECT '2026-08-19', 'KAU25', 29500.0::DOUBLE, 396644.0::DOUBLE WHERE NOT EXISTS (SELECT 1 FROM n)""")
def q_fallback_quote(spark, sf_dir):
    """The row that stands in where a table has no quotes that are asked for, here those without a price."""
    q = P.quotes(spark, sf_dir).where("close <= 0").select(F.col("date").cast("string").alias("date"), "symbol", "close", "volume")
    return readers.or_fallback(q)


@query(f"""WITH {P.QUOTES}, n AS (SELECT date::VARCHAR AS date, symbol, close, volume FROM quotes WHERE close > 0) SELECT * FROM n UNION ALL SELECT '2026-08-19', 'KAU25', 29500.0::DOUBLE, 396644.0::DOUBLE WHERE NOT EXISTS (SELECT 1 FROM n)""")
def q_quotes_or_fallback(spark, sf_dir):
    """Quotes with a price; the fallback row only if there were none."""
    q = P.quotes(spark, sf_dir).where("close > 0").select(F.col("date").cast("string").alias("date"), "symbol", "close", "volume")
    return readers.or_fallback(q)


def streamed(spark, sf_dir, part, parts: int):
    """The table that a stream of events makes by day and type; the events arrive in parts, after each of which it runs."""
    from harrow.shared import new_path
    from harrow.streaming import upserts

    root = new_path(spark, "stream")
    events = P.table(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), F.col("event_type").alias("symbol"), F.col("value").alias("close"), F.struct("ts", "event_id").alias("seq"), part.alias("part"))
    schema = events.drop("part").schema
    for n in range(parts):
        # Rows of a key are in one file, as files that have arrived since the last run have no order among them.
        events.where(F.col("part") == n).drop("part").repartition("date", "symbol").write.mode("append").parquet(f"{root}/arrived")
        rows = spark.readStream.schema(schema).parquet(f"{root}/arrived")
        upserts.upsert_stream(rows, f"{root}/table", f"{root}/checkpoint", keys=["date", "symbol"], order="seq").awaitTermination()
    return upserts.current(spark, f"{root}/table").drop("seq")


@query("SELECT ts::DATE AS date, event_type AS symbol, last(value ORDER BY ts, event_id) AS close FROM events GROUP BY ALL")
def q_stream_upsert(spark, sf_dir):
    """A stream of events, which arrive in the order of the day's hours, put into a table by day and type: the last value of
    each key."""
    return streamed(spark, sf_dir, F.expr("hour(ts) div 8"), 3)


@query("SELECT ts::DATE AS date, event_type AS symbol, last(value ORDER BY event_id % 3, ts, event_id) AS close FROM events GROUP BY ALL")
def q_stream_corrections(spark, sf_dir):
    """The same with events that arrive late: what arrives later wins, whatever its time."""
    return streamed(spark, sf_dir, F.col("event_id") % 3, 3)
