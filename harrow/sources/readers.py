"""Readers of quotes, auctions, documents, briefings, keywords and settings: text in, typed frames out."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow import schemas
from harrow.functions import parsing
from harrow.functions import text as X
from harrow.operators.quotes import valid_quotes
from harrow.operators.relational import last_wins


def header_of(spark: SparkSession, path: str) -> str:
    """The first line of a text file, without a byte order mark."""
    row = spark.read.text(path).where(F.trim("value") != "").first()
    return (row[0] if row else "").lstrip("﻿")


def renamed(rows: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns under their own names by the first alias that a header has; what no header has is ''."""
    have = {re.sub(r"[\s_()（）%·/.-]", "", c.lower()): c for c in reversed(rows.columns)}
    found = {n: next((have[k] for a in names if (k := re.sub(r"[\s_()（）%·/.-]", "", a.lower())) in have), None) for n, names in aliases.items()}
    return rows.select(*((F.coalesce(F.col(f"`{c}`"), F.lit("")) if c else F.lit("")).alias(n) for n, c in found.items()))


def first_given(*columns: str) -> Column:
    """The first of several columns that isn't empty; '' if all are."""
    return F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in columns), F.lit(""))


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    """Quotes of a CSV or tab-separated file with an English or Korean header; rows without a date or close are dropped.

    Columns are read as text and typed leniently.  The file is split among tasks as any CSV file.
    """
    tab = "\t" in header_of(spark, path)
    raw = spark.read.csv(path, header=True, sep="\t" if tab else ",", escape='"', ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    rows = renamed(raw, schemas.QUOTE_HEADERS)
    typed = rows.select("date", F.coalesce(F.nullif("symbol", F.lit("")), F.lit("KAU25")).alias("symbol"), *(parsing.ui_number(F.col(c)).alias(c) for c in rows.columns[2:]))
    return valid_quotes(typed)


def fallback_quotes(spark: SparkSession) -> DataFrame:
    """The one row that stands in where no quotes can be read."""
    return spark.createDataFrame([schemas.FALLBACK_QUOTE], "date string, symbol string, close double, change double, change_rate double, open double, high double, low double, volume double, trade_value double")


def or_fallback(quotes: DataFrame) -> DataFrame:
    """The quotes, or the fallback row where there are none."""
    fallback = fallback_quotes(quotes.sparkSession)
    named = fallback.select(*(F.col(f.name).cast(f.dataType) if f.name in fallback.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in quotes.schema))
    found = quotes.limit(1).select(F.lit(1).alias("_found"))
    return quotes.unionByName(named.withColumn("_found", F.lit(1)).join(found, "_found", "left_anti").drop("_found"))


def pasted_cells(lines: Sequence[str]) -> list[list[str]]:
    """Cells of pasted lines: split at tabs if any line has one, else at two blanks or more, else as CSV."""
    if any("\t" in x for x in lines):
        return [[c.strip() for c in x.split("\t")] for x in lines]
    if any(re.search(r"\s{2,}", x) for x in lines):
        return [re.split(r"\s{2,}", x.strip()) for x in lines]
    import csv

    return [[c.strip() for c in row] for row in csv.reader(lines)]


def read_pasted_quotes(spark: SparkSession, text: str) -> DataFrame:
    """Quotes pasted by an operator: a form's worth of lines, which fail as a whole on a bad date or close.

    The last of rows with one date and symbol wins.
    """
    cells = pasted_cells([x for x in text.lstrip("﻿").splitlines() if x.strip()])
    if not cells:
        raise ValueError("nothing was pasted")
    key = lambda x: re.sub(r"[\s_()（）%·/.-]", "", x.lower())
    known = {key(a): n for n, names in schemas.QUOTE_HEADERS.items() for a in names}
    first = [key(c) for c in cells[0]]
    has_header = any(c in known for c in first)
    names = [known.get(c, f"_{i}") for i, c in enumerate(first)] if has_header else list(schemas.QUOTE_HEADERS)[: len(first)]
    rows = cells[1:] if has_header else cells
    padded = [(i, *(r + [""] * len(names))[: len(names)]) for i, r in enumerate(rows, 2 if has_header else 1)]
    kind = T.StructType([T.StructField("line", T.IntegerType()), *(T.StructField(n, T.StringType()) for n in names)])
    raw = spark.createDataFrame(padded, kind)
    col = lambda n: F.col(n) if n in names else F.lit("")
    typed = raw.select("line", parsing.iso_date(col("date")).alias("date"), F.coalesce(F.nullif(F.trim(col("symbol")), F.lit("")), F.lit("KAU25")).alias("symbol"), *(parsing.pasted_number(col(n)).alias(n) for n in list(schemas.QUOTE_HEADERS)[2:]))
    bad = typed.where("date = '' or close = 0").orderBy("line").first()
    if bad:
        raise ValueError(f"line {bad['line']}: {'date' if bad['date'] == '' else 'close'} can't be read")
    return last_wins(typed, ["date", "symbol"], [F.col("line")]).drop("line")


def vendor_quotes(rows: DataFrame, day: str, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """A trading day's quotes from a vendor's text rows, by its column names."""
    first = lambda cs: F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in cs if c in rows.columns), F.lit(None).cast("string"))
    symbol = F.trim(first(names["symbol"])).alias("symbol")
    return rows.select(F.lit(day).cast("date").alias("date"), symbol, *(parsing.number(first(cs)).alias(n) for n, cs in names.items() if n != "symbol"))


def read_items(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The ``items`` of a JSON file that wraps them; a file that can't be parsed has none."""
    return spark.read.schema(schema).json(path, multiLine=True).select(F.inline("items"))


def read_auctions(spark: SparkSession, path: str) -> DataFrame:
    return read_items(spark, path, schemas.AUCTIONS_FILE)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return read_items(spark, path, schemas.DOCUMENTS_FILE)


def briefing_items(documents: DataFrame) -> DataFrame:
    """Briefings of JSON texts (``value``), each an object of items or the items alone."""
    whole = f"struct<updatedAt:string,items:array<struct<{','.join(c.replace(' ', ':') for c in schemas.BRIEFING.split(', ')).replace(' ', '')}>>>"
    alone = whole[whole.index("array<") : -1]
    items = F.when(F.ltrim("value").startswith("["), F.from_json("value", alone)).otherwise(F.from_json("value", whole)["items"])
    return documents.select(F.inline(items))


def read_briefings(spark: SparkSession, path: str) -> DataFrame:
    """Stored briefings: a file of items, or the items alone."""
    return briefing_items(spark.read.text(path, wholetext=True))


def keywords_of(lines: DataFrame) -> DataFrame:
    """keyword, seq: distinct keywords of text lines (value, seq), in order; # starts a comment line."""
    line = F.trim(F.replace("value", F.lit("﻿"), F.lit("")))
    words = lines.where((line != "") & ~line.startswith("#")).select("seq", F.posexplode(F.split(line, r"[,;\t]")).alias("pos", "word")).select(F.trim("word").alias("keyword"), F.struct("seq", "pos").alias("at"))
    return words.where("keyword != ''").groupBy("keyword").agg(F.min("at").alias("at")).select("keyword", (F.col("at.seq") * 10000 + F.col("at.pos")).alias("seq"))


def read_keywords(spark: SparkSession, path: str, root: str | None = None) -> list[str]:
    """The keywords of a small file, in order; for use as literals in filters.  With a ``root``, the path is one below it."""
    if root is not None:
        if path.startswith("/") or ".." in path.split("/") or "://" in path:
            raise ValueError(f"{path} is not below {root}")
        path = f"{root.rstrip('/')}/{path}"
    lines = spark.read.text(path).withColumn("seq", F.monotonically_increasing_id())
    return [r["keyword"] for r in keywords_of(lines).orderBy("seq").collect()]


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS files as text columns: title, description, link, pubDate, date, source.  Bare & in links is repaired."""
    files = spark.read.text(path, wholetext=True)
    return feed_items(files, "value")


def feed_items(files: DataFrame, xml: str) -> DataFrame:
    """The items in a column of feeds' XML.  Prefixes of namespaces are dropped and element names lower-cased."""
    repaired = F.regexp_replace(xml, r"&(?!amp;|lt;|gt;|quot;|apos;|#\d+;|#x[0-9a-fA-F]+;)(?=[^<]*</link>)", "&amp;")
    items = F.regexp_extract_all(repaired, F.lit(r"(?is)<item\b[^>]*>(.*?)</item>"), 1)

    def child(name: str) -> Column:
        raw = F.regexp_extract("item", rf"(?is)<(?:[\w.-]+:)?{name}\b[^>]*>(.*?)</(?:[\w.-]+:)?{name}\s*>", 1)
        return F.trim(X.unescape(F.regexp_replace(raw, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"))).alias(name)

    kept = ["keyword"] if "keyword" in files.columns else []
    return files.select(*kept, F.posexplode(items).alias("seq", "item")).select(*kept, "seq", *(child(n) for n in ("title", "description", "link", "pubDate", "date", "source")))


def feed_documents(items: DataFrame, *, source: str, source_type: str, section: str, keyword: str | Column, as_of: str) -> DataFrame:
    """Documents from a feed's items.  Items found by a keyword search (``keyword``: the same of all, or a column) are trusted."""
    words = F.lit(keyword) if isinstance(keyword, str) else F.coalesce(keyword, F.lit(""))
    title = X.clean_html(F.col("title"), 180)
    if source_type == "news":
        title = X.without_outlet(title)
    url, published = X.without_session(F.col("link")), parsing.feed_date(F.coalesce(F.nullif("pubDate", F.lit("")), F.col("date")), F.lit(as_of))
    rows = items.select("seq", words.alias("keyword"), url.alias("url"), published.alias("published_at"), title.alias("title"), X.clean_html(F.col("description"), 2000).alias("summary"), (F.coalesce(F.nullif("source", F.lit("")), F.lit(source)) if source_type == "news" else F.lit(source)).alias("source"))
    return rows.withColumns({
        "id": X.stable_id(F.col("url"), F.col("published_at"), F.col("title")),
        "category": X.category(F.lower(F.concat_ws(" ", "title", "summary"))),
        "source_type": F.lit(source_type), "section": F.lit(section), "trusted": F.col("keyword") != "",
    })


@dataclass(frozen=True)
class Settings:
    """Collection settings, clamped to what is allowed."""

    keywords: tuple[str, ...]
    lookback_days: int
    limit: int
    news_limit: int

    @classmethod
    def of(cls, raw: Mapping) -> Settings:
        clamp = lambda x, low, high: max(low, min(int(x), high))
        if not (words := tuple(dict.fromkeys(str(w).strip() for w in raw.get("policyKeywords", []) if str(w).strip()))):
            raise ValueError("settings have no keywords")
        limit = clamp(raw.get("maxPolicyItems", 60), 1, 200)
        return cls(words, clamp(raw.get("policyLookbackDays", 30), 1, 90), limit, clamp(raw.get("maxNewsItems", 24), 0, limit))


def read_settings(spark: SparkSession, path: str) -> Settings:
    return Settings.of(json.loads(spark.read.text(path, wholetext=True).first()[0]))
