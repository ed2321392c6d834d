"""Dated briefings: normalised, replaced by date, split in overview and details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.operators.relational import replace_by

# Defaults and headings of briefings.
TITLE, TONE, SOURCE = "배출권 데일리 브리핑", "중립", "Telegram"
HEAD_LINE, MARKER = r"^(?i:KAU\s*)?배출권시장 일일 브리핑$", "상세 브리핑"
OUTLOOK, OUTLOOK_PATTERN = "향후 1주 판단", r"향후\s*1주\s*판단"
DETAILS = ("기간별 가격", "수급·가격 심층 분석", "정책 분석", "전력·연료 연계", "상방 요인 심층 분석", "하방 요인 심층 분석", "체크 이슈 포인트")


def normalize(payloads: DataFrame, *, required: bool = False) -> DataFrame:
    """Briefings from rows that may use any of the names for date, content and tone.

    Rows without date or content go; with ``required``, as where briefings are published, one such row fails the job.
    """
    have = set(payloads.columns)

    def first_of(*names: str, default: str = "") -> Column:
        return F.trim(F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names if n in have), F.lit(default)))

    out = payloads.select(
        first_of("date", "briefingDate").alias("date"), first_of("title", default=TITLE).alias("title"), first_of("summary").alias("summary"), first_of("content", "message").alias("content"),
        first_of("marketTone", "market_tone", default=TONE).alias("market_tone"), first_of("outlook").alias("outlook"), first_of("source", default=SOURCE).alias("source"),
    )
    complete = (F.col("date") != "") & (F.col("content") != "")
    if required:
        out = out.withColumn("date", F.when(complete, F.col("date")).otherwise(F.raise_error(F.lit("a briefing needs date and content")).cast("string")))
    return out.where(complete)


def publish(stored: DataFrame, new: DataFrame, most: int = 60) -> DataFrame:
    """Stored briefings with new ones in place of those of their dates; the newest ``most``."""
    return replace_by(stored, new, "date").orderBy(F.desc("date")).limit(most)


def readable(text: Column) -> Column:
    """Text of a briefing that may be HTML: breaks and block ends become line ends, tags go."""
    lines = F.regexp_replace(F.regexp_replace(text, r"(?i)<br\s*/?\s*>", "\n"), r"(?i)</(?:p|div|blockquote|li)>", "\n")
    plain = F.regexp_replace(F.regexp_replace(lines, r"<[^>]+>", ""), r"\n{3,}", "\n\n")
    return F.when(text.contains("<"), F.regexp_replace(plain, r"^\s+|\s+$", "")).otherwise(text)


def split(content: Column, outlook: Column, headings: tuple[str, ...] = DETAILS) -> tuple[Column, Column]:
    """(overview, details): cut before the first line that begins with a detail heading; the outlook ends the overview
    unless it is in it."""
    lines = F.split(F.replace(readable(F.coalesce(content, F.lit(""))), F.lit("\r\n"), F.lit("\n")), "\n")
    lines = F.when(F.trim(F.get(lines, F.lit(0))).rlike(HEAD_LINE), F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).otherwise(lines)
    lines = F.filter(lines, lambda x: F.trim(x) != MARKER)

    def heads(line: Column) -> Column:
        found = F.lit(False)
        for h in headings:
            found = found | F.trim(line).startswith(h)
        return found

    places = F.filter(F.transform(lines, lambda x, i: F.when(heads(x), i)), lambda i: i.isNotNull())
    at = F.coalesce(F.array_min(places), F.size(lines))
    strip = lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")
    overview = strip(F.array_join(F.slice(lines, 1, at), "\n"))
    details = strip(F.array_join(F.slice(lines, at + 1, F.size(lines)), "\n"))
    extra = F.concat(F.when(overview != "", "\n\n").otherwise(""), F.lit(OUTLOOK + "\n"), readable(outlook))
    add = (F.coalesce(outlook, F.lit("")) != "") & ~overview.rlike(OUTLOOK_PATTERN)
    return F.when(add, F.concat(overview, extra)).otherwise(overview), details
