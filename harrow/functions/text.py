"""Titles, keywords, HTML and classification: Column -> Column."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The categories' words in the order of the rules, sections' names and the boards' numbers.
CATEGORIES = (
    ("유상경매", ("유상경매", "경매", "유상할당")),
    ("상쇄", ("상쇄", "외부사업")),
    ("시장안정", ("시장안정", "예비분")),
    ("할당계획", ("할당계획", "계획기간", "할당대상")),
)
OTHER_CATEGORY = "제도"
PRESS_WORD, NOTICE_WORDS = "보도자료", ("공지", "공고")
PRESS_URL = r"(?:menuId=(?:286|10598)|boardMasterId=(?:1|939))(?:&|$)"
GROUPS = {"news": "뉴스", "press": "기후부 보도자료", "notice": "기후부 공지사항"}


def unescape(text: Column) -> Column:
    """The text with its character references decoded."""

    @F.arrow_udf("string")
    def decode(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else html.unescape(t) for t in texts.to_pylist()], pa.string())

    return decode(text)


def strip_tags(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]+>", " "), r"(?U)\s+", " "))


def shortened(text: Column, limit: int) -> Column:
    return F.when(F.char_length(text) <= limit, text).otherwise(F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit("…")))


def clean_html(text: Column, limit: int = 260, *, entities: bool = True) -> Column:
    """Unescaped, without tags, blanks collapsed, cut with an ellipsis.  Python is called only where there is an ``&``."""
    raw = F.coalesce(text, F.lit(""))
    if entities:
        raw = F.when(raw.contains("&"), unescape(raw)).otherwise(raw)
    return shortened(strip_tags(raw), limit)


def html_attribute(tag: Column, name: str) -> Column:
    """A quoted attribute's value with its character references decoded; '' if there is none."""
    value = F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*(['\"])(.*?)\1", 2)
    return F.trim(F.when(value.contains("&"), unescape(value)).otherwise(value))


def normalized_title(title: Column) -> Column:
    """Lower case, without bracketed parts; only digits, a-z and Hangul syllables."""
    bare = F.regexp_replace(F.lower(F.coalesce(title, F.lit(""))), r"\[[^\]]+\]|\([^)]*\)", " ")
    return F.regexp_replace(bare, r"[^0-9a-z가-힣]+", "")


def all_bigrams(text: Column) -> Column:
    # One pass: in a lambda over the places, the text's own expression would be computed again for each of them.
    return F.coalesce(F.regexp_extract_all(text, F.lit(r"(?s)(?=(..))."), F.lit(1)), F.array().cast("array<string>"))


def bigrams(text: Column) -> Column:
    return F.array_distinct(all_bigrams(text))


def set_dice(a: Column, b: Column) -> Column:
    return 2.0 * F.size(F.array_intersect(a, b)) / F.greatest(F.size(a) + F.size(b), F.lit(1))


def multiset_dice(a: Column, b: Column) -> Column:
    """Dice of arrays of bigrams that counts repeats."""
    count = lambda x, g: F.size(F.filter(x, lambda y: y == g))
    both = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, g: s + F.least(count(a, g), count(b, g)))
    return 2.0 * both / F.greatest(F.size(a) + F.size(b), F.lit(1))


def contains_title(a: Column, b: Column) -> Column:
    """The shorter of two normalised titles, of 14 characters or more, stands in the other and makes 55 % of it."""
    la, lb = F.char_length(a), F.char_length(b)
    short, long = F.when(la <= lb, a).otherwise(b), F.when(la <= lb, b).otherwise(a)
    return (F.least(la, lb) >= 14) & F.contains(long, short) & (F.least(la, lb) / F.greatest(la, lb, F.lit(1)) >= 0.55)


def category(text: Column) -> Column:
    """The first rule of which a word occurs."""
    out = F.lit(OTHER_CATEGORY)
    for name, words in reversed(CATEGORIES):
        out = F.when(_any(text, words), name).otherwise(out)
    return out


def _any(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return found


def section(section: Column, source_type: Column, source: Column, url: Column) -> Column:
    explicit = F.lower(F.trim(F.coalesce(section, F.lit(""))))
    press = F.coalesce(source, F.lit("")).contains(PRESS_WORD) | F.coalesce(url, F.lit("")).rlike(PRESS_URL)
    return F.when((source_type == "news") | (section == "news"), "news").when(explicit.isin("press", "notice"), explicit).when(press, "press").otherwise("notice")


def group(section: Column, source_type: Column, source: Column, url: Column) -> Column:
    """The page's name of a document's group; documents of unknown kind are news there."""
    src = F.coalesce(source, F.lit(""))
    return (
        F.when((section == "news") | (source_type == "news"), GROUPS["news"])
        .when(section.isin("press", "notice"), F.when(section == "press", GROUPS["press"]).otherwise(GROUPS["notice"]))
        .when(src.contains(PRESS_WORD) | F.coalesce(url, F.lit("")).rlike(PRESS_URL), GROUPS["press"])
        .when(_any(src, NOTICE_WORDS) | (source_type == "official"), GROUPS["notice"])
        .otherwise(GROUPS["news"])
    )


def stable_id(url: Column, date: Column, title: Column) -> Column:
    return F.substring(F.sha1(F.coalesce(F.nullif(url, F.lit("")), F.concat_ws("|", date, title)).cast("binary")), 1, 16)


def without_session(url: Column) -> Column:
    return F.regexp_replace(url, r";jsessionid=[^?]+", "")


def without_outlet(title: Column) -> Column:
    """The title without a trailing `` - outlet``; whole, if nothing would be left."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(title, r"\s+-\s+[^-]+$", "")), F.lit("")), title)


def matched_keywords(text: Column, keywords: Sequence[str]) -> Column:
    """Which of the keywords the text holds, in any case, in the keywords' order."""
    low = F.lower(text)
    return F.filter(F.array(*(F.lit(k) for k in keywords)).cast("array<string>"), lambda k: F.contains(low, F.lower(k)))


def keyword_excerpt(text: Column, keywords: Column, limit: int = 260) -> Column:
    """``limit`` characters from 80 before the first of the keywords, with ellipses where text is left out."""
    low = F.lower(text)
    places = F.filter(F.transform(keywords, lambda k: F.instr(low, F.lower(k)) - 1), lambda p: p >= 0)
    start = F.greatest(F.lit(0), F.coalesce(F.array_min(places), F.lit(80)) - 80)
    cut = F.trim(F.substring(text, start + 1, F.lit(limit)))
    return F.concat(F.when(start > 0, "…").otherwise(""), cut, F.when(start + limit < F.char_length(text), "…").otherwise(""))


def escape_html(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(name))
    return out


def response_text(payload: Column) -> Column:
    """The joined texts of a model response's ``output[].content[]`` of type output_text."""
    kind = "struct<output:array<struct<content:array<struct<type:string,text:string>>>>>"
    parts = F.flatten(F.transform(F.from_json(payload, kind)["output"], lambda o: F.coalesce(o["content"], F.array().cast("array<struct<type:string,text:string>>"))))
    texts = F.filter(parts, lambda c: (c["type"] == "output_text") & (F.coalesce(c["text"], F.lit("")) != ""))
    return F.coalesce(F.trim(F.array_join(F.transform(texts, lambda c: c["text"]), " ")), F.lit(""))
