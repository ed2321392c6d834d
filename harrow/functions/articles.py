"""Article text of raw HTML: the longest of what structured data, descriptions and article elements hold."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MOST, LEAST = 20_000, 40
#: What the class or id of an article's element holds; the blank stands for nothing, a blank, - or _.
BLOCK_NAMES = ("article body", "article content", "news body", "news content", "story body", "entry content", "post content", "board view", "board content", "bbs view", "view content", "view cont", "view txt")
SPELLINGS = tuple(name.replace(" ", joint) for name in BLOCK_NAMES for joint in ("", " ", "-", "_"))
BODY_KEY = re.compile(r'"articleBody"\s*:\s*', re.I)


class ArticleElements(HTMLParser):
    """Gathers, in one walk, descriptions and the text of article elements.

    ``article`` and ``main`` end at their own end tag, named ``div`` and ``section`` elements at the next end tag of
    either; what is never ended is left out.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.under_way: list[tuple[tuple[str, ...], list[str]]] = []  # which end tags end it, and its text

    def handle_starttag(self, tag, attrs):
        self.handle_data(" ")
        values = {k: v or "" for k, v in reversed(attrs)}
        if tag == "meta":
            if "description" in f"{values.get('property', '')} {values.get('name', '')}".lower():
                self.texts.append(values.get("content", ""))
        elif tag in ("article", "main"):
            self.under_way.append(((tag,), []))
        elif tag in ("div", "section"):
            named = f"{values.get('class', '')}\n{values.get('id', '')}".lower()
            if any(s in named for s in SPELLINGS):
                self.under_way.append((("div", "section"), []))

    def handle_endtag(self, tag):
        self.handle_data(" ")
        self.texts += ["".join(parts) for ends, parts in self.under_way if tag in ends]
        self.under_way = [x for x in self.under_way if tag not in x[0]]

    def handle_data(self, data):
        for _, parts in self.under_way:
            parts.append(data)


def structured_bodies(page: str) -> Iterator[str]:
    """The strings under articleBody in the page's JSON."""
    for m in BODY_KEY.finditer(page):
        try:
            body, _ = json.JSONDecoder().raw_decode(page, m.end())
        except ValueError:
            continue
        if isinstance(body, str):
            yield body


def plain(text: str) -> str:
    """Without tags, blanks collapsed, cut with an ellipsis."""
    line = " ".join(re.sub(r"<[^>]+>", " ", text).split())
    return line if len(line) <= MOST else line[: MOST - 1].rstrip() + "…"


def longest_candidate(page: str | None) -> str:
    """The longest candidate of 40 characters or more; '' without one."""
    walk = ArticleElements()
    walk.feed(page or "")
    walk.close()
    texts = [plain(t) for t in (*structured_bodies(page or ""), *walk.texts)]
    return max((t for t in texts if len(t) >= LEAST), key=len, default="")


def article_text(page: Column) -> Column:
    @F.arrow_udf("string")
    def longest(pages: pa.Array) -> pa.Array:
        return pa.array([longest_candidate(p) for p in pages.to_pylist()], pa.string())

    return longest(page)
