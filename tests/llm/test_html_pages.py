"""Main text of pages: other languages, deep nesting, and a second extractor on the generated pages."""

import time
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest
from conftest import DATA
from harrow.llm.html_text import main_text

PARAGRAPHS = {
    "Russian": "Это длинный абзац о погоде и природе, который никто не отмечает. " * 8,
    "Greek": "Αυτή είναι μια μεγάλη παράγραφος για τον καιρό και τη φύση. " * 8,
    "Arabic": "هذا نص طويل عن الطقس والطبيعة في هذه البلاد. " * 8,
    "Hindi": "यह मौसम और प्रकृति के बारे में एक लंबा अनुच्छेद है। " * 8,
    "Japanese": "今日は天気がとても良いので公園へ散歩に行きました。" * 8,
    "Finnish": "Sää oli eilen kaunis ja lähdimme kävelylle järven rannalle. " * 8,
}


@pytest.mark.parametrize("language", PARAGRAPHS)
def test_no_language_is_lost(language):
    text = PARAGRAPHS[language].strip()
    page = f"<html><body><nav><a href='/'>{text[:20]}</a></nav><div><h1>{text[:15]}</h1><p>{text}</p></div><div class='footer'>{text}</div></body></html>"
    assert main_text(page) == f"{text[:15].strip()}\n\n{text}"


def test_a_foreign_paragraph_in_a_known_language():
    english = "This is a long paragraph about the weather that we had in the last days of the year and what it was like. " * 3
    russian = PARAGRAPHS["Russian"].strip()
    assert main_text(f"<body><p>{english}</p><p>{russian}</p><p>{english}</p></body>") == f"{english.strip()}\n\n{russian}\n\n{english.strip()}"


@pytest.mark.parametrize("page", ["<b>" * 200_000 + "x", "<b>" * 100_000 + "</i>" * 100_000, "<b>" * 50_000 + "<p>x</p>" * 50_000, "<div>" * 100_000 + "</div>" * 100_000, "<p>" * 100_000, "<a '" * 50_000, "<!--" * 50_000])
def test_time_is_linear_in_tags(page):
    started = time.process_time()
    main_text(page)
    assert time.process_time() - started < 5  # minutes, when quadratic


def test_a_very_long_page():
    words = "the weather of the day was as good as it can be " * 100_000
    assert main_text(f"<article><p>{words}</p></article>") == words.strip()


class Plain(HTMLParser):
    """The article's paragraphs and headings, as the generator of the pages writes them."""

    OUT = {"nav", "footer", "aside", "form", "header", "script", "style", "head"}
    ENDS = {"p", "h1", "h2", "h3", "div", "li", "ul", "ol", "section", "article", "blockquote", "table", "tr", "td", "pre", "figure", "figcaption"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.now, self.out, self.inside = [], "", [], 0

    def end(self):
        if text := " ".join(self.now.split()):
            self.blocks.append(text)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag in self.ENDS:
            self.end()
        if tag == "article":
            self.inside += 1
        if self.out and tag == self.out[-1]:
            self.out.append(tag)
        elif not self.out and (tag in self.OUT or any(k == "class" and v and set(v.split()) & {"ad", "comments", "comment", "sidebar", "share", "newsletter", "cookie", "notice", "related", "promo"} for k, v in attrs)):
            self.end()
            self.out.append(tag)
        if tag == "br":
            self.now += " "

    def handle_endtag(self, tag):
        if tag in self.ENDS:
            self.end()
        if tag == "article":
            self.inside -= 1
        if self.out and tag == self.out[-1]:
            self.out.pop()
            self.now = ""

    def handle_data(self, data):
        if self.inside and not self.out:
            self.now += data


def test_generated_pages_against_a_second_extractor():
    pages = [p for p in pq.read_table(f"{DATA}/sf0.01/pages.parquet").column("html").to_pylist() if p and "<article" in p]
    wrong = []
    for p in pages:
        plain = Plain()
        plain.feed(p)
        plain.end()
        if "\n\n".join(plain.blocks) != main_text(p):
            wrong.append(p)
    assert len(pages) > 100 and not wrong
