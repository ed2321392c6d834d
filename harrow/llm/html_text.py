"""Operator 1: main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass labels each block on its own: blocks in containers that
are boilerplate by tag or role, blocks made of links and copyright lines are bad; long blocks rich in stop words are good;
all else is undecided, as short blocks carry too little evidence.  The second pass gives each undecided block the label of
its nearest decided neighbours.  When the page marks articles, only their blocks take part, and undecided ones among them
are good unless bad neighbours enclose them.  A block of links inside an article is undecided too, but only good ones on
both sides make it good.

Words in a container's class or id, and a form, only make it suspect.  A suspect that holds an article (comments and
teasers aside), or most of the text that it stands among (the page's, or its article's), is a wrapper, and its blocks are
judged like all others; any other suspect is boilerplate.  Of a page's articles those count that hold a long block or as
much as a fifth of the longest's text.

The stop words are of four languages.  A page whose text hardly holds any is in another one: its blocks are judged by
length and by links alone, and no block of any page is bad for its lack of stop words, it is only undecided.
Ideographs, kana and Hangul syllables count as three letters each, as they say about as much.

Pages are read in time linear in their length, however deep their elements are nested.

Defined results: a null or empty page, or one without article blocks, has the empty text.  Unclosed tags, comments and
scripts end with the page.  Pages are independent of each other, so repeated rows, ties and empty tables need no rule;
an input column named like an output column is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STOP_WORDS = frozenset(
    # English
    "a an and are as at be been but by can did do for from had has have he her his i if in is it its me my no not of on or our she so that the their them there they this to us was we were what when which who will with would you your "
    # German
    "aber als am auch auf aus bei bin bis da das dass dem den der des die du durch ein eine einem einen einer er es für hat ich ihr im in ist mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war wie wir zu zum zur "
    # French
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas plus pour qu que qui sa se ses son sur un une vous "
    # Spanish
    "al como con de del el ella en era es esta este fue ha hay la las lo los más me mi no o para pero por que se si sin sobre su sus también un una y ya".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math noembed noframes xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SKIPPED = frozenset("nav footer aside head menu dialog select button label object audio video canvas search dir".split())
#: Start tags that end an open paragraph, or an open element of their own kind.
ENDS_OWN_KIND = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo promos promoted promotion sidebar sidebars sidenav nav navbar navigation menu menus submenu breadcrumb breadcrumbs footer "
    "cookie cookies consent gdpr notice notices notification notifications popup modal overlay newsletter subscribe subscription signup signin login register share sharing sharebar social related recommended recommendations "
    "comment comments commentlist discussion disqus respond reply replies responses pagination pager paging toolbar skip skiplink hidden copyright legal disclaimer alert toast trending popular teaser teasers widget widgets paywall".split()
)
#: What articles are called that aren't the page's own.
SMALL_ARTICLES = frozenset("comment comments reply replies respond response responses teaser teasers promo related recommended sponsored advert ad widget".split())
#: Bad outside an article only: inside one they mark its own title.
PAGE_HEADS = frozenset("header masthead topbar".split())
SHORT, LONG, LINKED, RICH = 70, 200, 0.33, 0.30
MOST, BESIDE = 0.6, 0.2  # shares of the text around: of a wrapper, and of the longest article's for one beside it
KNOWN = 0.08  # share of stop words from which on a page is in one of their languages
DENSE = re.compile(r"[\u1100-\u11ff\u2e80-\u9fff\uac00-\ud7ff\uf900-\ufaff\U00020000-\U0003ffff]")

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z/][^<>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
NOT_LETTERS = re.compile(r"^[\W\d_]+|[\W\d_]+$")


@dataclass(slots=True)
class Element:
    tag: str
    bad: bool
    article: int  # number of the enclosing article, 0 outside
    link: bool
    suspect: int = 0  # number of the innermost suspect container, 0 outside


@dataclass(slots=True)
class Block:
    bad: bool
    article: int
    heading: bool
    suspect: int = 0
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    label: str = ""


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): unescape((v or "").strip("\"'")) for k, v in ATTRIBUTE.findall(raw)} if raw.strip(" /\t\n\r") else {}


@dataclass(slots=True)
class Suspect:
    """A container that its words make suspect: what it stands in, and what tells whether it is a wrapper."""

    outer: int  # the suspect around it, 0 for none
    article: int  # the article that it stands in, 0 for none
    small: bool  # whether its words say that articles in it aren't the page's own
    holds_article: bool = False
    text: int = 0


def is_boilerplate(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """By tag, role or because it isn't shown."""
    if tag in SKIPPED or tag == "header" and not in_article:
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    return attrs.get("role", "").lower() in BAD_ROLES


def looks_like_comment(attrs: dict[str, str]) -> bool:
    """An article by its tag that its words call a reader's comment, or a teaser of another one."""
    return bool({w.lower() for k in ("class", "id") for w in WORD_PARTS.findall(attrs.get(k, ""))} & SMALL_ARTICLES)


def is_suspect(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """By words of its class and id; a form always."""
    if tag == "form":
        return True
    if not attrs or tag in ("html", "body", "main"):
        return False
    words = {w.lower() for k in ("class", "id") for w in WORD_PARTS.findall(attrs.get(k, ""))}
    return bool(words & BAD_WORDS) or not in_article and tag not in HEADINGS and bool(words & PAGE_HEADS)


def blocks(html: str) -> list[Block]:
    """The page's blocks with text, in page order; those in suspect containers that are no wrappers are bad."""
    found: list[Block] = []
    suspects: list[Suspect] = [Suspect(0, 0, False)]
    stack: list[Element] = []
    open_tags: Counter[str] = Counter()  # of the stack's elements
    block_at: list[int] = []  # where block elements are in the stack
    now = Block(False, 0, False)
    articles = at = 0

    def pop() -> Element:
        e = stack.pop()
        open_tags[e.tag] -= 1
        if block_at and block_at[-1] == len(stack):
            block_at.pop()
        return e

    def add(raw: str) -> None:
        if raw:
            now.parts.append(text := unescape(raw) if "&" in raw else raw)
            if stack and stack[-1].link:
                now.linked += len(text.strip())

    def begin() -> None:
        nonlocal now
        if now.parts and (text := " ".join("".join(now.parts).split())):
            now.text = text
            found.append(now)
        top = stack[-1] if stack else Element("", False, 0, False)
        now = Block(top.bad, top.article, any(e.tag in HEADINGS for e in stack[-3:]), top.suspect)

    while (m := TOKEN.search(html, at)) is not None:
        add(html[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # an end tag
            if open_tags[tag]:
                held = len(block_at)
                while (e := pop()).tag != tag:
                    pass
                if len(block_at) < held or stack and (stack[-1].bad != e.bad or stack[-1].suspect != e.suspect):
                    begin()
            continue
        if tag in VOID:
            if tag == "hr":
                begin()
            elif tag == "br":
                now.parts.append(" ")
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in BLOCKS and block_at and ((over := stack[block_at[-1]].tag) == "p" or over == tag and tag in ENDS_OWN_KIND):
            for _ in range(len(stack) - block_at[-1]):
                pop()
        top = stack[-1] if stack else Element("", False, 0, False)
        article = top.article
        if tag in ("article", "main") and not article:
            articles += 1
            article = articles
        given, suspect = attributes(m[3]), top.suspect
        bad = top.bad or is_boilerplate(tag, given, bool(top.article))
        if article != top.article and not looks_like_comment(given):
            held_in = suspect
            while held_in and not suspects[held_in].small and not suspects[held_in].holds_article:
                suspects[held_in].holds_article = True
                held_in = suspects[held_in].outer
        if not bad and is_suspect(tag, given, bool(top.article)):
            small = looks_like_comment(given)
            suspects.append(Suspect(suspect, top.article, small, holds_article=tag == "article" and not small))
            suspect = len(suspects) - 1
        if tag in BLOCKS:
            block_at.append(len(stack))
        open_tags[tag] += 1
        stack.append(Element(tag, bad, article, top.link or tag == "a", suspect))
        if tag in BLOCKS or bad != top.bad or suspect != top.suspect:
            begin()
    add(html[at:])
    stack.clear()
    begin()
    settle(found, suspects)
    return found


def settle(found: list[Block], suspects: list[Suspect]) -> None:
    """Makes bad what stands in a suspect container that is no wrapper.

    A suspect is weighed against the text that it stands among, without that of suspects beside it that hold less: outer
    ones first, in linear time.
    """
    whole: dict[int, int] = {}
    for b in found:
        if not b.bad:
            plain = max(0, len(b.text) - b.linked)
            whole[b.article] = whole.get(b.article, 0) + plain
            if b.article:
                whole[0] = whole.get(0, 0) + plain
            suspects[b.suspect].text += plain
    for n in range(len(suspects) - 1, 0, -1):  # inner ones have higher numbers
        suspects[suspects[n].outer].text += suspects[n].text
    stays = [True] * len(suspects)
    for n, s in enumerate(suspects):
        if n:
            stays[n] = stays[s.outer] and (s.holds_article or s.text > MOST * whole.get(s.article, 0))
    for b in found:
        b.bad = b.bad or not stays[b.suspect]


def stop_words(text: str) -> tuple[int, int]:
    """How many of a text's words are stop words, and how many words it has."""
    words = text.split()
    return sum(w.lower() in STOP_WORDS or NOT_LETTERS.sub("", w).lower() in STOP_WORDS for w in words), len(words)


def first_pass(block: Block, counts: tuple[int, int], scoped: bool, known: bool) -> str:
    """good, bad, or undecided: near (leans to good) and short.  ``known``: the page's language has listed stop words."""
    text = block.text
    if len(text) < LONG and text.startswith(("©", "Copyright ", "(c) ")):
        return "bad"
    if block.linked > LINKED * len(text):
        return "links" if scoped else "bad"
    size = len(text) + 2 * len(DENSE.findall(text))
    if block.heading or size < SHORT:
        return "short"
    if not known:
        return "good" if size > LONG else "near"
    n, words = counts
    if n >= RICH * words:
        return "good" if size > LONG else "near"
    return "near" if scoped or n >= RICH / 2 * words else "short"


def second_pass(labels: list[str], headings: list[bool], scoped: bool) -> list[bool]:
    """Which blocks are good, once each undecided one has the label of its nearest decided neighbours; a heading takes
    that of what follows it."""
    out = []
    before: list[tuple[int, str]] = []
    last = (-1, "")
    for i, x in enumerate(labels):
        before.append(last)
        if x in ("good", "bad"):
            last = (i, x)
    after: list[tuple[int, str]] = [(-1, "")] * len(labels)
    last = (-1, "")
    for i in range(len(labels) - 1, -1, -1):
        after[i] = last
        if labels[i] in ("good", "bad"):
            last = (i, labels[i])
    for i, x in enumerate(labels):
        if x in ("good", "bad"):
            out.append(x == "good")
            continue
        (a, left), (b, right) = before[i], after[i]
        if x == "links":
            out.append(left == right == "good")
            continue
        if headings[i]:
            near = right or left
        elif left == right or not left or not right:
            near = left or right
        elif i - a != b - i:
            near = left if i - a < b - i else right
        else:
            near = "good" if x == "near" or scoped else "bad"
        out.append(near == "good" if near else scoped or x == "near")
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    found = blocks(html)
    size: dict[int, int] = {}
    long: set[int] = set()
    for b in found:
        if b.article and not b.bad:
            size[b.article] = size.get(b.article, 0) + len(b.text)
            if len(b.text) > LONG and b.linked <= LINKED * len(b.text):
                long.add(b.article)
    scope = {a for a, n in size.items() if a in long or n >= BESIDE * max(size.values())}
    # Announced boilerplate may stand beside any block, so it is no neighbour to inherit from.
    found = [b for b in found if not b.bad and (not scope or b.article in scope)]
    counts = [(0, 0) if b.heading or b.linked > LINKED * len(b.text) else stop_words(b.text) for b in found]
    known = sum(n for n, _ in counts) >= KNOWN * sum(words for _, words in counts)
    good = second_pass([first_pass(b, c, bool(size), known) for b, c in zip(found, counts, strict=True)], [b.heading for b in found], bool(size))
    return "\n\n".join(b.text for b, g in zip(found, good, strict=True) if g)


def main_text_column(html: Column) -> Column:
    @F.arrow_udf("string")
    def extract(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return extract(html)


def extract_pages(pages: DataFrame, *, html: str = "html", text: str = "text") -> DataFrame:
    """The rows with the main text in ``text``."""
    return pages.withColumn(text, main_text_column(F.col(html)))
