"""Wrappers whose class names boilerplate words, forms around pages, articles side by side, lists of links."""

import pytest

from harrow.llm.html_text import main_text

LONG = "This is what the council said to the people of the town when they met in the hall, and it was not what they had hoped for in the spring. " * 4
TEXT = LONG.strip()
MENU = '<nav><a href="/">Home</a> <a href="/x">News</a></nav>'
NAMES = ["layout has-sidebar", "site no-sidebar", "content-with-nav", "legal-news", "popular-science", "notice-of-meeting", "social-science-article", "page cookie-consent-ready"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("attribute", ["class", "id"])
def test_a_wrapper_is_no_boilerplate(name, attribute):
    for inner in (f"<p>{TEXT}</p>", f"<article><p>{TEXT}</p></article>", f"<main><p>{TEXT}</p></main>"):
        page = f'<html><body>{MENU}<div {attribute}="{name}">{inner}</div><footer>© 2024 us</footer></body></html>'
        assert main_text(page) == TEXT, inner
    assert main_text(f'<body>{MENU}<article {attribute}="{name}"><p>{TEXT}</p></article></body>') == TEXT
    assert main_text(f'<body>{MENU}<article><div {attribute}="{name}"><p>{TEXT}</p></div></article></body>') == TEXT


def test_suspects_that_hold_little_go():
    side = '<div class="sidebar"><p>You can also read what the others have said about it in the last days, and it is all here for you to see and to share with us.</p></div>'
    box = '<div class="newsletter"><p>Get the news of the town by mail.</p></div>'
    for page in (f"<body><article><p>{TEXT}</p>{box}<p>{TEXT}</p></article>{side}</body>", f'<body><div class="has-sidebar"><div>{"<p>" + TEXT + "</p>"}{box}<p>{TEXT}</p></div>{side}</div></body>'):
        assert main_text(page) == f"{TEXT}\n\n{TEXT}"
    comments = '<div id="comments">' + "".join(f"<article class='comment'><p>I do not think that this is what they have said to us. {n}</p></article>" for n in range(3)) + "</div>"
    assert main_text(f"<body><article><p>{TEXT}</p></article>{comments}</body>") == TEXT
    for one in ("<article>", "<article class='comment'>", "<div>"):
        long = f'<section class="comments">{one}<p>{TEXT.replace("council", "reader")}</p></section>'
        assert main_text(f"<body><article><p>{TEXT}</p><p>{TEXT}</p></article>{long}</body>") == f"{TEXT}\n\n{TEXT}"


def test_a_form_around_the_page():
    assert main_text(f'<body><form action="/post">{MENU}<div><p>{TEXT}</p></div></form></body>') == TEXT
    assert main_text(f"<body><article><p>{TEXT}</p><form><p>Your name and your mail, and what you have to say to us.</p></form></article></body>") == TEXT


def test_articles_side_by_side():
    other = TEXT.replace("council", "mayor")
    assert main_text(f"<body>{MENU}<article><h2>One</h2><p>{TEXT} {TEXT}</p></article><article><h2>Two</h2><p>{other}</p></article></body>") == f"One\n\n{TEXT} {TEXT}\n\nTwo\n\n{other}"


def test_links_between_paragraphs():
    links = "<ul>" + "".join(f'<li><a href="/{n}">The report of the year 200{n} on the water of the town</a></li>' for n in range(3)) + "</ul>"
    found = main_text(f"<body><article><p>{TEXT}</p>{links}<p>{TEXT}</p></article></body>").split("\n\n")
    assert found == [TEXT, *(f"The report of the year 200{n} on the water of the town" for n in range(3)), TEXT]
