from __future__ import annotations

import random
import time
from html.parser import HTMLParser

import pytest

from corpuslens.llm import html_text

TEXT = "A long sentence of the article, with some words in it. " * 5
BOILERPLATE = (
    "related-posts share-buttons social-links newsletter-signup cookie-notice cookie-banner comment-respond comment-form reader-comments "
    "ad-container sponsored-content sidebar-left left-sidebar nav-links"
).split()


def read(page: str) -> str:
    return html_text.main_text(html_text.read_page(page), None)


@pytest.mark.parametrize("open_, close", [
    ("<html class='no-sidebar'><body class='single right-sidebar'>", "</body></html>"),
    ("<body class='has-sidebar'>", "</body>"),
    ("<body id='footer'>", "</body>"),
    ("<body><main class='content with-ads'>", "</main></body>"),
    ("<body><article class='post has-comments'>", "</article></body>"),
    ("<body><div class='content with-ads'>", "</div></body>"),
    ("<body><div class='page-with-sidebar'>", "</div></body>"),
    ("<body><div class='social-science-article'>", "</div></body>"),
    ("<body><article><div class='article-header'>", "</div></article></body>"),
    ("<body><div class='widget'>", "</div></body>"),  # nothing else: read again without names
])
def test_names_of_surroundings_do_not_drop_the_text(open_, close):
    assert read(f"{open_}<nav>Home</nav><p>{TEXT}</p>{close}") == TEXT.strip()


@pytest.mark.parametrize("name", [
    "ad", "ads", "ad-1", "sidebar", "post comments", "main-nav", "site-footer", "comments-area", "site-header", *BOILERPLATE
])
def test_names_of_boilerplate_skip(name):
    for where in ("<body><div><p>{t}</p></div>{b}</body>", "<body><article><p>{t}</p>{b}<p>End, of it all.</p></article></body>"):
        page = where.format(t=TEXT, b=f"<div class='{name}'><p>Boilerplate.</p></div>")
        assert "Boilerplate" not in " ".join(b[1] for b in html_text.read_page(page).blocks)


@pytest.mark.parametrize("page", [
    "<div>" * 20000 + "<p>" + TEXT + "</p>" + "</div>" * 20000,
    "<div>x" * 10000 + TEXT,
    "<b>" * 20000 + TEXT + "</i>" * 20000,
    "<a " * 30000 + TEXT, '<a href="' * 30000 + TEXT, "<!" * 30000 + TEXT, "<script" * 30000 + TEXT, "<x>" * 9000 + "<li>y</li>" * 9000 + TEXT,
    "<p>" + "&" * 60000 + TEXT, "<!--" + "-" * 60000 + TEXT,
], ids=range(10))
def test_time_grows_with_the_length(page):
    start = time.perf_counter()
    found = html_text.read_page(page)
    html_text.best_path(found)
    read(page)
    assert time.perf_counter() - start < 3  # three walks


class Reader(HTMLParser):
    """A second reader of well-formed pages: all text outside elements with an attribute `x`, as its generator marks them."""

    def __init__(self):
        super().__init__()
        self.open, self.parts = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in ("br", "img"):
            self.open.append(any(k == "x" for k, _ in attrs))
        if tag not in html_text.INLINE:
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.open.pop()
        if tag not in html_text.INLINE:
            self.parts.append(" ")

    def handle_data(self, data):
        if not any(self.open):
            self.parts.append(data)


def layout(rng: random.Random) -> str:
    """A page of one of many layouts; what is no main text has an attribute `x`."""
    sentence = lambda: " ".join(rng.choice("alpha beta gamma &amp; delta, eps &eacute;t&eacute; zeta".split()) for _ in range(rng.randint(6, 30))) + "."
    inline = lambda: rng.choice(["{}", "<b>{}</b> tail.", "<em>{}</em>", "{} <a href='/x'>link</a>."]).format(sentence())
    extra = lambda: rng.choice([
        "<nav x><ul><li><a href='/'>Home</a></li><li>More</li></ul></nav>", "<aside x><p>Side note.</p></aside>", "<footer x>(c) us</footer>",
        "<form x><p>Name</p><button>Send</button></form>", "<script x>var a = 1 < 2;</script>", "<style x>p {color: red}</style>",
        *[f"<div x class='{n}'><p>Noise, and more noise.</p></div>" for n in BOILERPLATE], "<div x id='comments'><p>First!</p></div>",
    ])
    body = []
    for _ in range(rng.randint(3, 9)):
        body.append(rng.choice(["<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote><p>{}</p></blockquote>", "<div><p>{}</p></div>"]).format(inline()))
        if rng.random() < 0.4:
            body.append(extra())
    holder = rng.choice(["<article>{}</article>", "<main class='content'>{}</main>", "<div class='entry-content'>{}</div>", "<section id='story'>{}</section>"])
    wrap = rng.choice(["{}", "<div class='page has-sidebar'>{}</div>", "<div id='wrapper'><div class='inner'>{}</div></div>"])
    page = wrap.format("<header x><h1>Site</h1></header>" + extra() + holder.format("\n ".join(body)) + extra() + "<footer x><p>Imprint</p></footer>")
    return f"<!DOCTYPE html><html><head><title x>T</title></head><body class='single'>{page}</body></html>"


def test_many_layouts_against_a_second_reader():
    rng = random.Random(7)
    for _ in range(600):
        page = layout(rng)
        reader = Reader()
        reader.feed(page)
        assert read(page) == " ".join("".join(reader.parts).split()), page


def test_a_long_page_is_read_whole():
    page = "<body><nav>Menu</nav><article>" + "<p>One more, of many.</p>" * 40000 + "</article></body>"
    assert read(page) == " ".join(["One more, of many."] * 40000)
