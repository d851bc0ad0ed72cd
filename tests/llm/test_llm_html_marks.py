"""Words in classes and ids inside an article are often its subject."""

import pytest

from ombuds.llm.html_text import main_text

LONG = "A sentence of some length that tells the reader what the article is about, at last. " * 3


def page(inside):
    return f"<body><article><h1>Title</h1><p>{LONG}</p>{inside}<p>{LONG}</p></article></body>"


@pytest.mark.parametrize(
    "inside",
    [
        f"<section id='search-api'><h2>Search</h2><p>{LONG}</p></section>",
        f"<section id='related-work'><p>{LONG}</p></section>",
        "<h2 id='legal-basis'>The legal basis</h2>",
        "<h2 class='social'>Social life</h2>",
        f"<p class='teaser'>{LONG}</p>",
        "<p id='share'>Short.</p>",
        f"<div class='social-history'><p>{LONG}</p><p>Short.</p></div>",
        f"<section id='discussion'><h2>Discussion</h2><p>{LONG}</p></section>",
        f"<section class='discussion'><p>{LONG}</p></section>",
        "<ul><li id='cookies'>Cookies</li></ul>",
        f"<div id='notification-service'><p>{LONG}</p></div>",
    ],
)
def test_sections_of_an_article_stay(inside):
    plain = " ".join("".join(" " if part.startswith("<") else part for part in split(inside)).split())
    assert main_text(page(inside)) == " ".join(f"Title {LONG} {plain} {LONG}".split())


def split(html):
    return [piece for part in html.replace(">", ">\0").replace("<", "\0<").split("\0") for piece in [part] if piece]


@pytest.mark.parametrize(
    "inside",
    [
        f"<div class='related'><ul><li><a href=x>{LONG}</a></li><li><a href=y>{LONG}</a></li></ul></div>",
        "<div class='share'><span>Share</span> <span>on</span> <span>a</span> <b>site</b></div>",
        f"<div class='advert'><p>{LONG}</p></div>",
        f"<section class='comments'><p>{LONG}</p></section>",
    ],
)
def test_what_is_no_content_still_goes(inside):
    assert main_text(page(inside)) == " ".join(f"Title {LONG} {LONG}".split())


def test_marks_outside_an_article_are_as_before():
    html = f"<body><div><p>{LONG}</p><p>{LONG}</p></div><div class='related'><p>{LONG}</p></div></body>"
    assert main_text(html) == " ".join(f"{LONG} {LONG}".split())
