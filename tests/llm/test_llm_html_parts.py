"""Parts of an article that are no content, articles without running text, and deep nesting."""

import time

import pytest

from ombuds.llm.html_text import main_text

LONG = "A sentence of some length that tells the reader what the article is about, at last. " * 3
KEPT = " ".join(f"Title {LONG} {LONG}".split())


def page(inside):
    return f"<body><article><h1>Title</h1><p>{LONG}</p>{inside}<p>{LONG}</p></article></body>"


@pytest.mark.parametrize(
    "word", "sidebar newsletter notice notification comment replies subscribe sponsor banner related social disclaimer".split()
)
@pytest.mark.parametrize("tag", ["div", "section", "ul"])
def test_dense_parts_that_are_no_content_go(word, tag):
    item = f"<li>{LONG}</li>" if tag == "ul" else f"<p>{LONG}</p>"
    assert main_text(page(f"<{tag} class='{word}'>{item}</{tag}>")) == KEPT
    assert main_text(page(f"<{tag} class='x {word}-box'>{item}</{tag}>")) == KEPT


def test_a_word_beside_a_subject_stays():
    for name in ("social-history", "notice-period", "comment-on-the-law"):
        assert main_text(page(f"<div class='{name}'><p>{LONG}</p></div>")) == " ".join(f"Title {LONG} {LONG} {LONG}".split())


def test_the_only_article_is_taken_whatever_it_holds():
    titles = "".join(f"<li><a href=x{i}>The title of story {i}</a></li>" for i in range(6))
    want = "Stories " + " ".join(f"The title of story {i}" for i in range(6))
    assert main_text(f"<body><article><h1>Stories</h1><ul>{titles}</ul></article></body>") == want
    cells = "".join(f"<tr><td>{i}</td><td>{i * i}</td></tr>" for i in range(6))
    dense = f"<div><p>{LONG}</p><p>{LONG}</p></div>"
    table = " ".join(f"{i} {i * i}" for i in range(6))
    assert main_text(f"<body><article><table>{cells}</table></article>{dense}</body>").startswith(table)


@pytest.mark.parametrize(
    "deep",
    [
        "<div>" * 100_000 + "x",
        "<article>" + "<div class=widget>" * 100_000 + LONG,
        "<p>" + "<b>x" * 50_000 + "</i>" * 50_000,
        "<article><i>" + "<div>" * 30_000 + "<p>a</i></p>" * 30_000,
    ],
)
def test_time_is_linear_in_nesting(deep):
    started = time.time()
    main_text(deep)
    assert time.time() - started < 10
