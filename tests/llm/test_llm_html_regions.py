"""The clusters choose the regions, with and without articles."""

from ombuds.llm.html_text import main_text

LONG = "A sentence of some length that tells the reader what the article is about, at last. " * 3
BODY = "".join(f"<p>{LONG}{i}.</p>" for i in range(6))
TEXT = " ".join(f"{LONG}{i}." for i in range(6))
CARD = "<article><h3><a href=x>{0}</a></h3><ul><li><a href=y>More</a></li><li><a href=z>Share</a></li></ul></article>"
CARDS = "".join(CARD.format(f"Story {i}") for i in range(8))


def test_a_dense_div_stays_beside_a_teaser_article():
    assert main_text(f"<body><div>{BODY}</div>{CARDS}</body>") == TEXT
    # A card that is dense itself doesn't push the body out.
    teaser = f"<article><p>{LONG}</p></article>"
    for html in (f"<body><div>{BODY}</div>{teaser}</body>", f"<body>{teaser}<div>{BODY}</div></body>"):
        assert TEXT in main_text(html)


def test_of_several_articles_the_dense_one_is_taken():
    want = " ".join(f"Title {TEXT} Short.".split())
    for html in (f"{{}}{CARDS}", f"{CARDS}{{}}", f"<main>{CARDS}{{}}</main>"):
        assert main_text("<body>" + html.format(f"<article><h1>Title</h1>{BODY}<p>Short.</p></article>") + "</body>") == want


def test_an_article_is_filled_with_its_short_regions():
    short = "<section><table><tr><td>1</td><td>2</td></tr></table></section>"
    assert main_text(f"<body><article>{BODY}{short}</article></body>") == f"{TEXT} 1 2"


def test_without_an_article():
    menu = "<div>" + "".join(f"<a href=x>l{i}</a> " for i in range(9)) + "</div>"
    assert main_text(f"<body>{menu}<div><section>{BODY}</section></div>{menu}</body>") == TEXT
