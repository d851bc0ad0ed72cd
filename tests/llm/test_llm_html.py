import html as entities
import re

import pytest
from odd_docs import no_docs

from ombuds.llm import html_text, queries
from ombuds.llm.html_text import main_text

SMALL = "/root/testdata/sf0.001"
LONG = "A sentence of some length that tells the reader what the article is about, at last. " * 3


def page(article, around=""):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body>{around}<article>{article}</article></body></html>"


def test_query_gives_the_articles(spark):
    pages = {row.page_id: row.html for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = queries.op5_html_text(spark, SMALL).collect()
    assert len(rows) == len(pages)
    for row in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.S)[1]
        assert row.text == " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert row.n_chars == len(row.text)


@pytest.mark.parametrize(
    "junk",
    [
        "<nav><ul><li><a href='/'>Home</a></li></ul></nav>",
        "<header><h1>Site name</h1></header>",
        "<div class='ad-banner'>Buy this now, it is the best there ever was.</div>",
        "<aside>" + LONG + "</aside>",
        "<div id=cookieNotice><p>" + LONG + "</p></div>",
        "<form><label>Name</label><input><button>Send</button></form>",
        "<script>var t = '</p><p>" + LONG + "';</script>",
        "<section class='comments'><article><p>" + LONG + "</p></article></section>",
        "<div role='complementary'>Other things</div>",
        "<p hidden>" + LONG + "</p>",
        "<!-- " + LONG + " -->",
        "<noscript>Turn it on</noscript>",
        "<footer>&copy; all of us</footer>",
    ],
)
def test_what_is_no_content_goes(junk):
    body = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
    want = " ".join(f"Title {LONG} Short. {LONG}".split())
    assert main_text(page(body, around=junk)) == want
    assert main_text(page(body).replace("</article>", "</article>" + junk)) == want
    if "<header>" not in junk:  # inside an article it holds the article's own title
        assert main_text(page(body + junk)) == want


def test_without_an_article_the_dense_region_is_taken():
    text = f"<div class=nav><a>x</a></div><div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div><a>a</a> <a>b</a> <a>c</a></div>"
    assert main_text(f"<body>{text}</body>") == " ".join(f"{LONG} Short. {LONG}".split())


def test_references_space_and_open_tags():
    assert main_text(page("<p><b>a &amp;amp; b&nbsp;&#x41;\n\t c<br>d<p>e &lt;f&gt;")) == "a &amp; b A c d e <f>"
    assert main_text("<div class=ad>Buy" + page(f"<p>{LONG}</p>")) == LONG.strip()
    assert main_text(f"<article><p>{LONG}") == LONG.strip()
    assert main_text("just text") == "just text"


def test_odd_rows(spark):
    long = page("".join(f"<p>{LONG}{i}</p>" for i in range(3000)))
    rows = [(1, None), (2, ""), (3, "<p>"), (4, long), (5, "<p>x</p>"), (5, "<p>x</p>"), (None, "<script>x")]
    pages = spark.createDataFrame([(i, h, "old", "kept") for i, h in rows], "page_id long, html string, text string, lines string")
    found = html_text.extract(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in found) == sorted(
        [("1", 0), ("2", 0), ("3", 0), ("4", len(main_text(long))), ("5", 1), ("5", 1), ("None", 0)]
    )
    assert {r["lines"] for r in found} == {"kept"} and all(len(r.text) == r.n_chars for r in found)
    assert len(main_text(long)) > 3000 * len(LONG)
    assert html_text.extract(no_docs(spark), html="text").count() == 0
