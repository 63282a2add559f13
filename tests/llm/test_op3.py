"""Main text of pages against an independent reading of their articles, and small hand-made pages."""

import re
from html import unescape

from conftest import SF_SMALL
from nivalis.llm import html_text


def article_of(html):
    """The generator's pages hold one article; its blocks are what stands between block tags."""
    body = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h\d)\b[^>]*>", re.sub(r"<br>", " ", body))
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", unescape(re.sub(r"<[^>]+>", "", b))).strip(" ") for b in blocks]
    return "\n".join(b for b in plain if b)


def test_query_on_whole_pages(spark, duck):
    from nivalis.llm import queries
    got = {r.page_id: r for r in queries.QUERIES["op3_html_text"](spark, "/root/testdata/sf0.01").collect()}
    rows = duck.sql("select page_id, url, html from read_parquet('/root/testdata/sf0.01/pages.parquet')").fetchall()
    assert len(got) == len(rows)
    for page_id, url, html in rows:
        want = article_of(html)
        assert (got[page_id].url, got[page_id].text, got[page_id].n_chars) == (url, want, len(want))


PAGE = """<html><head><title>t</title><script>var a = "</p><p>no";</script><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu entry</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site and you should accept every one of them now.</div>
<div id="content"><h2>Title</h2><p>Short.</p><p>A long  paragraph &amp; more\n of it, with <b>bold</b> and <a href=y>links</a>, that goes on for a while &#233;.
<p>Second paragraph, left open, which also has a fair number of words in it for the ratio.<br>New line
<form><label>Search</label><input></form><div class="adBox ad">Buy this thing now because it is cheap and good for you.</div>
<ul><li>One</li><li>Two</li></ul><p>End.</p></div>
<aside><p>Sidebar text that is long enough to look like a paragraph of the article itself, is it not.</p></aside>
<section id="comments"><p>I am a reader and I say that this is the best article that I have ever read.</p></section>
<footer>&copy; someone</footer></body></html>"""


def test_page_without_article_element():
    assert html_text.extract(PAGE) == "\n".join([
        "Title", "Short.", "A long paragraph & more of it, with bold and links, that goes on for a while é.",
        "Second paragraph, left open, which also has a fair number of words in it for the ratio. New line",
        "One", "Two", "End."])


def test_edge_cases(spark):
    pages = [(1, "u", None), (2, None, ""), (3, "u", "<html><body><script>x</script></body></html>"), (4, "u", "just text &lt;b&gt;"),
             (4, "u", "just text &lt;b&gt;"), (5, "u", "<p>" * 2000 + "deep"), (None, "u", "<article><p>a</p><p>" + "b " * 100_000 + "</article>"),
             (6, "u", "<div><p>broken <b>tags</i> </p></p> here</div"), (7, "u", "<!-- <p>no</p> --><p>yes</p>")]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_text.pages_text(df).collect()}
    assert html_text.pages_text(df).count() == len(pages)
    assert got[1] == got[2] == got[3] == ""
    assert got[4] == "just text <b>" and got[5] == "deep" and got[7] == "yes"
    assert got[6] == "broken tags\nhere"
    assert got[None] == "a\n" + ("b " * 100_000).strip()
    assert html_text.pages_text(df.limit(0)).count() == 0


SENTENCES = [f"This is sentence number {i} of the article, and it says something about the weather in the hills." for i in range(8)]
ARTICLE = "<article><h1>Head</h1>" + "".join(f"<p>{s}</p>" for s in SENTENCES) + "</article>"
WHOLE = "\n".join(["Head", *SENTENCES])


def test_names_of_wrappers_lose_nothing():
    for name in ("layout has-sidebar", "no-sidebar", "with-header", "comments-open", "related-work", "share-price",
                 "form-of-government", "modal", "sidebar layout"):
        assert html_text.extract(f"<body><div class='{name}'>{ARTICLE}</div></body>") == WHOLE, name
    assert html_text.extract(f"<body><form action=x><nav>Menu</nav>{ARTICLE}<input></form></body>") == WHOLE
    assert html_text.extract("<body><form>" + "".join(f"<p>{s}</p>" for s in SENTENCES) + "</form></body>") == "\n".join(SENTENCES)
    inner = ARTICLE.replace("<p>", "<div class='related-work'><p>", 1).replace("</p>", "</p></div>", 1)
    assert html_text.extract(f"<body>{inner}</body>") == WHOLE


def test_marked_parts_go_from_inside_and_outside_the_article():
    junk = "".join(f"<p>{s.replace('weather', 'price')}</p>" for s in SENTENCES)
    for name in ("comments", "comment-list", "ad", "ad-slot", "nav-links", "share-buttons", "relatedPosts", "newsletter", "cookie-banner"):
        assert html_text.extract(f"<body>{ARTICLE}<section class='{name}'>{junk}</section></body>") == WHOLE, name
        inner = ARTICLE.replace("</article>", f"<div id='{name}'>{junk[:200]}</p></div></article>")
        assert html_text.extract(f"<body>{inner}</body>") == WHOLE, name
    replies = "".join(f"<article class='comment'><p>{s} Indeed.</p></article>" for s in SENTENCES * 3)
    assert html_text.extract(f"<body>{ARTICLE}<section class='comments'>{replies}</section></body>") == WHOLE
    plain = "<div id=text>" + "".join(f"<p>{s}</p>" for s in SENTENCES) + "</div>"
    assert html_text.extract(f"<body>{plain}<section class='comments'>{replies}</section></body>") == "\n".join(SENTENCES)
    assert html_text.extract(f"<body>{ARTICLE}<form><p>Leave your name and say what you think of it.</p></form></body>") == WHOLE


def test_a_long_quote_is_not_the_region():
    quote = [f"Quoted sentence {i}, which is long enough to be the greater part of everything on this page." for i in range(20)]
    page = (f"<body><div><p>{SENTENCES[0]}</p><blockquote>" + "".join(f"<p>{q}</p>" for q in quote)
            + f"</blockquote><p>{SENTENCES[1]}</p></div></body>")
    assert html_text.extract(page) == "\n".join([SENTENCES[0], *quote, SENTENCES[1]])


def test_clusters_decide_without_an_article():
    links = "<ul>" + "".join(f"<li><a href=x><b><i>Page</i> {i}</b></a></li>" for i in range(12)) + "</ul>"
    page = f"<body>{links}" + "".join(f"<p>{s}</p>" for s in SENTENCES) + f"{links}</body>"
    got = html_text.extract(page).split("\n")
    assert [line for line in got if line in SENTENCES] == SENTENCES
    assert len(got) <= len(SENTENCES) + 2 * html_text.RADIUS
