import re

import pytest

from tessellate.llm import html_text, queries

from .helpers import SF

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav>
<div id="cookieNotice">We use cookies.</div><div class=wrap><article><header><h1>Title &amp; more</h1></header>
<p>First   paragraph with <b>bold<i> text</i></b> and a <a href="/l">link</a>.<p>Second&nbsp;one,<br>two lines.
<script>var t="</p><p>no";</script><!-- ad <p>no --><form><p>Name</p></form><ul><li>One item<li>Another item</ul>
<div class="related-posts"><p>More to read here.</p></div><table><tr><td>a cell<td>b cell</table><p hidden>secret</p>
<section id=comments><p>A reader says so.</p></section></article></div><aside><p>Side text, a long one.</p></aside><footer>&copy; x</footer></body></html>"""
WANT = ("Title & more\nFirst paragraph with bold text and a link.\nSecond one, two lines.\nOne item\nAnother item\n"
        "a cell\nb cell")


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_blocks_and_best_container():
    found = html_text.blocks(PAGE)
    assert html_text.text_below(found, html_text.best(found)) == WANT


BODY = "<h1>The head</h1><p>A first sentence of the article, long enough.</p><p>And a second one.</p>"
TEXT = "The head\nA first sentence of the article, long enough.\nAnd a second one."
MENU = "<div class='sidebar-left'><p>Side text of some length that is not wanted.</p></div>"


@pytest.mark.parametrize("page, want", [
    (f"<div class='content has-sidebar'><article>{BODY}</article>{MENU}</div>", TEXT),
    (f"<div id=page class=no-sidebar><div>{BODY}</div>{MENU}</div>", TEXT),
    (f"<div class='header-fixed'><main>{BODY}</main></div>", TEXT),
    (f"<article><div class=entry-header><h1>The head</h1></div>{BODY[17:]}</article>", TEXT),
    (f"<article>{BODY}<section id=related-work><p>Others have done this before.</p></section></article>",
     TEXT + "\nOthers have done this before."),
    (f"<article>{BODY}<figure><img src=x><figcaption>A caption.</figcaption></figure></article>", TEXT + "\nA caption."),
    (f"<article>{BODY}<p>So <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>", TEXT + "\nSo x=1 holds."),
    (f"<body><form id=aspnetForm><div class=main>{BODY}</div>{MENU}</form></body>", TEXT),
    (f"<article>{BODY}<form><label>Name of the reader who writes to us</label></form></article>", TEXT),
    (f"<article>{BODY}<p>Seen <span class=ad>Buy it now!</span>by all.</p></article>", TEXT + "\nSeen by all."),
    (f"<article>{BODY}<ol class=commentlist><li><article><p>A reader's own opinion of it all.</p></article></ol></article>", TEXT),
    (f"<main>{BODY}</main><div class=sidebar><article><p>A teaser text.</p></article></div>", TEXT),
    (f"<div class='header top'><form><div class=modal><article>{BODY}</article></div></form></div>", TEXT),
])
def test_layout_names_and_the_article_inside(page, want):
    found = html_text.blocks(page)
    assert html_text.text_below(found, html_text.best(found)) == want


@pytest.mark.parametrize("page", ["", "plain words only", "<p>one<p>two", "<", "<p", "a < b and c > d", "</div></p>", "<b>x",
                                  "<script>never closed <p>x", "<!-- open <p>x", "<p a='x>y'>text</p>", "&am &#65; &bogus;",
                                  "<div>" * 500 + "deep" + "</div>" * 500, "<a href=\"x>" * 300])
def test_broken_markup_gives_text(page):
    found = html_text.blocks(page)
    assert "<p>" not in html_text.text_below(found, ())
    html_text.best(found)


def test_host_consensus_beats_a_page_of_its_own(spark):
    page = "<body><div class='post-{0}'>{1}</div><div class=extra>{2}</div></body>"
    body, extra = "<p>A real sentence of the article here.</p>" * 3, "<p>Something else that fills the page entirely.</p>"
    rows = [(i, "https://h.example/a", page.format(i, body, "")) for i in range(5)]
    rows.append((5, "https://H.example:80/b", page.format(77, "<p>A real sentence.</p>", extra * 4)))
    rows.append((6, "https://other.example/", page.format(8, "<p>Short.</p>", extra * 4)))
    got = {r.page_id: r.text for r in html_text.extract(table(spark, rows)).collect()}
    assert got[5] == "A real sentence."  # the host's pages tell where its articles are
    assert got[6].startswith("Short.") or got[6].startswith("Something")
    assert got[0].count("\n") == 2


def test_query_against_a_plain_reading_of_the_pages(spark):
    import html

    got = {r.page_id: r for r in queries.QUERIES["op7_html_text"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r.html, re.S)[1]
        want = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(x for x in want if x)
        assert (got[r.page_id].url, got[r.page_id].text, got[r.page_id].n_chars) == (r.url, want, len(want))


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "x", PAGE), (4, "http://h/", PAGE), (4, "http://h/", PAGE),
            (5, "http://h/", "<article>" + "<p>some words of a very long page.</p>" * 20_000 + "</article>")]
    pages = table(spark, rows).selectExpr("*", "'x' AS host", "'y' AS path", "1 AS votes")
    got = sorted(((r.page_id or 0, r.n_chars) for r in html_text.extract(pages).collect()))
    assert got == [(0, len(WANT)), (1, 0), (2, 0), (4, len(WANT)), (4, len(WANT)), (5, 31 * 20_000 + 19_999)]
    assert html_text.extract(pages.limit(0)).count() == 0
