"""Main text of pages."""

import html
import re
import time

import pytest

from panelspark.llm import html_extraction, queries
from panelspark.suite.registry import table

SF = "/root/testdata/sf0.01"
PAGES = {
    "<html><body><div id='header'>Site</div><div class='sidebar'>links here</div><div class='post'><h2>Title</h2>"
    "<p>Some words, here. More.</p><ul><li>One point</li></ul></div><div class='comments'><p>I disagree, strongly, "
    "with all.</p></div><form>Your name</form></body></html>": "Title\nSome words, here. More.\nOne point",
    "<p>just text &amp; more": "just text & more",
    "<body><main><h1>T</h1><section><p>a b.</p><section><p>deeper, text.</p></section></section><table><tr><td>x</td>"
    "<td>y</td></tr></table></main><div class='cookie-notice'>We use cookies. Accept, please.</div></body>":
        "T\na b.\ndeeper, text.\nx\ny",
    "<html><body><header>Top menu</header><div><div><p>Para one is long enough, I think.</p><p>Two.</p></div></div></body>":
        "Para one is long enough, I think.\nTwo.",
    "<article><p>One <b>bold</b>,\n two&nbsp;&#233;<br>three<p>four &lt;b&gt;<script>var t='</p>';</script></article>":
        "One bold, two é three\nfour <b>",
    "<article><h1>A &copy; B</h1><!-- note --><p>c</article><footer>&copy; site</footer>": "A © B\nc",
    "<body><div class='wrap'><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul><p>A first paragraph, "
    "with a <a href='/c'>link</a> in it. It goes on.</p><div hidden>not, shown. Never.</div></div></body>":
        "A first paragraph, with a link in it. It goes on.",
    "<nav><a href='/'>Home</a></nav>": "", "": "", "<": "<", "no markup at all": "no markup at all",
}


WRAPPED = [
    "<div class='site has-sidebar'><article>{}</article><div class='sidebar'>links</div></div>",
    "<body class='x'><div class='layout-sidebar-right'><div class='post no-comments'>{}</div></div></body>",
    "<body><form id='aspnet'><h1></h1><div>{}</div><div class='comments'>No.</div></form></body>",
    "<main><form>{}</form></main>", "<section class='related-work'>{}</section>",
    "<article>{}</article><div class='comments'><article>" + "I disagree, strongly. " * 50 + "</article></div>"]


@pytest.mark.parametrize("page", WRAPPED)
def test_names_and_forms_around_the_body_do_not_drop_it(page):
    assert html_extraction.main_text(page.format("<p>Some words, here. More of them.</p>")) == "Some words, here. More of them."


@pytest.mark.parametrize("page", list(PAGES))
def test_main_text(page):
    assert html_extraction.main_text(page) == PAGES[page]


def article_of(page):
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
    blocks = (" ".join(html.unescape(p).split()) for p in parts)
    return "\n".join(b for b in blocks if b)


def test_given_pages_give_their_article(spark):
    pages = table(spark, SF, "pages")
    for row in html_extraction.extract(pages, ["page_id", "html"]).collect():
        assert row.text == article_of(row.html)


def test_ratios_find_the_article_without_telling_tags_and_names(spark):
    pages = [r.html for r in table(spark, SF, "pages").collect()]
    plain = [re.sub(r"<(/?)(?:article|nav|footer|header|aside)>", r"<\1div>", p).replace(' class="ad"', "") for p in pages]
    same = sum(html_extraction.main_text(p) == article_of(page) for page, p in zip(pages, plain))
    assert same >= 0.95 * len(pages)


@pytest.mark.parametrize("page", [
    "<div><p>a b, c." * 20_000, "".join(f"<div class='c{i}'>x" for i in range(20_000)), "<div class='ad'>x, y." * 20_000,
    "<p><table>" + "<div>x, y." * 20_000, "<ul><li>" + "<span>x, y." * 20_000, "</p></div>" * 50_000])
def test_time_is_in_proportion_to_the_page(page):
    start = time.process_time()
    html_extraction.main_text(page)
    assert time.process_time() - start < 10


def test_adverts_of_pages_with_an_empty_article_are_no_text():
    page = "<nav><a href='/'>Home</a></nav><div class='ad'>Buy now, all of it. Really.</div><article><h1></h1></article>"
    assert html_extraction.main_text(page) == ""


def test_query_has_the_columns_of_its_contract(spark):
    got = queries.QUERIES["op8_html_extraction"](spark, SF)
    assert got.dtypes[:4] == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    rows = got.collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    assert all(r.text == article_of(pages[r.page_id]) and r.n_chars == len(r.text) for r in rows)


def test_edge_rows(spark):
    deep = "<div>" * 3000 + "far down, indeed" + "</div>" * 3000
    rows = [(1, None), (2, ""), (None, "<p>x</p>"), (1, "<p>x</p>"), (3, deep), (4, "<p>" + "long text. " * 50_000)]
    pages = spark.createDataFrame([(i, None, h, "clash", 1) for i, h in rows],
                                  "page_id bigint, url string, html string, text string, n_chars int")
    got = sorted(((r.page_id or 0, r.text) for r in html_extraction.extract(pages).collect()))
    assert got[:4] == [(0, "x"), (1, ""), (1, "x"), (2, "")]
    assert got[4] == (3, "far down, indeed") and len(got[5][1]) == 11 * 50_000 - 1
    assert html_extraction.extract(pages.where("false")).count() == 0
