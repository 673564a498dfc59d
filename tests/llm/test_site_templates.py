from __future__ import annotations

import re
from html import unescape

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm import site_templates as s
from panelkit.llm.registry import table

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def plain_article(html):
    """What stands between the article's tags, cut at block tags."""
    found = re.search(r"<article>(.*?)(?:</article>|<footer|\Z)", html, re.S)
    raw = re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\0", found[1] if found else ""))
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in raw.split("\0")]
    return "\n\n".join(b for b in blocks if b)


def test_articles_of_the_table(spark, sf):
    pages = table(spark, sf, "pages")
    got = {r.page_id: r.text for r in s.extract(pages).collect()}
    assert got == {r.page_id: plain_article(r.html) for r in pages.collect()}


CASES = {
    "<p>a  b\n c<p>d &amp; &eacute;&#8212;&nbsp;x": "a b c\n\nd & é— x",
    "<body><nav>menu</nav><header>top</header><article><header><h1>T</h1></header><p>x</p></article><footer>f</footer>": "T\n\nx",
    "<article><p>x</p><aside>side</aside><form>f<input></form><div class='share buttons'>s</div></article>": "x",
    "<main><p>x</p></main><p>outside</p>": "x",
    "<article>x</article><section id=comments><article>comment</article></section>": "x",
    "<div class='cookie-notice'>we</div><p>x</p><div class=\"ad\">buy</div>": "x",
    "<p>a<script>if (1 < 2) '</p>'</script>b<style>p{}</style>c<!-- no > --><!-- open": "abc",
    "<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>": "one\n\ntwo\n\nc1\n\nc2",
    "<article><p>1 < 2 and 3 > 2</p><p>end <b>bold": "1 < 2 and 3 > 2\n\nend bold",
    "<article><p>cut <a href='x": "cut",
    "<p>line<br>break<hr>after": "line break\n\nafter",
    "<title>t</title><body>text": "text",
    "<div class='layout has-sidebar'><article><p>The body text.</p></article></div>": "The body text.",
    "<div class='no-comments'><article><p>x": "x",
    "<div class='sidebar'><main><p>held by a sidebar": "held by a sidebar",
    "<body class='nav-open'><div id='comments-on'><p>text": "text",
    "<main><h1>T</h1><p>Long body of the page</p><article class='card'>teaser</article></main>": "T\n\nLong body of the page\n\nteaser",
    "<div><p>A body in a plain element, of some length</p></div><article>small</article>": "A body in a plain element, of some length\n\nsmall",
    "<form id=f><article><p>whole page in a form</p></article></form>": "whole page in a form",
    "<div class='mainNav top-menu'>m</div><div class='cookie-box2'>c</div><p>x</p>": "x",
    "<article><p>x</p></article><div class='comments-list'><article>a much longer comment than the article is</article></div>": "x",
    "": "", "no tags at all": "no tags at all", "<article></article>": "", "</p></div>x": "x",
    "<article><pre>a\n  b</pre><blockquote>q</blockquote></article>": "a b\n\nq",
}


@pytest.mark.parametrize("html", CASES)
def test_single_pages(html):
    assert s.Page(html).text == CASES[html]


def page(i, body, host="a.example"):
    return (i, f"http://{host}/{i}", f"<html><body>{body}</body></html>")


def test_recurring_subtrees_go(spark):
    shared = "<div class='x9'><span>Welcome to our site</span> <b>since 1999</b></div>"
    rows = [page(i, f"{shared}<div><p>story number {i}</p></div><div>All about us</div>") for i in range(12)]
    rows += [page(100, f"{shared}<p>other host</p>", "b.example"), (101, None, f"{shared}<p>no host</p>")]
    got = {r.page_id: r.text for r in s.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(got[i] == f"story number {i}" for i in range(12))
    assert got[100].startswith("Welcome to our site since 1999") and got[101].endswith("no host")


def test_copies_of_an_article_stay(spark):
    rows = [page(i, f"<div>menu of all</div><article><h1>Same</h1><p>Shared story.</p><p>{i % 3}</p><ul><li><a href='/'>next page</a></ul></article>")
            for i in range(30)]
    got = [r.text for r in s.extract(spark.createDataFrame(rows, PAGES)).collect()]
    assert sorted(set(got)) == [f"Same\n\nShared story.\n\n{i}" for i in range(3)]


def test_recurring_subtrees_inside_an_article_go(spark):
    """A line of every page that stands in articles of different contents."""
    rows = [page(i, f"<article><h1>Title {i}</h1><p>The long story of number {i} is told here.</p><div>Written by our staff</div>"
                 f"<p>Read us daily.</p></article>") for i in range(12)]
    got = {r.page_id: r.text for r in s.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"Title {i}\n\nThe long story of number {i} is told here." for i in range(12)}


def test_passages_that_articles_share_stay(spark):
    rows = [page(i, f"<article><p>The long story of number {i} is told here.</p>{'<p>A shared passage.</p>' if i % 3 == 0 else ''}</article>")
            for i in range(60)]
    got = {r.page_id: r.text for r in s.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert all(("A shared passage." in got[i]) == (i % 3 == 0) for i in range(60))


def test_copies_of_an_article_in_varying_surroundings_stay(spark):
    rows = [page(i, f"<div>seen {i} times</div><article><p>A passage of the copied article.</p><p>And its longest passage of all.</p></article>")
            for i in range(30)]
    got = {r.text for r in s.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {"A passage of the copied article.\n\nAnd its longest passage of all."}


def test_templates_by_a_join_are_the_same(spark):
    rows = [page(i, f"<div>Our sidebar</div><p>story {i}</p><ul><li><a href='/'>home</a></ul>") for i in range(20)]
    rows += [page(i, f"<div>Their sidebar</div><div>story {i}</div>", "b.example") for i in range(20)] + [(1, None, None)]
    frame = spark.createDataFrame(rows, PAGES).withColumn("_page", F.lit("p")).withColumn("_template", F.lit("t"))
    shared, joined = ([tuple(r) for r in s.extract(frame, shared_rows=n).orderBy("page_id", "url").collect()] for n in (1000, 0))
    assert shared == joined and sum(r[-1].startswith("story") for r in shared) == 40
    assert all(r[3:5] == ("p", "t") for r in shared)


def test_copies_of_a_page_are_one_page(spark):
    """Repeated rows and copies under other URLs, without an article, among others of the host."""
    rows = [page(1, "<div>said often</div>")] * 30 + [page(i, "<div>copied</div>") for i in range(100, 130)]
    rows += [page(i, f"<div>All about us</div><div>story {i}</div>") for i in range(200, 220)]
    got = {r.page_id: r.text for r in s.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: "said often", **dict.fromkeys(range(100, 130), "copied"), **{i: f"story {i}" for i in range(200, 220)}}


def test_template_does_not_depend_on_the_size_of_the_host(spark):
    for others in (1_000, 4_000):
        rows = [page(i, f"<div>Our sidebar</div><p>story {i}</p>") for i in range(s.ENOUGH_PAGES)]
        rows += [page(i, f"<p>story {i}</p>") for i in range(s.ENOUGH_PAGES, others)]
        assert all(r.text == f"story {r.page_id}" for r in s.extract(spark.createDataFrame(rows, PAGES)).collect())


def test_few_pages_are_no_template(spark):
    rows = [page(i, "<div>said twice</div>") for i in range(s.LEAST_PAGES - 1)]
    assert {r.text for r in s.extract(spark.createDataFrame(rows, PAGES)).collect()} == {"said twice"}


def test_hosts(spark):
    urls = {"http://A.example:80/x": "a.example", "https://u:p@b.example?q": "b.example", "x": "", None: "", "ftp://c.example#f": "c.example"}
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r.url: r.h for r in frame.withColumn("h", s.host_of(F.col("url"))).collect()} == urls


def test_edge_cases(spark):
    rows = [(1, None, None), (1, "http://a/", ""), (None, "http://a/", "<p>x"), (None, "http://a/", "<p>x"), (2, "http://a/", "<p>" + "y " * 300_000)]
    got = s.extract(spark.createDataFrame(rows, PAGES).withColumn("host", F.lit("h")).withColumn("hash", F.lit("h"))).collect()
    assert len(got) == 5 and sorted(len(r.text) for r in got) == [0, 0, 1, 1, 599_999] and all(r.host == "h" for r in got)
    assert s.extract(spark.createDataFrame([], PAGES)).collect() == []
    with pytest.raises(ValueError, match="text"):
        s.extract(spark.createDataFrame([], PAGES).withColumn("text", F.lit("")))
