import html
import re

import pytest

from pulsetrail.llm.html_extract import Page, deduce_templates, main_text, nested
from pulsetrail.llm.queries import all_queries

SF = "/root/testdata/sf0.01"


def run(spark, folder):
    rows = all_queries()["op9_html_extraction"](spark, folder).collect()
    assert all(r.n_chars == len(r.text) for r in rows)
    return {r.page_id: r.text for r in rows}


def article(source):
    """The text of the one article of the given pages."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", source, re.DOTALL)
    blocks = re.split(r"</?(?:p|h1|br)>", body[1].replace("<b>", "")) if body else []
    return " ".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    found = run(spark, SF)
    assert len(found) == len(rows)
    for r in rows:
        assert found[r.page_id] == article(r.html)


@pytest.mark.parametrize(
    "source, text",
    [
        ("", ""),
        ("plain &lt;text&gt;", "plain <text>"),
        ("<p>a</p><p>b<b>c</b>  d<br>e", "a bc d e"),
        ("<div class=ad>x</div><p>y", "y"),
        ("<body><div class='page with-sidebar'><main><p>in</p></main><div id=sidebar>out</div></div>", "in"),
        ("<article><header><h1>T</h1></header><p>x</p><footer>by</footer><aside>s</aside></article><p>z", "T x"),
        ("<article>a</article><section id='comments'><article>no</article></section><article>b</article>", "a b"),
        ("<header>h</header><nav>n<ul><li>m</ul></nav><form><p>f</p></form><p>t</p>", "t"),
        ("<script>var a='<p>x</p>';</script><style>p{}</style><p>t<!-- c > --> u</p>", "t u"),
        ("<p title='a>b' data-x=it's>q</p> 1 < 2 & 3", "q 1 < 2 & 3"),
        ("<div class=comments><p>one<div>two</div></div><p>three", "three"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut <b", "cut"),
        ("<article>&nbsp;x&#233;&eacute; y</article>", "xéé y"),
        ("<p class=notice>n<p>t", "t"),
        ("<article><p>" + "long &amp; " * 50_000 + "</article>", ("long & " * 50_000).strip()),
        ("</p></div></article>x", "x"),
        ("<head><title>t</title><meta charset=x><body>b", "b"),
    ],
)
def test_page(source, text):
    assert Page(source).text() == text


def site(n):
    """Pages without an article element; only the template tells the text from what surrounds it."""
    page = "<html><body><div id=top><p>Our site</p><p>Since 1999</p></div><div id=body><h1>Title {0}</h1><p>Text {0} of our</p></div><div id=end><p>All rights</p></div></body></html>"
    return [(i, f"http://site.example/{i}", page.format(i)) for i in range(n)]


def test_template_text_is_left_out(spark, pages):
    found = run(spark, pages(site(9) + [(100, "http://other.example/", site(1)[0][2])]))
    assert all(found[i] == f"Title {i} Text {i} of our" for i in range(9))
    assert found[100] == "Our site Since 1999 Title 0 Text 0 of our All rights"


def test_tokens_out_of_order_are_no_template(spark):
    rows = [(f"<body><div id=a><p>one</p></div><div id=b>{i}</div>" if i % 2 else f"<body><div id=b>{i}</div><div id=a><p>one</p></div>") for i in range(8)]
    df = spark.createDataFrame([("h", i, r) for i, r in enumerate(rows)], "host string, key bigint, html string")
    assert deduce_templates(df).count() == 0
    same = spark.createDataFrame([("h", i, rows[1]) for i in range(8)], "host string, key bigint, html string")
    assert deduce_templates(same).count() > 4


def test_odd_rows(spark, pages):
    rows = [(1, None, None), (2, "http://[x", "<p>a"), (3, "", ""), (None, "http://h/", "<p>b"), (2, "http://[x", "<p>a")]
    folder = pages(rows)
    found = sorted((str(r.page_id), r.text) for r in all_queries()["op9_html_extraction"](spark, folder).collect())
    assert found == [("1", ""), ("2", "a"), ("2", "a"), ("3", ""), ("None", "b")]
    df = spark.read.parquet(f"{folder}/pages.parquet").withColumnRenamed("page_id", "host")
    assert main_text(df).select("_row.*").columns == df.columns


def test_empty_table(spark, pages):
    assert run(spark, pages([])) == {}


def test_classes_nest():
    of = {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 20: 20, 21: 20}
    sizes = {1: 3, 10: 2, 20: 2}
    place = lambda tokens: {n: found and found[1:] for n, found in nested(tokens, of, sizes).items()}
    # A class that repeats lies in one gap of the one around it, another within it.
    assert place([1, 2, 10, 20, 21, 11, 10, 20, 21, 11, 3]) == {1: (0, 0), 10: (1, 2), 20: (10, 1)}
    # Its rounds in two gaps; a round across a token of the class around it; a round that is not whole.
    assert place([1, 10, 11, 2, 10, 11, 3]) == {1: (0, 0), 10: None}
    assert place([1, 10, 2, 11, 3]) == {1: (0, 0), 10: None}
    assert place([1, 2, 3, 10, 10, 11, 11]) == {1: (0, 0), 10: None}


def test_only_nested_classes_are_templates(spark):
    """Two elements on each other page: around one that all pages have, or between two of them."""
    pages = [(host, i, f"<body>{some if i % 2 else every}") for host, some, every in (
        ("across", "<div class=x></div><div class=m></div><div class=y></div>", "<div class=m></div>"),
        ("within", "<div class=m></div><div class=x></div><div class=y></div><div class=n></div>", "<div class=m></div><div class=n></div>"),
    ) for i in range(8)]
    df = spark.createDataFrame(pages, "host string, key bigint, html string")
    found = sorted((r.host, r.gap or 0) for r in deduce_templates(df).collect())
    assert found == [("across", 0)] * 3 + [("within", 0)] * 4 + [("within", 3)] * 2
