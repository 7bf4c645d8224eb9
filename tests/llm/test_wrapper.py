import html
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import wrapper

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><article>x";</script></head>
<body class="home"><header class="top">Site name</header><nav><ul><li>Menu one<li>Menu two</ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><div class="ad">Buy</div><aside>Side</aside>
<article><header><h1>The   title</h1></header><p>First <b>bold</b>&nbsp;and &lt;x&gt; &amp;amp;<br>next line<p>Second
one</p><div class="share">Share me</div><ul><li>item one<li>item two</ul><form><p>Search</p><input type="text"></form><blockquote>Quote</blockquote>
<table><tr><td>cell a<td>cell b<tr><td>cell c</table><div hidden>secret</div><section class="comments"><p>I disagree</p></section></article>
<footer>&copy; me</footer></body></html>"""
WANT = "The title\nFirst bold and <x> &amp; next line\nSecond one\nitem one\nitem two\nQuote\ncell a\ncell b\ncell c"


def test_article_without_the_rest():
    assert wrapper.extract(PAGE) == WANT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain &eacute;", "plain é"), ("<p>a<p>b", "a\nb"), ("</p></div>x", "x"), ("<p>a <!-- b", "a"),
        ("<p>a<script>b", "a"), ("a < b and c > d", "a < b and c > d"), ("<p>1 &lt 2 &#x41;&#66;", "1 < 2 AB"), ("<body><nav>m</nav><p>t</p>", "t"),
        ("<p title='a>b'>c", "c"), ("<main><p>m</p></main><p>out", "m"), ("<div class='sidebar'><article>no</article></div><p>yes", "yes"),
        ("<article><p>x</article><article><p>y</article>", "x\ny"), ("<b>" * 300 + "deep", "deep"), ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
    ],
)
def test_odd_markup(page, text):
    assert wrapper.extract(page) == text


def test_matching_finds_the_most_nodes():
    def tree(text):
        label, rest = text[0], text[1:]
        children, depth, start = [], 0, 0
        for k, c in enumerate(rest):
            depth += {"(": 1, ")": -1}.get(c, 0)
            if depth == 1 and c == "(":
                start = k
            if depth == 0:
                children.append(tree(rest[start + 1 : k]))
        return [label, 0, children]

    for one, two, most in (("a", "b", 0), ("a(b)(c)", "a(c)(b)", 2), ("a(b(d))(c)(b(e))", "a(b(d)(e))(b(e))", 5), ("a(b)(b)(b)", "a(b)", 2)):
        number, pairs = wrapper.matching(tree(one), tree(two))
        assert number == len(pairs) == most and all(x[0] == y[0] for x, y in pairs)


def test_constant_nodes_are_template(spark):
    """A line that all pages of a host repeat, in a place without a name, is template; other hosts keep it."""
    body = "<body><div><p>Welcome to our site</p></div><div><h2>News {0}</h2><p>Story {0} is here</p></div><div><span>All rights</span></div></body>"
    rows = [(i, f"https://a.example.com/{i}", body.format(i)) for i in range(8)] + [(20, "https://b.example.com/", body.format(20))]
    rows += [(30, "https://a.example.com/x", "<p>Welcome to our site</p>"), (31, None, "<p>no host"), (32, "https://a.example.com/y", None), (None, "not a url", "<p>t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "template", "constants", "text", "skeleton", "node")})
    found = {r["page_id"]: r for r in wrapper.main_texts(pages).collect()}
    for i in range(8):
        assert found[i]["text"] == f"News {i}\nStory {i} is here"
    assert found[20]["text"] == "Welcome to our site\nNews 20\nStory 20 is here\nAll rights"
    assert found[31]["text"] == "no host" and found[32]["text"] == "" and found[32]["n_chars"] == 0 and found[None]["text"] == "t"


def test_whole_table_equals_the_planted_article(spark, small):
    rows = wrapper.op1_wrapper_text(spark, small).join(spark.read.parquet(f"{small}/pages.parquet"), ["page_id", "url"]).collect()
    assert len(rows) == spark.read.parquet(f"{small}/pages.parquet").count()
    for r in rows:
        article = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_empty_table(spark):
    assert wrapper.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def _texts(spark, bodies):
    rows = [(i, f"https://a.example.com/{i}", b) for i, b in enumerate(bodies)]
    found = wrapper.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["page_id"])]


def test_copies_of_a_page_are_no_template(spark):
    """Repeated rows, and copies whose menu differs, on a host of their own and beside other pages."""
    page = "<body><nav>menu {}</nav><article><h1>Title</h1><p>The story</p></article></body>"
    assert _texts(spark, [page] * 6) == ["Title\nThe story"] * 6
    assert _texts(spark, [page.format(i) for i in range(6)]) == ["Title\nThe story"] * 6
    other = "<body><nav>menu</nav><article><h1>Other</h1><p>Second</p></article></body>"
    assert _texts(spark, [page] * 9 + [other]) == ["Title\nThe story"] * 9 + ["Other\nSecond"]


def test_a_constant_sibling_is_template(spark):
    """A line that follows the story's own paragraphs, of their label."""
    page = "<body><article><h1>News {0}</h1><p>Story {0}</p><p>More of {0}</p><p>Follow us everywhere</p></article></body>"
    assert _texts(spark, [page.format(i) for i in range(8)]) == [f"News {i}\nStory {i}\nMore of {i}" for i in range(8)]


def test_every_layout_has_its_template(spark):
    one = "<body><div class='one'><span>Welcome to part one</span><h2>News {0}</h2></div></body>"
    two = "<body><div class='two'><i>Part two greets you</i><h2>Report {0}</h2><p>Text {0}</p></div></body>"
    texts = _texts(spark, [(one, two)[i % 2].format(i) for i in range(16)])
    assert texts == [(f"News {i}", f"Report {i}\nText {i}")[i % 2] for i in range(16)]


@pytest.mark.parametrize("tag", ["div", "b", "ul><li"])
@pytest.mark.parametrize("closed", [True, False])
def test_deeply_nested_pages(spark, tag, closed):
    """100,000 levels, on a table as well; the text comes out, and what follows is read as usual."""
    names = tag.split("><")
    page = f"<body><main>first{f'<{tag}>' * (100_000 // len(names))}deep{''.join(f'</{t}>' for t in reversed(names)) * (100_000 // len(names)) if closed else ''}<p>last</p></main></body>"
    start = time.time()
    assert "".join(wrapper.extract(page).split()) == "firstdeeplast"
    shape = wrapper.Shape("", [wrapper.parse(page)]).skeleton()
    assert wrapper.matching(shape, json.loads(json.dumps(shape)))[0] == len(wrapper.numbered(shape))
    assert time.time() - start < 20
    pages = spark.createDataFrame([(k, f"http://a/{k}", page.replace("last", f"last {k}")) for k in range(5)], "page_id long, url string, html string")
    # What all pages say is their template, but at the deepest level texts are one.
    assert all("".join(r["text"].split()).endswith(f"last{r['page_id']}") for r in wrapper.main_texts(pages).collect())


def test_elements_beyond_the_deepest_level_end_where_they_end():
    page = "<main>" + "<div>" * 300 + "in" + "</div>" * 300 + "<nav>menu</nav><p>after</p></main>"
    assert wrapper.extract(page) == "in\nafter"


def test_many_siblings_take_little_time():
    def page(n, more=""):
        return "<body><main>" + more + "".join(f"<h2>t{k}</h2><p>x{k}</p>" for k in range(n)) + "</main></body>"

    shapes = [wrapper.Shape("", [wrapper.parse(page(n, more))]).skeleton() for n, more in ((5000, ""), (5000, ""), (4900, "<ul><li>a</li></ul>"), (5000, "".join(f"<i{k % 7}>z</i{k % 7}>" for k in range(3000))))]
    for other in shapes[1:]:
        start = time.time()
        score, pairs = wrapper.matching(shapes[0], other)
        assert time.time() - start < 1 and score == len(pairs) > 9000
        assert all(x[0] == y[0] for x, y in pairs) and len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == score


def test_matching_has_one_rule_for_short_and_long_lists(monkeypatch):
    """The most pairs, as a plain table over all siblings has them, whether the lists are compared one by one or by line."""
    dice = random.Random(7)
    leaves = [["p", [0], []], ["p", [0], [["a", [0], []]]], ["h2", [0], []], ["ul", [0], [["li", [0], []], ["p", [0], []]]], ["ul", [0], [["li", [0], []]]]]

    def most(one, two):
        if one[0] != two[0]:
            return 0
        best = [[0] * (len(two[2]) + 1) for _ in range(len(one[2]) + 1)]
        for i, x in enumerate(one[2], 1):
            for j, y in enumerate(two[2], 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + most(x, y))
        return best[-1][-1] + 1

    for long in (3, 12, 70, 90):
        one, two = (["main", [0], [json.loads(json.dumps(dice.choice(leaves))) for _ in range(long + k)]] for k in (0, 5))
        found = []
        for cells in (0, 1 << 30):
            monkeypatch.setattr(wrapper, "CELLS", cells)
            score, pairs = wrapper.matching(one, two)
            assert score == len(pairs) == most(one, two) and all(x[0] == y[0] for x, y in pairs)
            found.append({(id(x), id(y)) for x, y in pairs})
        assert found[0] == found[1]


@pytest.mark.parametrize(
    "page",
    [
        '<body><div class="content no-sidebar"><article><p>the text</p></article></div></body>',
        '<body><div id="page" class="has-sidebar"><main><p>the text</p></main></div></body>',
        "<body><form action='/'><article><p>the text</p></article></form></body>",
        '<body><main><p title="a hidden gem">the text</p></main></body>',
        '<body><main><p><a title="the hidden truth">the text</a></p><p hidden>no</p><p style="display : none">no</p><p aria-hidden=true>no</p></main></body>',
    ],
)
def test_the_article_is_found(page):
    assert wrapper.extract(page) == "the text"
