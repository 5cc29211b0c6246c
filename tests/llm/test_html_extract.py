import random

import time

import pytest

from riskpanel.llm import html_extract
from tests.llm.tables import CLASHES, rows_of

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two<br>three", "one\ntwo\nthree"),
    ("<article><h1>T</h1><p><b>a b<br><p>c</b> d</p></article><footer>x</footer>", "T\na b\nc d"),
    ("<body><nav>n</nav><div class='ad box'>ad</div><p>text <i>in</i>line</p></body>", "text inline"),
    ("<p>a</p><script>var t='</p>';</script><style>p{}</style><!-- c --><p>b</p>", "a\nb"),
    ("<main><p>m</p><aside>s</aside><form>f<input></form><div id=comments>c</div></main><p>out</p>",
     "m"),
    ("<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>", "x\ny\n1\n2\n3"),
    ("<p>&lt;b&gt; &#233;&eacute; &nbsp; z &copy; &unknown;</p>", "<b> éé z © &unknown;"),
    ("<p>a < b and c <3</p>", "a < b and c <3"), ("<div hidden>no</div><p>yes</p>", "yes"),
    ("<p title=\"a > b\">t</p>", "t"), ("<p>x</div></p></span>y", "x\ny"),
    ("<div role='navigation'>n</div><section class='share-buttons'>s</section>k", "k"),
    ("<script>never closed <p>t</p>", ""), ("<!-- never closed <p>t</p>", ""),
    ("<header>site</header><article><header><h1>T</h1></header>b</article>", "T\nb"),
])
def test_main_text(page, text):
    assert html_extract.main_text(page, set()) == text


def test_deep_and_long_pages():
    assert html_extract.main_text("<div>" * 3000 + "x" + "</div>" * 3000, set()) == "x"
    many = "".join(f"<p>{i}</p>" for i in range(50_000))
    assert html_extract.main_text(many, set()).count("\n") == 49_999


def site(host, n, seed, repeated):
    """Pages with an own story and, in plain elements, the same blocks on every page."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        story = [" ".join(r.choices("abcdefgh", k=30)) for _ in range(r.randrange(2, 6))]
        body = "".join(f"<p>{s}</p>" for s in story)
        out.append((f"http://{host}/{i}",
                    f"<body><div><span>{repeated}</span></div><section>{body}</section>"
                    f"<div class=x><div>All rights kept</div></div></body>", "\n".join(story)))
    return out


def test_repeated_branches_of_a_host_go(spark):
    pages = site("a.example", 30, 1, "Welcome, please log in") + site("B.example", 30, 2, "Hello")
    alone = ("http://c.example/", "<div><span>Hello</span></div><p>story</p>", "Hello\nstory")
    rows = [(i, u, h) for i, (u, h, _) in enumerate([*pages, alone])]
    got = {r["page_id"]: r for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i, (url, _, text) in enumerate([*pages, alone]):
        assert got[i]["text"] == text and got[i]["url"] == url and got[i]["n_chars"] == len(text)


def test_copies_of_an_article_stay(spark):
    page = "<nav>n</nav><article><h1>T</h1><p>same words</p></article>"
    rows = [(i, f"http://a.example/{i}", page) for i in range(40)]
    got = html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()
    assert {r["text"] for r in got} == {"T\nsame words"} and len(got) == 40


def test_importance_is_the_definition(spark):
    # 8 pages; block "x" on all of them, blocks "y<i>" on one each
    rows = [(i, "http://h.example/", f"<div class=a>x</div><div class=b>y{i}</div>"
                                     f"<section><p>z{i % 2}</p></section>") for i in range(8)]
    tree = {r["node"]: r for r in html_extract.style_tree(
        spark.createDataFrame(rows, PAGES)).collect()}

    def node(*path):
        at = 0
        for part in path:
            at = html_extract._hash(f"{at}/{part}")
        return tree[at]

    assert node("div.a")["importance"] == pytest.approx(0)
    assert node("div.b")["importance"] == pytest.approx(1)
    # each of two blocks is on 4 of 8 pages: one less log 4 / log 8
    leaf = 1 - 2 / 3
    assert node("section.", "p.")["importance"] == pytest.approx(leaf)
    # one sequence of child tags: own importance 0, damped
    assert node("section.")["importance"] == pytest.approx(html_extract.DAMPING * leaf)
    assert {r["pages"] for r in tree.values()} == {8}


def test_odd_rows(spark, monkeypatch):
    rows = [(1, None, None), (2, "no url", "<p>a</p>"), (None, "http://h/", "<p>b</p>"),
            (3, "http://h/", ""), (3, "http://h/", "<p>c</p>"), (3, "http://h/", "<p>c</p>"),
            (4, "http://u:p@H:80/x", "<p>d</p>" * 9000)]
    df = spark.createDataFrame(rows, PAGES)
    for i, name in enumerate([*CLASHES, "noise", "text", "n_chars", "noisy"]):
        df = df.selectExpr("*", f"{i} as `{name}`")
    want = sorted(((p, u, html_extract.main_text(h, set())) for p, u, h in rows), key=repr)
    for small in (html_extract.SMALL_TABLE, -1):
        monkeypatch.setattr(html_extract, "SMALL_TABLE", small)
        got = html_extract.extract(df).collect()
        assert sorted(((r["page_id"], r["url"], r["text"]) for r in got), key=repr) == want
    empty = spark.createDataFrame([], PAGES)
    assert rows_of(html_extract.extract(empty)) == []


@pytest.mark.parametrize("attributes, kept", [
    ("class='overflow-hidden'", True), ("style='overflow:hidden'", True),
    ("title=\"the hidden valley\"", True), ("aria-hidden=false", True),
    ("hidden", False), ("id=a HIDDEN class=b", False), ("hidden=''", False),
    ("hidden='hidden'", False)])
def test_hidden_is_an_attribute(attributes, kept):
    text = html_extract.main_text(f"<div {attributes}><p>x</p></div><p>y</p>", set())
    assert text == ("x\ny" if kept else "y")


@pytest.mark.parametrize("page", ["<b" * 50_000, "<b" * 50_000 + "<!-- x", "<b " * 30_000 + ">",
                                  "<p>x</p>" + "<b" * 50_000])
def test_tags_without_an_end_take_no_time(page):
    start = time.perf_counter()
    html_extract.walked(page)
    assert time.perf_counter() - start < 2


@pytest.mark.parametrize("wrapper", ["has-sidebar", "no-comments", "share-enabled", "with_nav"])
def test_names_of_states_are_no_noise(wrapper):
    blocks, _ = html_extract.walked(f'<div class="page {wrapper}"><p>Real story text</p></div>')
    assert [(text, any(n.noise for n in nodes)) for text, nodes in blocks] == [
        ("Real story text", False)]
    blocks, _ = html_extract.walked('<div class="sidebar"><p>Links</p></div>')
    assert blocks[0][1][-1].noise
