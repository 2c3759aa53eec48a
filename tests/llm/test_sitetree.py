from __future__ import annotations

import re

from loomstream.llm import sitetree as st

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body><header>Site</header><nav><ul><li>Home</li></ul></nav>
<div class="cookie-notice">We use cookies</div><!-- <p>gone</p> --><div class="ad">Buy</div><article><h1>Head &amp; line</h1><p><b>First  &lt;one&gt;
two.<br><p>Second&nbsp;par&#8217;s x &copy; <a href="/a>b">link</a>ed</p><form><input value="q"><label>Name</label></form><aside>Side</aside><ul><li>i1<li>i2</ul></article>
<section id="comments"><p>I disagree</p></section><footer>&copy; me</footer></body></html>"""


def test_page():
    assert st.main_text(PAGE, set()) == "Head & line First <one> two. Second par’s x © linked i1 i2"


def test_edges():
    for html, want in (("", ""), ("plain &amp; text", "plain & text"), ("<p>a<p>b", "a b"), ("<p>a<!-- open", "a"), ("a<script>x", "a"), ("</p></div>x", "x"), ("<p>1 < 2 <b", "1 < 2"), ("<div hidden>x</div><p>y</p>", "y"), ("<main><p>a</p></main><p>b</p>", "a"), ("<p>" * 3000 + "x", "x")):
        assert st.main_text(html, set()) == want, html


def test_host_template_is_dropped(spark, sf_dir):
    rows = [(i, f"http://h.example/{i}", f"<body><div class='box'>Always the same words</div><div class='body'><p>Story {i} of many</p></div></body>", "x") for i in range(30)]
    rows += [(100, "http://one.example/", "<div class='box'>Always the same words</div>", "x"), (101, None, None, "x"), (102, "", "", "x"), (102, "", "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in st.extracted(df).collect()}
    assert all(got[i] == f"Story {i} of many" for i in range(30))
    assert got[100] == "Always the same words" and got[101] == "" and got[102] == ""
    copies = spark.createDataFrame([(i, "http://c.example/", "<article><p>One text</p></article>") for i in range(20)], "page_id long, url string, html string")
    assert {r.text for r in st.extracted(copies).collect()} == {"One text"}
    assert st.extracted(df.limit(0)).count() == 0


def test_table_against_articles(spark, sf_dir):
    from loomstream.llm.queries import op4_site_style_tree

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in op4_site_style_tree(spark, sf_dir).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = [re.sub(r"\s+", " ", st.entities.unescape(p)).strip() for p in re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner))]
        assert r.text == " ".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_join_without_broadcast(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.example/{i}", f"<div class='box'>Same</div><p>Story {i}</p>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(st, "BROADCAST_ROWS", 1)
    assert {r.page_id: r.text for r in st.extracted(df).collect()} == {i: f"Story {i}" for i in range(60)}


def test_repeated_parts_of_articles_stay(spark):
    """Lists and headings stay in copied articles and where a host repeats them in each article; repeated boxes go."""
    copied = "<article><h2>Once</h2><p>One text</p><ul><li>first</li><li>second</li></ul></article>"
    rows = [(i, f"http://c.example/{i}", copied if i < 12 else f"<article><p>Other text {i}</p></article>") for i in range(40)]
    rows += [(100 + i, f"http://r.example/{i}", f"<article><h2>What you need</h2><p>Recipe {i}</p><div class='box'>Join us</div></article>") for i in range(20)]
    plain = "<div class='box'>Same</div><div class='body'><h2>Once</h2><p>One text</p><ul><li>first</li></ul></div>"
    rows += [(200 + i, f"http://p.example/{i}", plain if i < 12 else f"<div class='box'>Same</div><div class='body'><p>Story {i}</p></div>") for i in range(40)]
    got = {r.page_id: r.text for r in st.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == ("Once One text first second" if i < 12 else f"Other text {i}") for i in range(40))
    assert all(got[100 + i] == f"What you need Recipe {i}" for i in range(20))
    assert all(got[200 + i] == ("Once One text first" if i < 12 else f"Story {i}") for i in range(40))


def story(i, n=4):
    return "".join(f"<p>Story {i} line {k} of {i * 7 + k} words</p>" for k in range(n + i % 3))


def neutral(i):
    """A page without any tag or name that tells its parts."""
    menu = "<div class='k1'><div class='k2'>" + "".join(f"<div class='k3'><span>Entry {k}</span></div>" for k in range(5)) + "</div></div>"
    notice = "<div class='k4'><p>This site keeps small files.</p><p>Read more</p></div>" if i % 2 else ""
    foot = f"<div class='k5'><p>Written by the same hands</p><p>{'All rights' if i % 3 else 'No rights'}</p></div>"
    return f"<body>{menu}{notice}<div class='k6'><div class='k7'>{story(i)}</div></div>{foot}</body>"


def test_the_tree_decides_without_names(spark):
    """Menus, notices and footers in neutral tags go by the tree alone; without it they stay."""
    rows = [(i, f"http://n.example/{i}", neutral(i)) for i in range(40)] + [(100 + i, f"http://few.example/{i}", neutral(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    wanted = {i: " ".join(t for _, t in st.page_of(story(i)).text_blocks()) for i in range(40)}
    got = {r.page_id: r.text for r in st.extracted(df).collect()}
    assert all(got[i] == wanted[i] for i in range(40))
    off = {r.page_id: r.text for r in st.extracted(df, st.Params(low=0.0)).collect()}
    assert all(off[i] != wanted[i] and "Entry 3" in off[i] and wanted[i] in off[i] for i in range(40))
    assert all(got[100 + i] == off[100 + i] for i in range(3))  # three pages prove nothing yet


def test_importance_against_plain_entropy(spark):
    """Content and presentation of each node equal entropies that are taken page by page."""
    from collections import Counter, defaultdict
    from math import log

    pages = [neutral(i) for i in range(12)]
    df = spark.createDataFrame([(i, "http://n.example/", h) for i, h in enumerate(pages)], "page_id long, url string, html string")
    got = {r.node: r for r in st.style_tree(st.pages_of(df)).collect()}
    nodes, blocks, layouts = Counter(), defaultdict(lambda: defaultdict(Counter)), defaultdict(Counter)
    for i, h in enumerate(pages):
        page = st.page_of(h)
        for path, children in page.layout.items():
            nodes[path] += 1
            layouts[path][tuple(children)] += 1
        for path, text, _, _ in page.blocks:
            blocks[path][text][i] += 1
    entropy = lambda c: -sum(n / sum(c.values()) * log(n / sum(c.values())) for n in c.values())
    for path, m in nodes.items():
        r = got[st.node_key(path)]
        assert r.m == m and abs(r.presentation - entropy(layouts[path]) / log(m)) < 1e-9
        if blocks[path]:
            assert abs(r.content - (1 - sum(map(entropy, blocks[path].values())) / len(blocks[path]) / log(m))) < 1e-9
    assert len(got) == len(nodes)


def test_wrappers_keep_their_articles():
    for html, want in (
        ("<div class='layout has-sidebar'><article><p>a</p></article></div>", "a"), ("<div id='page' class='no-header'><p>a</p></div>", "a"), ("<div class='sidebar'><article><p>a</p></article>b</div>", "a"),
        ("<main><div class='tags-and-text'><p>a</p></div></main>", "a"), ("<article><p class='alert'>a</p><div class='social'>b</div></article>", "a b"), ("<article><p>a <math><mi>x</mi></math> b</p></article>", "a x b"),
        ("<header>Site</header><article><header><h1>Head</h1></header><p>a</p><footer>by me</footer></article>", "Head a"), ("<article><p>a long text of the page</p><div class='comments'><p>no</p></div></article>", "a long text of the page"),
        ("<div class='ad'>Buy</div><p>a text that is longer</p>", "a text that is longer"), ("<div class='menu'><p>all there is</p></div>", "all there is"),
    ):
        assert st.main_text(html, set()) == want, html


def test_very_long_page_and_hot_host(spark, monkeypatch):
    long = "<body><div class='k1'>Same</div>" + "".join(f"<p>line {i}</p>" for i in range(60_000)) + "</body>"
    rows = [(0, "http://hot.example/", long)] + [(i, "http://hot.example/", f"<body><div class='k1'>Same</div><p>line {i}</p></body>") for i in range(1, 400)]
    monkeypatch.setattr(st, "BROADCAST_ROWS", 0)
    got = {r.page_id: r.text for r in st.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == " ".join(f"line {i}" for i in range(60_000)) and all(got[i] == f"line {i}" for i in range(1, 400))
