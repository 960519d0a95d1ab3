import html
import re
import time

import pyarrow as pa
import pytest

from souk.llm import extraction as X
from souk.llm.common import by_bytes

SCHEMA = "page_id long, url string, html string"

LONG = "This sentence is long enough, with a comma or two, to be the text of an article. "


def page(article, before="", after="", head="<title>t</title><style>p{}</style><script>var a='<p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{before}{article}{after}</body></html>"


def extract(spark, rows):
    return {r.page_id: r.text for r in X.extract(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as host", "'x' as path")).collect()}


def test_tables_template(spark, sf_dir):
    """The test pages keep their article in one element."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = X.op2_html_extraction(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        m = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)
        blocks = re.split(r"</?(?:p|h1|li|ul)>", m[1] if m else "")
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


JUNK = (
    '<header><div class="logo">Site</div></header><nav><ul><li><a href="/">Home</a></li></ul></nav>'
    '<div class="cookie-notice"><p>We use cookies, accept them, please, now.</p></div><div class="ad">Buy this, and that, and more.</div>'
)
TAIL = (
    '<aside class="sidebar"><p>Other things, to read, here.</p></aside><div id="comments"><p>' + LONG * 3 + "</p></div>"
    '<form><label>Mail</label><input name="x"><button>Go</button></form><footer><p>&copy; someone</p></footer>'
)


@pytest.mark.parametrize("outer", ["article", "main", 'div class="post-content"', 'div id="content"', "section", "div"])
def test_article_without_the_rest(spark, outer):
    tag = outer.split()[0]
    rows, want = [], {}
    for k in range(6):
        body = f"<h1>Title {k}</h1><p>{LONG * (k + 1)}<p>a &amp; b\n  &lt;c&gt;<br>d<ul><li>one</li><li>two <b>bold</b></li></ul><script>x()</script>"
        rows.append((k, f"http://h.example/{k}", page(f"<{outer}>{body}</{tag}>", JUNK, TAIL)))
        want[k] = f"Title {k}\n{(LONG * (k + 1)).strip()}\na & b <c> d\none\ntwo bold"
    assert extract(spark, rows) == want


def test_host_consensus_settles_a_short_page(spark):
    good = [(k, f"http://one.example/{k}", page(f'<div class="story x{k}">' f"<p>{LONG * 4}</p></div>", f'<div class="box"><p>{LONG}</p></div>')) for k in range(8)]
    short = (99, "http://one.example/99", page('<div class="story x99"><p>Short news.</p></div>', f'<div class="box"><p>{LONG}</p></div>'))
    got = extract(spark, [*good, short])
    assert got[99] == "Short news."
    assert got[3] == (LONG * 4).strip()
    # alone, the page would give its longer box
    assert extract(spark, [(1, "http://two.example/1", short[2])])[1] == LONG.strip()


def test_odd_pages(spark):
    rows = [
        (1, None, None),
        (2, "", ""),
        (3, "not a url", "plain text & more"),
        (4, "http://x.example/", "<p>unclosed <b>bold <p>next &am <!-- never closed"),
        (5, "http://x.example/", "<article><p>cut in the ta"),
        (6, "http://x.example/", "<html><body><nav>only a menu</nav></body></html>"),
        (7, "http://x.example/", "<article><p>cut tag <a href="),
        (None, "http://x.example/", "<article><p>no id</p></article>"),
        (8, "http://x.example/", "<article><p>" + "word " * 200_000 + "</p></article>"),
        (9, "http://x.example/", "<div>" * 3000 + "deep" + "</div>" * 3000),
    ]
    got = extract(spark, rows + [rows[0]])
    assert (got[1], got[2], got[6]) == (None if got[1] is None else "", "", "")
    assert got[3] == "plain text & more"
    assert got[4].split("\n") == ["unclosed bold", "next &am"]
    assert got[5] == "cut in the ta" and got[7] == "cut tag" and got[None] == "no id"
    assert got[8] == ("word " * 200_000).strip() and got[9] == "deep"
    assert X.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shuffled_winners_give_the_same(spark, sf_dir, monkeypatch):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    one = {r.page_id: r.text for r in X.extract(pages).collect()}
    monkeypatch.setattr(X, "BROADCAST_HOSTS", 0)
    assert one == {r.page_id: r.text for r in X.extract(pages).collect()}


def test_paths_are_generalised():
    p = X.parse(page('<div class="b a2 post-17"><section><p>x</p></section></div>'))
    assert "body/div.a#.b.post-#/section" in {e.path for e in p.elements}


def test_long_and_deep_pages_take_linear_time():
    """100,000 nested tags of each kind, and a page of a megabyte of cut tags."""
    begin = time.perf_counter()
    for tag in ("div", "ul", "blockquote", 'section class="a b"'):
        name = tag.split()[0]
        deep = X.parse(f"<{tag}>" * 100_000 + "deep, and down" + f"</{name}>" * 100_000)
        assert X.text_on(deep, None) == "deep, and down"
        each = X.parse("".join(f"<{tag}>word {k}, " for k in range(20_000)))
        assert len(X.text_on(each, None)) > 10
    for cut in ("a <b ", "<![CDATA[ ", "<!-", "<script", "<a href='x", '<a href="x'):
        X.text_on(X.parse(cut * (1_000_000 // len(cut))), None)
        X.text_on(X.parse(cut * (1_000_000 // len(cut)) + "> the end"), None)
    assert time.perf_counter() - begin < 60


def test_formulas_stay():
    text = X.text_on(X.parse("<article><p>Let <math><mi>x</mi></math> be 5, and <xmp>y</xmp>.</p></article>"), None)
    assert text == "Let x be 5, and y."


def test_slices_by_bytes():
    texts = ["x" * n for n in (10, 0, 500, 30, 30, 30, 2000, 1)] + [None] * 3
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    cut = [b.column(1).to_pylist() for b in by_bytes(iter([batch]), 1, 4, 100)]
    assert [t for b in cut for t in b] == texts
    assert all(len(b) == 1 or (len(b) <= 4 and sum(len(t or "") for t in b) <= 100) for b in cut)
    assert list(by_bytes(iter([batch.slice(0, 0)]), 1, 4)) == []
