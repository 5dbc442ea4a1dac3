"""Main text of pages, and the wrappers that give it."""

import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from kerbside.llm import html_wrappers as W
from kerbside.llm.catalog import QUERIES
from llm_tables import CLASH

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{x}}</style><script>var a = "<p>no</p>";</script></head>
<body><header class="site-header"><a href="/">Logo</a><h2>Site name</h2></header>
<nav><ul><li><a>Home</a></li><li><a>News {n}</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Title &amp; {n}</h1><!-- c --><p>First   <b>para</b>graph&nbsp;{n}.<p>Second &lt;one&gt; of {n}<br>same block</p>{more}
<div class="ad-box">Buy {n} now</div><aside>Side {n}</aside><ul><li>item a{n}<li>item b</ul>
<form><label>Mail</label><button>Go</button></form><section class="comments"><p>Nice {n}!</p></section></article>
<div id="sidebar-1"><p>Related {n}</p></div><footer>&copy; 2024 {n}</footer></body></html>"""


def page(n):
    return PAGE.format(n=n, more="".join(f"<p>More {k} of {n}</p>" for k in range(n % 4)))


def wanted(n):
    return "\n".join([f"Title & {n}", f"First paragraph {n}.", f"Second <one> of {n} same block",
                      *[f"More {k} of {n}" for k in range(n % 4)], f"item a{n}", "item b"])


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in CLASH + ["host", "wrapper", "h", "text", "n_chars"] if clash else []:
        df = df.withColumn(c, F.lit("x"))
    return df


def test_pages_of_hosts(spark):
    rows = [(n, f"http://h{n % 3}.example.com/a/{n}", page(n)) for n in range(60)]
    rows += [(100, "http://h0.example.com/x", None), (101, None, page(1)), (102, "::odd::", ""),
             (103, "http://h0.example.com/y", "plain & simple   text"), (104, "http://h1.example.com", "<p>" + "w " * 60000),
             (0, "http://h0.example.com/a/0", page(0)), (None, "http://new.example.com/", page(7))]
    got = W.main_text(frame(spark, rows, clash=True)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] is not None and r["page_id"] < 60:
            assert r["text"] == wanted(r["page_id"])
        assert r["n_chars"] == len(r["text"])
    by = {r["page_id"]: r["text"] for r in got}
    assert by[100] == by[102] == "" and by[101] == wanted(1) and by[None] == wanted(7)
    assert by[103] == "plain & simple text" and by[104] == ("w " * 60000).strip()
    assert W.main_text(frame(spark, [])).count() == 0


def test_wrapper_is_a_union_free_expression():
    pages = [f"<body><ul><li>Home</li><li>{n}</li></ul>{'<h2>extra</h2>' if n == 2 else ''}"
             f"<div class=main>{'<p>t%d</p>' % n * n}</div></body>" for n in (1, 2, 3, 4)]
    found = W.expression(W.infer(pages))
    assert found == "<body><ul>(<li>#</li>)+</ul>(<h2>)?(extra)?(</h2>)?<div.main>(<p>#</p>)+</div></body>"


def test_region_without_article_element():
    pages = [f"<body><div class=top-menu><p>Menu</p></div><div id=x1><h1>Head {n}</h1><p>Long text number {n} of the page</p></div>"
             f"<div class=footer><p>foot {n}</p></div></body>" for n in range(5)]
    nodes = W.infer(pages)
    wrapper = W.Wrapper.from_json(W.mark(nodes).to_json(nodes))
    assert W.extract(pages[3], wrapper) == "Head 3\nLong text number 3 of the page"


@pytest.mark.parametrize("bad", ["<", "<p", "<p class='x>a", "</p></p>a", "<script>x", "<!-- x", "&#xZZ; &bogus; &amp",
                                 "<div><p>a</div>b", "<table><tr><td>1<td>2<tr><td>3</table>", "<a href='>'>x</a>"])
def test_broken_pages(bad):
    assert isinstance(W.extract(bad, W.Wrapper.from_json(None)), str)


def test_article_text_of_the_table(spark):
    sf = "/root/testdata/sf0.001"
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op5_main_text"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(b for b in blocks if b)


def test_template_without_region_is_told_over_all_pages(spark):
    one = "<body><h1>Title</h1><p>a</p><p>b</p></body>"
    rows = [(1, "http://one.example.com/", one), (2, "http://copies.example.com/1", one), (3, "http://copies.example.com/2", one)]
    # a heading that a few pages have otherwise, and a line that all pages have
    rows += [(n, f"http://mixed.example.com/{n}", f"<body><h2>{'Other %d' % n if n > 297 else 'Common'}</h2><h4>Line</h4>"
              f"<p>text {n}</p><p>more {n}</p></body>") for n in range(100, 300)]
    got = {r["page_id"]: r["text"] for r in W.main_text(frame(spark, rows)).collect()}
    assert got[1] == got[2] == got[3] == "Title\na\nb"
    assert all(got[n] == f"{'Other %d' % n if n > 297 else 'Common'}\ntext {n}\nmore {n}" for n in range(100, 300))


def test_wrapper_tells_the_region_by_what_varies(spark):
    """One region holds a long text that all pages of the host repeat, the other a short one of each page's own."""
    pages = [f"<body><div class=content><p>{'Who we are and what we do. ' * 20}</p></div>"
             f"<div class=entry><h1>Head {n}</h1><p>Own text of page {n}</p></div></body>" for n in range(6)]
    wrapper = W.mark(W.infer(pages))
    assert wrapper.main[-1] == "div.entry"
    assert all(W.extract(p, wrapper) == f"Head {n}\nOwn text of page {n}" for n, p in enumerate(pages))
    assert W.extract(pages[3], W.Wrapper(())).startswith("Who we are")  # without the host's wrapper
    rows = [(n, f"http://h.example.com/{n}", p) for n, p in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in W.main_text(frame(spark, rows)).collect()}
    assert got == {n: f"Head {n}\nOwn text of page {n}" for n in range(6)}
    # copies of one page tell nothing about what is template
    assert W.mark(W.infer(pages[:1] * 5)).main[-1] == "div.content"


def test_article_keeps_sections_whose_marks_are_plain_words():
    page = ("<body><article><h1>T</h1><section id=discussion><p>kept 1</p></section><section class='search-methods'><p>kept 2</p>"
            "</section><div class='alert-systems related'><p>kept 3</p></div><div class='ad-box'><p>gone</p></div>"
            "<div class='post-comments'><p>gone</p></div><section id=comments><p>gone</p></section><div class=cookie-notice>gone</div>"
            "<nav><p>gone</p></nav><p hidden>gone</p><div class=sidebar-2>gone</div></article></body>")
    assert W.extract(page, W.mark(W.infer([page]))) == "T\nkept 1\nkept 2\nkept 3"


def naive_end(page, at):
    """The end of a tag by going through it from ``at``."""
    place, quote = at, ""
    while place < len(page):
        c = page[place]
        if quote:
            quote = "" if c == quote else quote
        elif c == ">":
            return place
        elif c in "\"'":
            quote = c
        place += 1
    return page.find(">", at)


def test_tag_ends_equal_those_of_a_plain_scan():
    rng = random.Random(3)
    for _ in range(3000):
        page = "".join(rng.choice("<a>\"' ") for _ in range(rng.randint(0, 40)))
        ends = W.TagEnds(page)
        places = sorted(rng.randrange(len(page) + 1) for _ in range(6))
        assert [ends.find(at) for at in places] == [naive_end(page, at) for at in places], page


def test_folding_and_matching_keep_every_token():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ([rng.choice("xyzuvw") for _ in range(rng.randint(0, 30))] for _ in range(2))
        spans = list(W.matched(a, b))
        assert [x for a0, a1, *_ in spans for x in a[a0:a1]] == a and [x for _, _, b0, b1, _ in spans for x in b[b0:b1]] == b
        assert all(a[a0:a1] == b[b0:b1] for a0, a1, b0, b1, same in spans if same)


@pytest.mark.parametrize("limit", [0, 40_000])
def test_matching_by_anchors_alone(monkeypatch, limit):
    monkeypatch.setattr(W, "GAP_PAIRS", limit)
    a, b = list("abcdxxefgh"), list("abqcdyefhg")
    spans = list(W.matched(a, b))
    assert [x for a0, a1, *_ in spans for x in a[a0:a1]] == a and [x for _, _, b0, b1, _ in spans for x in b[b0:b1]] == b
    assert sum(a1 - a0 for a0, a1, _, _, same in spans if same) == 7


@pytest.mark.parametrize("piece", ["<a ", "<", "<x <a \">\"", "<a \"", "<div>a", "<script ", "<a '", "<li>", "<dd><p>", "a='", "<!"])
def test_time_grows_with_the_page(piece):
    def seconds(size):
        page = "<p " + piece * (size // len(piece)) + ">x" if piece == "a='" else piece * (size // len(piece))
        start = time.perf_counter()
        W.extract(page, W.mark(W.infer([page, page + "<p>end"])))
        return time.perf_counter() - start

    seconds(2000)
    # sixteen times the length: quadratic work would take 256 times as long
    assert seconds(160_000) < 80 * max(seconds(10_000), 0.01)


def test_text_below_the_deepest_path_stays():
    deep = W.MOST_DEPTH + 50
    page = "<body><article>" + "".join(f"<div>{k}" for k in range(deep)) + "</div>" * deep + "<p>end</p></article><footer>gone</footer></body>"
    assert W.extract(page, W.mark(W.infer([page]))) == "\n".join([*map(str, range(deep)), "end"])


def mixed_page(rng, n):
    """A page of a host without a common layout; labels may occur on it alone."""
    parts = []
    for _ in range(rng.randint(0, 25)):
        name, own = rng.choice(["p", "h2", "div", "ul"]), rng.choice(["", " class=x", f" id={''.join(rng.choices('abcdef', k=7))}"])
        inner = "".join(f"<li>{rng.randint(0, 9)}" for _ in range(rng.randint(1, 4))) if name == "ul" else f"text {rng.randint(0, 30)}"
        parts.append(f"<{name}{own}>{inner}</{name}>")
    head = rng.choice(["<div class=content><p>About us</p></div>", ""])
    return f"<body>{head}<div class={rng.choice(['entry', 'post', 'story'])}>{''.join(parts)}</div><footer>{n}</footer></body>"


def test_wrappers_are_fitted_on_all_pages(spark):
    """Three of 300 pages have the plainest element for an article; the host's other pages do not tell of it."""
    few = (17, 120, 233)
    rows = [(n, f"http://h.example.com/{n}", f"<body><div class=content><p>Teaser {n}</p></div>"
             + (f"<main><h1>Head {n}</h1><p>Long read {n}</p></main>" if n in few else "") + "</body>") for n in range(300)]
    got = {r["page_id"]: r["text"] for r in W.main_text(frame(spark, rows)).collect()}
    assert got == {n: f"Head {n}\nLong read {n}" if n in few else f"Teaser {n}" for n in range(300)}


@pytest.mark.parametrize("part_chars, fan", [(1 << 20, 8), (2000, 2), (1, 3)])
def test_parts_of_a_host_give_its_region(spark, part_chars, fan):
    """Hosts of many parts, of copies and of one page: their regions are those of all their pages at once."""
    rng = random.Random(11)
    hosts = {"own": [f"<body><div class=content><p>{'Who we are and what we do. ' * 20}</p></div>"
                     f"<div class=entry><h1>Head {n}</h1><p>Own text of page {n}</p></div></body>" for n in range(100)],
             "copies": ["<body><div class=content><p>short</p></div><div class=entry><p>longer text</p></div></body>"] * 50
                       + ["<body><div class=content><p>a text longer than both</p></div></body>"],
             "one": [mixed_page(rng, 1)], "plain": ["<p>a</p>", "<p>b</p>"]}
    rows = [(n, f"http://{h}/{n}", p) for h, pages in hosts.items() for n, p in enumerate(pages)] + [(1, "http://null/", None)]
    got = {r["host"]: W.Wrapper.from_json(r["wrapper"]).main
           for r in W.infer_wrappers(frame(spark, rows), part_chars, fan).collect()}
    assert got == {h: W.mark(W.infer(pages)).main for h, pages in hosts.items()}
    assert [got[h][-1:] for h in ("own", "copies", "plain")] == [("div.entry",), ("div.content",), ()]


def test_wide_wrappers_become_general_and_lose_no_text(monkeypatch):
    monkeypatch.setattr(W, "MOST_NODES", 150)
    rng = random.Random(4)
    pages = [mixed_page(rng, n) for n in range(400)]
    want = {}
    for page in dict.fromkeys(pages):
        for kind, value in W.blocks(page):
            if kind == "text" and W.region_of(value[0]):
                want[W.region_of(value[0])] = want.get(W.region_of(value[0]), 0) + len(value[1])
    whole = W.infer(pages)
    assert W.width(whole) < 600
    parts = [W.infer(pages[k:k + 50]) for k in range(0, 400, 50)]
    tallies = [W.settled(nodes, False) for nodes in parts]
    last = W.united(W.unpacked(W.packed(nodes)) for nodes in parts)
    assert W.width(last) < 600
    for many in [[W.settled(whole, True)], [*tallies, W.settled(last, True)]]:
        got = {}
        for tally in many:
            for place, (varied, chars) in tally.items():
                assert 0 <= varied <= chars
                got[place] = got.get(place, 0) + chars
        assert {p: c for p, c in got.items() if c} == want


def test_wrappers_survive_packing():
    rng = random.Random(9)
    nodes = W.infer([mixed_page(rng, n) for n in range(12)] + ["<body><p>\u2028 &#0; \U0001f600 \"q\"</p></body>"])
    assert W.unpacked(W.packed(nodes)) == [without_form(n) for n in nodes]


def without_form(n):
    return W.Node(n.kind, n.value, n.places, [without_form(x) for x in n.body], n.page)
