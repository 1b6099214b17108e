"""Url filters against brute force, and html extraction on pages whose article is known."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerloom.llm import html_extract as H
from ledgerloom.llm import url_filter as U
from ledgerloom.llm.common import Scratch


def brute_parts(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:].split("#")[0]
    return host, rest.split("?")[0], host + rest if host else None


def brute_rule(host, path, rules):
    fits = [(len(h + p), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_url_verdicts_against_brute_force(spark):
    rng = random.Random(2)
    hosts = ["a.com", "www.example.com", "example.com", "x.example.com", "b.net", "net", "fr.org", "K.Example.ORG"]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/1', '/es/2', '/fr/', '?q=1', '/en/3?x=1#y'])}" for _ in range(120)]
    urls += [None, "", "no scheme", "://", "http://", "HTTP://WWW.EXAMPLE.COM/EN/", "a://b://c.net/es/", "http://é.net/es/x\ny"]
    pages = list(enumerate(urls))
    edges = [(rng.choice(urls), rng.choice(urls)) for _ in range(30)] + [("http://fr.org/", "http://never.seen.net/es/9"), ("http://fr.org/", "http://fr.org/"), (None, "http://a.com")]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = brute_parts(a)[2], brute_parts(b)[2]
        if a and b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    blocked = {find(x) for x in list(root) if brute_rule(*brute_parts("x://" + x)[:2], U.RULES)[1] == "block"}
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("rule", F.lit(1))
    out = U.verdicts(spark, df, spark.createDataFrame(edges, "src string, dst string"), U.rule_table(spark, U.RULES)).collect()
    assert len(out) == len(pages)
    for r in out:
        host, path, address = brute_parts(urls[r.page_id])
        rule, action = brute_rule(host, path, U.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule), urls[r.page_id]
        assert r.verdict == (action or ("block" if address in root and find(address) in blocked else "allow"))


def test_edges_of_pages(spark):
    rows = [
        ("http://A.com/x/y", '<LINK href="/z?a=1&amp;b=2" rel="canonical">'),
        ("http://a.com/x/y", "<link rel=canonical href=w>"),
        ("http://a.com", "<link rel='canonical' href='//b.net/q'><meta http-equiv=\"refresh\" content=\"0; url='https://c.org/'\">"),
        ("http://a.com", '<link rel="canonical" href="mailto:x">'),
        (None, '<link rel="canonical" href="http://q">'),
        ("http://a.com", None),
    ]
    got = {(r.src, r.dst) for r in U.page_edges(spark.createDataFrame(rows, "url string, html string")).collect()}
    assert got == {("http://A.com/x/y", "x://a.com/z?a=1&b=2"), ("http://a.com/x/y", "x://a.com/x/w"), ("http://a.com", "x://b.net/q"), ("http://a.com", "https://c.org/")}
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.verdicts(spark, empty, U.page_edges(empty), U.rule_table(spark, [])).count() == 0


PARTS = {
    "nav": "<nav><ul><li><a href=/{0}>menu {0}</a></ul></nav>",
    "ad": '<!-- x --><div class="top-ad">buy {0}</div>',
    "notice": '<div id="cookieNotice"><p>we use cookies</p></div>',
    "side": "<aside>side {0}</aside>",
    "form": "<form>sign up <input name=q><button>go</button></form>",
    "script": "<script>var t='</p><article>';</script><style>p{{}}</style>",
    "comments": '<section class="comments"><article class="comment"><p>reader {0}</p></article></section>',
    "footer": "<footer>&copy; {0}</footer>",
}
BODY = "<h1>T &amp; {0}</h1><p>One <b>bold{0}</b>word<p>two&nbsp; &lt;three{0}&gt;<br>four{0}<ul><li>a{0}<li>b{0}</ul><table><tr><td>c{0}<td>d{0}</table>"
TEXT = "T & {0} One bold{0}word two <three{0}> four{0} a{0} b{0} c{0} d{0}"


def layout(wrap, i):
    p = {k: v.format(i) for k, v in PARTS.items()}
    return f'<!DOCTYPE html><html><head><title>title {i}</title>{p["script"]}</head><body><header><p>site</p></header>{p["nav"]}{p["notice"]}<div class="wrap">{p["side"]}{p["ad"]}{wrap.format(BODY.format(i) + p["form"])}{p["comments"]}</div>{p["footer"]}</body></html>'


def test_extraction_of_known_pages(spark):
    layouts = {"one": "<article>{0}</article>", "two": "<main><div>{0}</div></main>", "three": '<div class="post-body">{0}</div>', "four": '<div class="k7">{0}</div>'}
    rows = [(i, f"http://{host}.org/{i}", layout(wrap, i)) for n, (host, wrap) in enumerate(layouts.items()) for i in range(10 * n, 10 * n + 8)]
    rows += [(90, "http://e.org/", None), (91, None, "<p>x <i>y</i>"), (92, "http://e.org/", ""), (93, "http://e.org/", "plain < text &eacute;"), (0, "http://one.org/0", rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("tokens", F.lit(1)).repartition(4)
    got = H.extract(spark, pages).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = {90: "", 91: "x y", 92: "", 93: "plain < text é"}.get(r.page_id, TEXT.format(r.page_id))
        assert (r.text, r.n_chars) == (expected, len(expected)), r.page_id
    same = [(i, f"http://h.org/{i}", f"<article><p>same words<p>own {i}</article>") for i in range(6)]
    kept = H.extract(spark, spark.createDataFrame(same, "page_id long, url string, html string")).collect()
    assert {r.text for r in kept} == {f"same words own {i}" for i in range(6)}  # nothing of a marked article is dropped
    assert H.extract(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(spark, pages):
    rows = [(i, f"http://h.org/{i}", page) for i, page in enumerate(pages)]
    out = H.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    return [r.text for r in sorted(out, key=lambda r: r.page_id)]


def test_template_marks_boilerplate_inside_an_article(spark):
    page = '<body><article><h2>Summary</h2><p>own {0}</p><div class="k9"><p>Buy <b>now</b></p></div><section><p>As seen on</p><p>every page</p></section><div>more {0}</div><div>Result</div><p>end {0}</p></article></body>'
    assert texts_of(spark, [page.format(i) for i in range(6)]) == [f"Summary own {i} more {i} Result end {i}" for i in range(6)]
    # No template, or nothing beside it: the article stays.
    assert texts_of(spark, [page.format(1)]) == ["Summary own 1 Buy now As seen on every page more 1 Result end 1"]
    alike = '<body><article><div class="k9"><p>All the same</p></div></article><footer>{0}</footer></body>'
    assert texts_of(spark, [alike.format(i) for i in range(6)]) == ["All the same"] * 6


def test_all_articles_of_a_page_stay_but_teasers(spark):
    page = '<body><article><h1>Story {0}</h1><p>part one {0} is the longest</p></article><article><p>part two {0}</p></article><article><h3><a href=/{0}>Other {0}</a></h3><p>short summary {0}</p></article><article><a href=/x>more of {0}</a> it</article><article><p>Subscribe today</p></article></body>'
    assert texts_of(spark, [page.format(i) for i in range(6)]) == [f"Story {i} part one {i} is the longest part two {i}" for i in range(6)]
    index = "<article><h2><a href=/{0}>First {0}</a></h2><p>a whole story {0}</p></article><article><h2><a href=/y>Second {0}</a></h2><p>another {0}</p></article>"
    assert texts_of(spark, [index.format(3)]) == ["First 3 a whole story 3 Second 3 another 3"]


def test_main_element_outranks_names(spark):
    page = "<body><div class='post-meta'>by X{0}</div><div class='k7'><p>body {0} of the story, much longer than its author</p></div><div class='sidebar'>s {0}</div></body>"
    assert texts_of(spark, [page.format(i) for i in range(6)]) == [f"by X{i} body {i} of the story, much longer than its author" for i in range(6)]
    flat = "<body><div class='post-meta'>by X{0}</div><p>body {0} of the story</p><p>and its end {0}</p></body>"
    assert texts_of(spark, [flat.format(i) for i in range(6)]) == [f"by X{i} body {i} of the story and its end {i}" for i in range(6)]


def test_sections_with_ambiguous_names_stay_in_an_article(spark):
    page = '<body>{1}<article><p>text {0}</p><section id="related-work"><h2>Related work</h2><p>prior {0} <a href=/x>x</a></p></section><div id="discussion"><h2>Discussion</h2><p>we think {0}</p></div><div id="related"><a href=/y>see {0}</a></div><section class="discussion"><p>{0} wrote</p><form>Reply</form></section><div class="ad">buy {0}</div></article></body>'
    pages = [page.format(i, '<section id="search">find {0}</section>') for i in range(6)]
    assert texts_of(spark, pages) == [f"text {i} Related work prior {i} x Discussion we think {i}" for i in range(6)]
    assert texts_of(spark, pages[:1]) == ["text 0 Related work prior 0 x Discussion we think 0"]


def test_template_holds_what_all_pages_share(spark):
    page = "<html><body><div class=c1><p>Welcome to our pages</p><p>Our story of {0} begins</p></div><div class=c2>Same words here</div></body></html>"
    rows = [(f"h.org", page.format(i)) for i in range(6)] + [("copy.org", page.format(1))] * 9
    found = {r.host: set(r.tokens or ()) for r in H.templates(Scratch(spark, "t"), spark.createDataFrame(rows, "host string, html string")).collect()}
    assert set(found) == {"h.org"}  # copies of one page make no template
    one = H.Page(page.format(3))
    assert one.extract({t & (2**64 - 1) for t in found["h.org"]}, None) == "Our story of 3 begins"
    assert one.extract(set(), None) == "Welcome to our pages Our story of 3 begins Same words here"


def test_broken_markup():
    assert H.Page('<p class="a>b<p>c').extract(set(), None)
    assert H.Page("<script>never closed <p>x").extract(set(), None) == ""
    assert H.Page("<!-- never closed <p>x").extract(set(), None) == ""
    assert H.Page("</div></p>a</b>b").extract(set(), None) == "a b" or H.Page("</div></p>a</b>b").extract(set(), None) == "ab"
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert H.Page(deep).extract(set(), None) == "x"


def test_quoted_values_of_any_length():
    for n in (10, 19_000, 20_001, 300_000):
        for quote, other in ("\"'", "'\""):
            value = f"a > b {other}<p>{'x > y ' * (n // 6)}"
            page = f"<body><p title={quote}{value}{quote} class=k>The story {n}</p><img alt={quote}{value}{quote}/><p>and its end</p></body>"
            assert H.Page(page).extract(set(), None) == f"The story {n} and its end"
    assert H.Page('<p title="' + "x>y " * 9000 + "<p>left open</p>").extract(set(), None).endswith("left open")
    assert H.Page("<p>where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>").extract(set(), None) == "where x = 2 holds"


def test_deep_and_unclosed_pages_take_linear_time():
    import time

    for source in ("<p a='" + "<b c=\">" * 60_000 + "\"" * 60_001, "<p \"'" * 30_000 + ">" + "'" * 25_000 + '"' * 25_001 + ">", "<div>x" * 30_000, "<p title='x>y " * 30_001, '<a href="' * 30_001 + "<div title=\"'" * 5_000):
        began = time.process_time()
        page = H.Page(source)
        page.tokens(), page.masses(), page.extract(set(), None)
        assert time.process_time() - began < 20
