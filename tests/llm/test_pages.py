import random
import time

import pytest

from taxaflow.llm import html_extract, queries, url_filter
from tests.llm import plain_html
from tests.llm.helpers import duck_rows, spark_rows

CASES = [
    ("", ""), (None, ""), ("plain &lt;text&gt;  here", "plain <text> here"),
    ("<body><nav>menu</nav><article><h1>T&amp;T</h1><p>one<br>two <b>x</b>y<p>three</article><footer>f</footer></body>", "T&T\n\none two xy\n\nthree"),
    ("<div class='sidebar'>s</div><div id=main><p>long enough text</p><div class='reader-comments'><p>c</p></div><form><p>q</p></form></div>", "long enough text"),
    ("<article><script>var a='</p>';</script><style>p{}</style><!-- <p>no</p> --><p title='a>b'>yes &#233; &nbsp; z</p><p hidden>h</p></article>", "yes é z"),
    ("<article><header><h1>Head</h1><p>by line</p></header><p>text text text</p></article>", "Head\n\ntext text text"),
    ("<form><div><p>all the page is wrapped in a form</p></div></form>", "all the page is wrapped in a form"),
    ("<article><p>a < b and c > d</p><ul><li>i<li>j</ul><table><tr><td>1<td>2</table></article>", "a < b and c > d\n\ni\n\nj\n\n1\n\n2"),
    ("<article><p>open <script>never closed", "open"), ("<article><p>x</p><!-- never closed <p>y</p>", "x"),
    ("<div class='content with-sidebar'><p>kept</p></div>", "kept"), ("<article><p>" + "w " * 50_000 + "</p></article>", ("w " * 50_000).strip()),
]


BODY = " ".join(["the article's own words"] * 90)
WHOLE = [
    (f"<article><h1>{'t' * 60}</h1><p>{'l' * 150}</p><div class=entry><p>{BODY}</p></div></article>", f"{'t' * 60}\n\n{'l' * 150}\n\n{BODY}"),
    (f"<main><h1>Title</h1><article><p>{BODY}</p></article></main><p>not in it</p>", f"Title\n\n{BODY}"),
    (f"<body><h1>Title</h1><p>Lead.</p><div class=entry><p>{BODY}</p></div></body>", f"Title\n\nLead.\n\n{BODY}"),
    (
        f"<body><header><h1>Site</h1></header><div class=top><h1>Title</h1></div><div class=intro><p>Lead of it.</p></div><div class=entry><p>{BODY}</p></div>"
        f"<section class=more><p>And the rest.</p></section><div class=sidebar><p>{BODY}</p></div><div class=tags><a href=x>some tag or other</a></div><nav>n</nav></body>",
        f"Title\n\nLead of it.\n\n{BODY}\n\nAnd the rest.\n\nsome tag or other",
    ),
    (f"<body><article class=a><p>The first part.</p></article><article class=b><p>{BODY}</p></article></body>", f"The first part.\n\n{BODY}"),
    (f"<div class=wrap><div class=post><p>{BODY}</p></div></div><div class=links><a href=x>some other page</a></div>", BODY),
]


CONTENT = [
    ("<article><p>Let <math><mi>x</mi></math> be</p><p>any</p></article>", "Let x be\n\nany"),
    ("<article><p>a <math><semantics><mi>y</mi><annotation encoding=tex>\\y</annotation></semantics></math> b</p></article>", "a y b"),
    ("<article><p>a <button>key</button> and <object>a figure</object></p><dialog open>said</dialog></article>", "a key and a figure\n\nsaid"),
    ("<article><dialog><p>not open</p></dialog><p>text <select><option>o</select>of it</p></article>", "text of it"),
    ("<article><svg><title>t</title><text>drawn</text></svg><p>text</p></article>", "drawn\n\ntext"),
    ("<article><h2 class='section-header'>Part</h2><p class='search-result'>found</p></article>", "Part\n\nfound"),
    ("<article><p>at <span class='share-price'>12</span> today, <a id=comment href=x>they</a> said</p></article>", "at 12 today, they said"),
    ("<article><table><tr><td class='form-label'>1<th class=header>2</table></article>", "1\n\n2"),
    ("<article><p>one <span hidden>no</span> two <i style='display: none'>no</i>three</p></article>", "one two three"),
    ("<article><header><div><h1 class=header>Head</h1><p>by line</p></div><nav><h2>menu</h2></nav></header><p>text, and more of it</p></article>", "Head\n\ntext, and more of it"),
    ("<article><div class=share><p>no</p></div><ul class=social><li>no</ul><li class=comment><p>no</p></li><p>text</p></article>", "text"),
]


@pytest.mark.parametrize("html,want", CASES + WHOLE + CONTENT)
def test_extract(html, want):
    assert html_extract.extract(html, None) == want


def test_equals_the_plain_extractor(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    rng = random.Random(1)
    bits = "<div>|</div>|<p>|</p>|<article>|</article>|<div class=nav>|<h1>|</h1>|<header>|</header>|text words |<a href='x'>|</a>|<a |\"|'|<!--|-->|<![CDATA[|]]>|<main>|</main>"
    bits += "|<td>|<table>|</table>|<li>|<ul>|</ul>|&amp;|&#65;|<section class='more x1'>|</section>|<b>|<br>|<script>|</script>|more of the text, it is long |<form>|</form>|>|<dialog open>|<p class='a>b'>|<"
    bits = bits.split("|")
    odd = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for html in pages + odd:
        assert html_extract.extract(html, None) == plain_html.extract(html), html
        mine, said = html_extract.votes(html), plain_html.votes(html)
        assert [(p, round(x, 6), *n) for p, x, *n in mine] == [(p, round(x, 6), *n) for p, x, *n in said], html
        paths = [v[0] for v in said][:3] + ["/body/div", ""]
        assert html_extract.extract(html, paths, paths[1:2]) == plain_html.extract(html, paths, paths[1:2]), html


DEEP = "<div>" * 100_000 + "text" + "</div>" * 100_000
LONG = [
    ("<a " * 350_000, None), ('<a b="x>' * 100_000, None), ("<a b='x>y\" " * 60_000 + ">", None), (DEEP, "text"), ("<article><p>art</p></article>" + "<div><b>x" * 50_000, "art"),
    ("<p>&#" + "1" * 100_000 + ";&#" + "0" * 9000 + "65;</p>", "\ufffdA"), ("<" * 300_000, "<" * 300_000), ("<!-- x -->" * 50_000 + "y", "y"), ("<x" * 300_000, None), ("<p " + "a " * 300_000 + ">x", "x"),
    ("<p><![CDATA[hello world", "hello world"),
]


@pytest.mark.parametrize("i", range(len(LONG)))
def test_long_and_odd_pages_take_a_few_seconds(i):
    html, want = LONG[i]
    start = time.process_time()
    got = html_extract.extract(html, None)
    html_extract.votes(html)
    assert (want is None or got == want) and time.process_time() - start < 20


def test_hosts_agree_on_paths(spark):
    usual = "<body><div class='post-{i}'><p>" + "text of the article itself " * 5 + "</p></div><div class='box'><p>{box}</p></div></body>"
    rows = [(i, "http://a.org/x", usual.format(i=i, box="small")) for i in range(9)]
    rows += [(9, "http://a.org/y", usual.format(i=9, box="a much longer box " * 30)), (10, None, None), (11, "http://b.org", "<p>lone</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in html_extract.extract_pages(pages).collect()}
    alone = html_extract.extract(rows[9][2], None)
    assert "longer box" in alone and "longer box" not in got[9].text  # the host's other pages outvote this one
    assert got[10].text == "" and got[10].n_chars == 0 and got[11].text == "lone" and len(got) == 12
    assert html_extract.extract_pages(pages.where("false")).count() == 0
    assert html_extract.extract_pages(pages.withColumnRenamed("page_id", "TEXT")).columns == ["url", "html", "text", "n_chars"]


def test_pages_of_rare_templates_keep_their_article(spark):
    usual = f"<body><div class='post'><p>{BODY}</p></div><div class='box'><p>small</p></div></body>"
    rare = f"<body><div class='post'><p>{{post}}</p></div><div class='story'><h1>Story</h1><p>{BODY}</p></div></body>"
    bare = f"<body><div class='post'><p>One line of it.</p></div><h1>Bare</h1><p>{BODY}</p><div class='box'><p>{{box}}</p></div></body>"
    rows = [(i, "http://a.org/x", usual) for i in range(40)] + [(40, "http://a.org/y", rare.format(post="One line of it."))]
    rows += [(41, "http://a.org/z", bare.format(box="Twelve words.")), (42, "http://a.org/w", rare.format(post=BODY[:900]))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    assert got[0] == got[39] == BODY
    assert got[40] == f"One line of it.\n\nStory\n\n{BODY}"
    assert got[41].startswith(f"One line of it.\n\nBare\n\n{BODY}")
    assert got[42] == f"{BODY[:900]}\n\nStory\n\n{BODY}"


def test_the_path_that_covers_most_wins():
    page = f"<body><div class=a><p>One line.</p></div><div class=b><p>{BODY}</p></div></body>"
    assert html_extract.extract(page, ["/body/div.a", "/body/div.b"]) == BODY
    assert html_extract.extract(page, ["/body/div.a"]) == BODY


URLS = [
    (1, "http://a.example.org/en/1x?q", '<a href="http://b.net/x">'), (2, "https://EXAMPLE.org/es/", '<a href=//c.net>'), (3, "http://d.com/de/3#x", "<a href='http://e.net/'>"),
    (4, "http://b.net/z", '<a href="https://C.net/?q">'), (5, "https://c.net", None), (6, "http://e.net/q", '<a href="http://d.com/1">'), (7, None, "x"), (8, "nohost", ""),
    (9, "http://notorg/x", '<A HREF = "http://d.com/">'), (9, "http://notorg/x", '<A HREF = "http://d.com/">'), (None, "ftp://f.com/fr/", "<a href='http://notorg/'>"),
    (11, "http://g.net/?a/b#c", "<a href='http://d.com/de/'><a href='http://d.com/de/'><a href='http://b.net'>"), (12, "http://x.org", ""),
]


def test_urls_match_sql(spark, tmp_path):
    pages = spark.createDataFrame(URLS, "page_id long, url string, html string")
    got = url_filter.judge_urls(pages, queries.RULES)
    assert spark_rows(got) == duck_rows(url_filter.sql(queries.RULES), tmp_path, pages=pages)
    by = {r.page_id: r for r in got.collect()}
    assert by[1].rule == "example.org/en/1" and by[1].verdict == "block" and by[2].rule == "example.org/es/"
    assert by[11].rule is None and by[11].verdict == "block" and by[11].trust == 0 < by[11].distrust  # links to a blocked host
    assert by[4].verdict == "allow" and by[12].rule is None and (by[7].host, by[8].path) == ("", "")
    assert url_filter.judge_urls(pages.where("false"), queries.RULES).count() == 0


def test_propagation_goes_on_to_the_end(spark):
    chain = [(f"h{i}", f"h{i + 1}", 1) for i in range(24)]
    edges = spark.createDataFrame([*chain, ("h24", "bad", 1), ("x", "y", 1), ("y", "x", 1)], "src string, dst string, n long")
    seeds = spark.createDataFrame([("bad", 0, 1), ("x", 1, 0)], "host string, trust long, distrust long")
    got = {r.host: r for r in url_filter.propagate(edges, seeds, 0.5, None, 1e-6).collect()}
    assert all(abs(got[f"h{i}"].distrust / 0.5 ** (26 - i) - 1) < 1e-9 for i in range(25))
    assert abs(got["x"].trust - 0.5 / 0.75) < 1e-6 and abs(got["y"].trust - 0.25 / 0.75) < 1e-6


def test_propagation_is_personalised_pagerank(spark):
    import numpy as np

    edges = [("a", "b", 2), ("b", "c", 1), ("c", "a", 1), ("c", "d", 3), ("a", "d", 2)]
    seeds = spark.createDataFrame([("a", 3, 0), ("d", 0, 1)], "host string, trust long, distrust long")
    got = {r.host: (r.trust, r.distrust) for r in url_filter.propagate(spark.createDataFrame(edges, "src string, dst string, n long"), seeds, 0.85, 12).collect()}
    names = "abcd"
    for k, (seed, flip) in enumerate((([3, 0, 0, 0], False), ([0, 0, 0, 1], True))):
        w = np.zeros((4, 4))
        for s, t, n in edges:
            i, j = names.index(s), names.index(t)
            w[(j, i) if flip else (i, j)] = n
        w = np.divide(w, w.sum(1, keepdims=True), out=np.zeros_like(w), where=w.sum(1, keepdims=True) > 0)
        x, total = np.array(seed, float), np.zeros(4)
        for _ in range(13):
            total += 0.15 * x
            x = 0.85 * x @ w
        assert all(abs(got.get(n, (0, 0))[k] - total[i]) < 1e-12 for i, n in enumerate(names))


#: Pages and the text that a reader would call the article, written by hand.
BY_HAND = [
    ("<article><h1>T</h1><p>first words of it</p><section id='discussion'><h2>Discussion</h2><p>what it means</p></section></article>", "T\n\nfirst words of it\n\nDiscussion\n\nwhat it means"),
    ("<main><p>a study of some length</p><section class='related-work'><p>what others did before</p></section></main>", "a study of some length\n\nwhat others did before"),
    ("<article><p>on the law of authors</p><div class='copyright-law'><p>how long it lasts</p></div></article>", "on the law of authors\n\nhow long it lasts"),
    ("<article><p>what we found</p><table class='search-results'><tr><td>one</td><td>two</td></tr></table></article>", "what we found\n\none\n\ntwo"),
    ("<article><p>a line <span class='ad'>Buy now</span> of text</p></article>", "a line of text"),
    ("<article><p>some text to read</p><label>Your mail</label></article>", "some text to read"),
    ("<body><div class='site-header'>Site</div><div class='post-content'><p>the text of the post</p></div><div class='related-posts'><p>another post of ours</p></div><div id='footer-links'>Imprint</div></body>", "the text of the post"),
    ("<body><div class='comment-list'><p>I do not agree at all with this</p></div><article><p>the text</p></article><ul class='nav-menu main'><li>Home</li></ul></body>", "the text"),
    ("<article><p>the story</p><div class='advertisement-box'>Buy</div><div class='newsletter signup'>Mail us</div><section class='readerComments'>No</section></article>", "the story"),
]


@pytest.mark.parametrize("html,want", BY_HAND)
def test_articles_written_by_hand(html, want):
    assert html_extract.extract(html, None) == want


def test_a_host_sends_few_paths_to_its_pages(spark):
    """Pages with classes of their own have no winners; of common templates at most ten can win, however many pages there are."""
    own = [("http://a.org/", f"<div class='c{'abcdefghij'[i % 10] * (i // 10 + 1)}'><p>text of page {i} as long as it needs</p></div>") for i in range(200)]
    few = [("http://b.org/", f"<div class='t{'abcd'[i % 4]}'><p>text of page {i} as long as it needs</p></div>") for i in range(80)]
    pages = spark.createDataFrame(own + few, "url string, html string")
    hosts = {r.host: r.paths for r in html_extract.host_paths(pages.selectExpr("substr(url, 8, 5) as host", "html"), host="host", html="html").collect()}
    assert not hosts.get("a.org") and sorted(hosts["b.org"]) == [f"/div.t{c}" for c in "abcd"]
    got = [r.text for r in html_extract.extract_pages(pages).collect()]
    assert len(got) == 280 and all(t.startswith("text of page") for t in got)
