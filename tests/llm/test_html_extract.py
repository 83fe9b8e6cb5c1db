"""The minimum cut against all labellings, the scanner on malformed pages, and
extraction against pages whose article is known."""

import html
import itertools
import random
import re
import time

import pytest

from edumart.llm import html_extract as hx


def cut_value(terminal, edges, label):
    return (sum(t for t, s in zip(terminal, label) if t > 0 and not s) + sum(-t for t, s in zip(terminal, label) if t < 0 and s)
            + sum(c for i, j, c in edges if label[i] != label[j]))


def test_min_cut_equals_all_labellings():
    rng = random.Random(1)
    unsettled = 0
    for _ in range(400):
        n = rng.randint(1, 9)
        terminal = [rng.randint(-12, 12) for _ in range(n)]
        edges = [(i, i + 1, rng.randint(1, 10)) for i in range(n - 1)]
        edges += [(rng.randrange(n), rng.randrange(n), rng.randint(0, 8)) for _ in range(rng.randint(0, 6))]
        edges = [(i, j, c) for i, j, c in edges if i != j]
        got = hx.min_cut(terminal, edges)
        all_ = [(cut_value(terminal, edges, x), -sum(x)) for x in itertools.product([True, False], repeat=n)]
        assert (cut_value(terminal, edges, got), -sum(got)) == min(all_)
        unsettled += not all(abs(t) >= sum(c for i, j, c in edges if k in (i, j)) for k, t in enumerate(terminal))
    assert unsettled > 100
    assert hx.min_cut([], []) == []


def test_flow_on_a_long_weak_chain_ends_soon():
    rng = random.Random(2)
    n = 20_000
    terminal = [rng.choice([-9, -3, 2, 8]) for _ in range(n)]
    edges = [(i, i + 1, rng.choice([4, 8, 16])) for i in range(n - 1)]
    t = time.time()
    label = hx.min_cut(terminal, edges)
    assert time.time() - t < 30
    best = {True: 0, False: 0}                                            # the chain by dynamic programming
    for k, x in enumerate(terminal):
        c = edges[k - 1][2] if k else 0
        best = {s: min(best[s], best[not s] + (c if k else 0)) + (max(x, 0) if not s else max(-x, 0)) for s in (True, False)}
    assert cut_value(terminal, edges, label) == min(best.values())


ARTICLE = ["A Title", "First paragraph with several words, and an end.", "Short.", "Fish & chips <b> “quoted” — 5 > 3.", "Last one; see the link text here too."]


def page(body):
    return f'<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style><script>var t="</p><article>";</script></head><body class="has-cookie-notice">{body}</body></html>'


def article(tag="p", wrap="<article>{}</article>"):
    first, *rest = (html.escape(x) for x in ARTICLE)
    rest[-1] = rest[-1].replace("link text", '<a href="/x">link\n text</a>')
    return wrap.format(f"<h1 id='cookies-and-comments'>{first}</h1>" + "".join(f"<{tag}>{x}</{tag}>\n" for x in rest))


NOISE = ['<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News and more</a></li></ul></nav>',
         '<div class="ad">Buy this thing now, it is really very good. Do it today.</div>',
         '<aside class="sidebar"><h2>Side</h2><p>A long side text that reads like an article, with commas and an end.</p></aside>',
         '<div class="cookie-banner"><div class="content"><p>We use cookies to make this site a better place for everyone. Accept them.</p></div></div>',
         '<form action="/s"><label>Search</label><input name=q><select><option>One</option></select><button>Go</button></form>',
         '<section id="comments"><h3>2 comments</h3><article class="comment"><p>I liked this article a lot, thank you for it.</p></article></section>',
         '<div class="related"><article><h3>Another article</h3><p>Its teaser text is here for you to read.</p></article></div>',
         '<noscript>Turn on scripts.</noscript><!-- <article><p>no</p></article> --><svg><text>no</text></svg>',
         '<header><div class="logo">Site name</div><p>The best site of the whole web, since 1999.</p></header>',
         '<footer><p>&copy; 2020 Example. All rights are reserved, as they always were.</p></footer>']


@pytest.mark.parametrize("wrap", ["<article>{}</article>", '<main><div class="x">{}</div></main>', '<div class="post-content">{}</div>',
                                  '<div id="story"><div><div>{}</div></div></div>', '<article class="post comments-open">{}</article>',
                                  '<form id="aspnet"><main>{}</main></form>', '<article><header class="entry-header"><p></p></header>{}</article>'])
@pytest.mark.parametrize("tag", ["p", "div", "li"])
def test_article_is_found_among_noise(wrap, tag):
    rng = random.Random(7)
    for _ in range(6):
        noise = NOISE[:]
        rng.shuffle(noise)
        k = rng.randint(0, len(noise))
        assert hx.main_text(page("".join(noise[:k]) + article(tag, wrap) + "".join(noise[k:])))[0] == "\n".join(ARTICLE)


def test_noise_inside_the_article_and_text_without_evidence():
    inside = "<article>" + "".join(x for pair in zip((f"<p>{html.escape(t)}</p>" for t in ARTICLE), NOISE) for x in pair) + "</article>"
    assert hx.main_text(page(inside))[0] == "\n".join(ARTICLE)
    prose = "This is a running text of more than a few words, and it comes to an end here."
    bare = f"<div>{prose}</div><div>Short bit.</div><div>{prose}</div>" + "<ul>" + "<li><a href='/'>x y</a></li>" * 9 + "</ul>"
    assert hx.main_text(page(bare))[0] == f"{prose}\nShort bit.\n{prose}"     # the short block follows its neighbours


@pytest.mark.parametrize("source,want", [
    ("", ""), ("<article>", ""), ("   ", ""), ("<b></b>", ""),
    ("<article><p>a <b>b<p>c</article>", "a b\nc"), ("<article><p>x<br>y &amp z &am", "x y & z &am"),
    ("<article>1 < 2 <3 &lt;p&gt; &#233;&#x4e2d;&nbsp;x</article>", "1 < 2 <3 <p> é中 x"),
    ("<article><p title='a > b'>q</p><p title=\"un>closed>r</p>", "q\nclosed>r"), ("<article>t<!-- never", "t"), ("<article>t<script>never", "t"),
    ("<ARTICLE><P>Up</P></ARTICLE>", "Up"), ("<nav><ul><li>m<article>body text</article>", "body text"),
    ("<article></div></span></p><p>ok</p></article></article><p>", "ok"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl></article>", "a\nb\nc\nd\ne"),
    ("<article><p>in <span class=ad>spam <span>x</span> spam</span> out</p></article>", "in\nout")])
def test_malformed_pages(source, want):
    assert hx.main_text(source)[0] == want


def test_long_pages_take_time_in_proportion():
    t = time.time()
    for source in ["<article>" + "<p>word word.</p>" * 50_000, "<div>" * 100_000 + "x", "<a " * 200_000, '<a "' * 200_000,
                   "<div>w</div>" * 30_000, "<!--" * 100_000, "</x>" * 100_000 + "<article>" + "word " * 1_000_000]:
        hx.main_text(source)
    assert time.time() - t < 60
    assert hx.main_text("<article>" + "word \n" * 1_000_000)[0] == " ".join(["word"] * 1_000_000)


def test_fit_follows_its_counts():
    assert hx.fit([]) == hx.PRIOR and hx.fit([(3, 0, 1, 0, 0, 1, 50)]) == hx.PRIOR
    w = hx.fit([(2, 0, 0, 0, 0, 1, 5000), (20, 0, 1, 0, 0, 0, 5000)])         # here content is what is short
    assert hx.logit((2, 0, 0, 0, 0), w) > 0 > hx.logit((20, 0, 1, 0, 0), w)


def test_query_on_given_pages_and_edge_rows(spark, tmp_path):
    got = {r.page_id: r for r in hx.op11_html_extraction(spark, "/root/testdata/sf0.01").collect()}
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:                                                           # the given pages have one article of h1 and p
        inner = re.search(r"(?s)<article>(.*?)</article>", p.html).group(1)
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split("</?(?:p|h1)>", inner))
        want = "\n".join(x for x in parts if x)
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, want, len(want))
    rows = [(1, None, None), (2, "u", ""), (None, None, page(article())), (3, "u", page(article())), (3, "u", page(article()))]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, text string, n_blocks int")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    full = "\n".join(ARTICLE)
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in hx.op11_html_extraction(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (2, "u", "", 0), (None, None, full, len(full)), (3, "u", full, len(full)), (3, "u", full, len(full))], key=str)
    df.limit(0).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert hx.op11_html_extraction(spark, f"{tmp_path}/none").count() == 0
