from collections import defaultdict
from itertools import groupby

import numpy as np
import pytest

from salescast.llm import html_text
from salescast.llm.html_text import DROPPED, IN_MAIN, LONG, PAGES, PLAIN, _parts, _suffixes, blocks, extract, suffix_array

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="top ad-box">buy</div><div id="cookieNotice">we use</div>
<main><header><h1>Tit<b>le</b></h1></header><p>One &lt;b&gt; &amp; two<br>three&nbsp; four<p>five<form>f<input></form>
<div class="comments"><article>bad</article></div><footer>no</footer></main><p>rest</p><footer>&copy; x</footer>"""


def test_article_without_the_rest():
    found = blocks(PAGE)
    assert [t for k, t in found if k == IN_MAIN] == ["Title", "One <b> & two", "three four", "five"]
    assert {t for k, t in found if k == DROPPED} == {"Menu", "buy", "we use", "f", "bad", "no", "© x"}
    assert [t for k, t in found if k == PLAIN] == ["rest"]


@pytest.mark.parametrize("html, text", [
    ("<article>a <b>b</b>c<!-- x --></article>", "a bc"), ("<article>a<p>b &am", "a b &am"), ("<article>a <p", "a"), ("<article>a <!-- b", "a"),
    ("<article>a<script>b", "a"), ("<article>1 < 2 &#233;&#x41;</article>", "1 < 2 éA"), ("<ARTICLE>a</ARTICLE>b", "a"),
    ("<div role=main>a<div hidden>b</div></div>", "a"), ("", ""), (None, ""), ("<nav>a", ""),
    ('<article><a title="x > y">a</a></article>', "a"), ("<article>" + "a " * 50_000 + "</article>", " ".join(["a"] * 50_000)),
])
def test_single_pages(spark, html, text):
    row = extract(spark.createDataFrame([(1, "http://h/x", html, 0)], "page_id int, url string, html string, text int")).first()
    assert (row.page_id, row.url, row.text, row.n_chars) == (1, "http://h/x", text, len(text))


def without_repeats(streams, pages, blocks_of):
    """The words of each stream that no ``LONG`` words found on ``PAGES`` distinct pages cover, but for short parts of blocks."""
    holders = {}
    for words, page in zip(streams, pages):
        for k in range(len(words) - LONG + 1):
            holders.setdefault(tuple(words[k: k + LONG]), set()).add(page)
    out = []
    for words, sizes in zip(streams, blocks_of):
        gone = {i for k in range(len(words) - LONG + 1) if len(holders[tuple(words[k: k + LONG])]) >= PAGES for i in range(k, k + LONG)}
        kept, at = [], 0
        for size in sizes:
            own = range(at, at + size)
            for run, inside in groupby(own, key=gone.__contains__):
                places = list(inside)
                if not run or len(places) < min(LONG, size):
                    kept += [words[i] for i in places]
            at += size
        out.append(kept)
    return out


def test_repeats_equal_brute_force_for_any_partitioning(spark):
    rng = np.random.default_rng(2)
    shared = [[f"s{k}w{i}" for i in range(rng.integers(8, 30))] for k in range(6)]
    rows, streams, names, sizes = [], [], [], []
    for i in range(120):
        words = [f"own{i}"]
        for _ in range(rng.integers(0, 5)):
            some = shared[rng.integers(0, 6)]
            words += some[rng.integers(0, 4): len(some) - rng.integers(0, 4)] + [f"p{i}x{rng.integers(0, 9)}"]
        page, host = int(rng.integers(0, 100)), "ab"[i % 2]
        rows.append((page, f"http://{host}.example/{i}", "".join(f"<div>{' '.join(part)}</div>" for part in np.array_split(words, 3) if len(part))))
        streams.append((host, words))
        names.append((host, page))
        sizes.append([len(part) for part in np.array_split(words, 3)])
    want = []
    for host in "ab":
        own = [i for i, (h, _) in enumerate(streams) if h == host]
        for i, words in zip(own, without_repeats([streams[i][1] for i in own], [names[i] for i in own], [sizes[i] for i in own])):
            want.append((rows[i][0], rows[i][1], " ".join(words)))
    data = spark.createDataFrame(rows, "page_id int, url string, html string")
    for parts in (1, 50):
        assert sorted((r.page_id, r.url, r.text) for r in extract(data.repartition(parts)).collect()) == sorted(want)


MENU = "home about contact us imprint our shop news press jobs and more"


def test_host_repeats_go_where_no_main_text_is_marked(spark):
    menu = f"<div>{MENU}</div>"
    rows = [(i, f"http://www.a.example/{i}", f"<body>{menu}<div>own words of page {i} here</div>") for i in range(5)]
    rows += [(9, "http://www.b.example/", f"<body>{menu}<div>other</div>"), (10, None, "<p>x"), (11, "http://www.a.example/q", f"{menu}<article>A</article>"),
             (0, rows[0][1], rows[0][2])]
    got = extract(spark.createDataFrame(rows, "page_id int, url string, html string"))
    assert sorted((r.page_id, r.text) for r in got.collect()) == sorted(
        [*((i, f"own words of page {i} here") for i in (0, 0, 1, 2, 3, 4)), (9, f"{MENU} other"), (10, "x"), (11, "A")])


def test_boilerplate_on_few_pages_of_a_large_host(spark):
    rows = [(i, f"http://big.example/{i}", f"<p>{MENU if i % 100 == 0 else f'no menu on page {i}'}</p><p>text {i}</p>") for i in range(2000)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert all(got[i] == (f"text {i}" if i % 100 == 0 else f"no menu on page {i} text {i}") for i in range(2000))


def test_empty_table(spark):
    assert extract(spark.createDataFrame([], "page_id int, url string, html string")).count() == 0


@pytest.mark.parametrize("html, text", [
    ('<html class="no-overlay"><body class="right-sidebar cookies-not-set has-header"><article>a</article></body></html>', "a"),
    ('<div class="has-sidebar"><div id="header-layout"><main>a</main></div></div>', "a"), ('<div class="side"><p>x<div role=main>a</div></div>', "a"),
    ('<div class="sidebar-left"><article>a</article></div><div class="sidebar-left"><article>b</article></div>', "a b"),
    ('<div class="content-sidebar" role="main">a</div>', "a"), ('<body class="sidebar"><div class="sidebar">x</div><article>a</article>', "a"),
    ('<article>a</article><div id="comments"><article>b</article></div>', "a"), ('<body class="comments-open"><article>a</article>', "a"),
    ('<article><h2 id="legal-status">a</h2><h3 class="share">b</h3><section id="related-work">c<p>d</section></article>', "a b c d"),
    ('<article>a<section class="related">b</section><div id="share">c</div></article>', "a"),
    ("<article>a <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=tex>x=2</annotation></math> b</article>", "a x=2 b"),
    ('<html><head><title>x</title></head><body><div class="comments-open"><article><p>Body</p></article></div></body></html>', "Body"),
    ('<html><head></head><body><div id="related-layout"><p>x</p><main>a</main></div></body></html>', "a"),
    ('<article><p class="share-price">1</p><div class="legal">2</div><p class="notice">3</p><div class="share-price">4</div></article>', "1 2 3 4"),
    ('<article>a<div class="x share-buttons">b</div><div class="adBox">c</div><ul class="related posts">d</ul><span class="ad">e</span><span class="share">f</span></article>', "a f"),
    ('<div class="sidebar"><nav>x</nav></div><article>a</article>', "a"), ('<div class="ad">' * 3000 + "<article>a</article>", "a"),
])
def test_words_of_layouts_and_topics(html, text):
    assert " ".join(t for k, t in blocks(html) if k == IN_MAIN) == text


def test_suffix_array_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    shared = [[f"s{k}w{i}" for i in range(n)] for k, n in enumerate((9, 10, 25, 50, 90))]
    rows = []
    for i in range(60):
        words = [f"own{i}"]
        for _ in range(rng.integers(0, 4)):
            some = shared[rng.integers(0, 5)]
            words += some[rng.integers(0, 3): len(some) - rng.integers(0, 3)] + ([f"p{i}"] if i % 2 else [])
        rows.append(("ab"[i % 2], i, int(rng.integers(0, 50)), " ".join(words), None if i % 3 else ""))
    want, length = {}, LONG
    while length < 500:
        alike = defaultdict(list)
        for host, key, page, stream, _ in rows:
            words = stream.split(" ")
            for k in range(len(words) - length + 1):
                alike[host, tuple(words[k: k + length])].append((key, page, k))
        want |= {(key, k, length): same for same, places in alike.items() if len({p for _, p, _ in places}) >= PAGES for key, _, k in places}
        length *= 2
    found = spark.createDataFrame(rows, "host string, key bigint, page_id int, stream string, text string").repartition(7)
    got = suffix_array(_suffixes(found)).collect()
    assert {(r.key, r.place, r.length) for r in got} == set(want) and len(got) == len(want)
    assert max(r.length for r in got) == 8 * LONG
    assert all(r.open == (r.key % 3 > 0) for r in got)
    rank = {(r.key, r.place, r.length): r.rank for r in got}
    for length in {r.length for r in got}:
        own = sorted((name, place) for place, name in rank.items() if place[2] == length)
        for (one, here), (two, there) in zip(own, own[1:]):
            assert (one == two) == (want[here] == want[there])  # neighbours of one rank share as many words, others don't
            shorter = [(key, k, length // 2) for key, k, _ in (here, there)]
            assert length == LONG or rank[shorter[0]] <= rank[shorter[1]]


NOTICE = "please note that all of our texts are free to read and share"


def test_repeats_decide_doubted_blocks_of_marked_articles(spark):
    page = '<p>x {0}</p><article><p>{1}</p><div class="notice">{2}</div>a{0}<p class="share-price">price {0}</p><div class="legal"><p>{2} {0}</p></div></article>'
    rows = [(i, "http://a.example/", page.format(i, MENU, NOTICE)) for i in range(4)] + [(9, "http://b.example/", page.format(9, MENU, NOTICE))]
    rows += [(20 + i, "http://c.example/", f'<article><div class="legal">{NOTICE}</div></article>') for i in range(4)]
    rows += [(30 + i, "http://d.example/", f'<article>a<b class="notice">b</b>c <h2 class="notice">{NOTICE}</h2></article>') for i in range(4)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert all(got[i] == f"{MENU} a{i} price {i} {i}" for i in range(4))  # the article's own passage stays though all have it
    assert got[9] == f"{MENU} {NOTICE} a9 price 9 {NOTICE} 9"
    assert all(got[20 + i] == NOTICE and got[30 + i] == f"abc {NOTICE}" for i in range(4))


def test_quotes_in_other_articles_do_not_make_a_text_a_repeat(spark):
    rows = [(i, "http://a.example/", f"<article>{i} {NOTICE}</article>") for i in range(5)] + [(9, "http://a.example/", f"<p>{NOTICE}</p>")]
    got = extract(spark.createDataFrame(rows, "page_id int, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()}[9] == NOTICE


def test_main_parts_are_in_the_suffix_array(spark):
    """What main parts repeat is found on every page, whole or open, in streams of its own; markup has the last word on it."""
    pages = [f"<nav>n{i} {MENU}</nav><article><p>{i} {NOTICE} a{i}</p></article>" for i in range(4)]
    pages += [f'<article>{NOTICE} b{i}<div class="notice">doubt {i}</div></article>' for i in range(2)] + [f"<p>own {NOTICE}</p>"]
    parts = [("h", i, i, *_parts(page)) for i, page in enumerate(pages)]
    found = spark.createDataFrame(parts, "host string, key bigint, page_id int, text string, stream string, sizes array<int>, main array<string>")
    got = suffix_array(_suffixes(found)).collect()
    own = len(NOTICE.split()) - LONG + 1
    inside = {(key, key < 4 and 1) for key in range(6)}
    assert {(r.key, r.place, r.open) for r in got if r.inside} == {(key, at + k, key >= 4) for key, at in inside for k in range(own)}
    assert not any(r.common for r in got if r.inside)
    assert {r.key for r in got if not r.inside and r.common} == {0, 1, 2, 3}  # the menus
    assert {r.key for r in got if not r.inside and not r.common} == {6}  # the passage that only articles repeat
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").selectExpr("page_id", "'http://h/' url", "html")
    texts = {r.page_id: r.text for r in extract(rows).collect()}
    assert texts[0] == f"0 {NOTICE} a0" and texts[4] == f"{NOTICE} b0 doubt 0" and texts[6] == f"own {NOTICE}"


@pytest.mark.parametrize("bits", [1 << 26, 1 << 13])
def test_letters_that_leave_early_are_shared_by_too_few_pages(spark, monkeypatch, bits):
    """However many grams fall on one place of the bitmap."""
    monkeypatch.setattr(html_text, "BITS", bits)
    rng = np.random.default_rng(8)
    common = [f"c{k}" for k in range(30)]
    rows = [("ab"[i % 2], i, i // 2, " ".join([f"u{i}x{k}" for k in range(40)] + common[rng.integers(0, 9): 15 + rng.integers(0, 15)]), "") for i in range(40)]
    found = spark.createDataFrame(rows, "host string, key bigint, page_id int, stream string, text string").repartition(5)
    letters = defaultdict(set)
    every = 0
    for host, key, page, stream, _ in rows:
        words = stream.split(" ")
        every += len(words) - LONG + 1
        for k in range(len(words) - LONG + 1):
            letters[host, tuple(words[k: k + LONG])].add((key, k, page))
    want = {(key, k) for same in letters.values() if len({p for _, _, p in same}) >= PAGES for key, k, _ in same}
    left = {(r.key, r.place) for r in _suffixes(found).collect()}
    assert want and want <= left and (len(left) < every / 2 or bits < 1 << 20)
    assert {(r.key, r.place) for r in suffix_array(_suffixes(found)).collect()} == want
