import random

import pytest

from eventide.llm import html_templates as H

ONE = [  # html, main text
    ("<html><head><title>T</title></head><body><nav><a>Menu</a></nav><article><h1>Head</h1><p>One&amp;  two\n<b>th</b>ree<br>four<p>Five</article>"
     "<footer>&copy; x</footer></body></html>", "Head One& two three four Five"),
    ("<body><header><h1>Site</h1></header><main><h1>Title</h1><article><p>text</p><section class='comments'><p>nice!</p></section></article></main>",
     "Title text"),
    ("<article><header><h1>Own</h1></header><p>a</p><aside>side</aside><div class='ad'>buy</div><div class=\"AdSlot\">buy</div><form>f<input>x</form>"
     "<p>b<script>var a='<p>no</p>';</script>c</p></article>", "Own a bc"),
    ("<div class='has-sidebar'><article><p>kept</p></article><div id=sidebar>not</div></div>", "kept"),
    ("<p>plain<p>page<ul><li>x<li>y</ul><table><tr><td>1<td>2<tr><td>3</table>", "plain page x y 1 2 3"),
    ("text &lt;b&gt; &#233;&#x1F600;&nbsp;&amp;amp; &am", "text <b> é😀 &amp; &am"),
    ("<article><p>a < b and c > d</p><p>cut <a hre", "a < b and c > d cut"),
    ("<article><p>x<!-- y <p>z</p> --> w</p><!-- open <p>never</p>", "x w"),
    ("<article><div hidden>h</div><div style='display: none'>h</div><div aria-hidden=true>h</div><p title='a>b'>t</p></article>", "t"),
    ("<article><h2>A</h2><p>b</p><section><h2>3 Comments</h2><article class='comment'><p>c</p></article></section></article>", "A b"),
    ("<article><p>1</p><style>p{}</style><textarea>no</textarea><pre> a\n  b </pre></article>", "1 a b"),
    ("<body><script>never closed <p>x</p>", ""), ("", ""), ("   ", ""), ("<", "<"), ("<p", ""),
    ("<article><p>in</article><p>out</p>", "in"),
    ("<article><p>a</p><div class='sitefooter'>f</div><ol class=commentlist><li>c</ol><p class='commentary adverbs'>b</p></article>", "a b"),
    ("<ARTICLE><P CLASS=x>Up</P><DIV ROLE='navigation'>m</DIV></ARTICLE>", "Up"),
    ("<article>" + "<div><b>" * 3000 + "deep" + "</article>", "deep"),
    ("<article><ul><li>one</li><li>two<ul><li>three</ul></li></ul><dl><dt>t<dd>d</dl></article>", "one two three t d"),
    ("<article><p>f<sup>2</sup>x <a href=x>li</a>nk</p><figure><img src=x alt=no><figcaption>cap</figcaption></figure></article>", "f2x link cap"),
]


@pytest.mark.parametrize("source,want", ONE)
def test_one_page(source, want):
    assert H.Page(source).text() == want


LONG = "the main text of a page that has many words and no article element"
CLAIMED = [  # a class or id word claims, the text decides
    (f"<div class='content-sidebar-wrap'><p>{LONG}</p><div id='sidebar'>other posts</div></div>", LONG),
    (f"<body><div class='has-sidebar'><h1>T</h1><p>{LONG}</p></div><div class='widget'>x</div></body>", f"T {LONG}"),
    (f"<nav>{LONG} {LONG} {LONG}</nav><div id='search-results'><p>{LONG}</p></div>", LONG),
    ("".join(f"<div class='search-item'>{LONG} {i}</div>" for i in range(5)), " ".join(f"{LONG} {i}" for i in range(5))),
    (f"<div id='comments'>{LONG}</div>", LONG),
    (f"<div class='notice'>{LONG}</div><div class='widget'>{LONG}</div><div class='related'>{LONG}</div>", f"{LONG} {LONG} {LONG}"),
    (f"<article><p>{LONG}</p><div class='share-price'>12.30</div><section class='cookie-recipes'><p>mix</p></section></article>", f"{LONG} 12.30 mix"),
    (f"<article><p>{LONG}</p><div class='share-buttons'>tweet</div><div class='adsbygoogle'>buy</div><ul id='relatedPosts'><li>x</ul></article>", LONG),
    ("<article><p>so <math><mi>e</mi><mo>=</mo><mspace width=1/><semantics><mrow><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow>"
     "<annotation encoding='application/x-tex'>e=mc^2</annotation></semantics></math> holds</p></article>", "so e=mc2 holds"),
]


@pytest.mark.parametrize("source,want", CLAIMED)
def test_class_words_do_not_delete_the_text(source, want):
    assert H.Page(source).text() == want


def test_claims_that_recur_are_deleted(spark):
    word = lambda i: " ".join(f"w{i}x{k}" for k in range(20))
    page = "<article><p>{}</p><ul class='share-whatever'><li>tell a friend</ul><div class='share-price'>{}</div></article>"
    rows = [(i, "http://h/x", page.format(word(i), i), None, None) for i in range(20)]
    assert {r.page_id: r.text for r in H.main_text(frame(spark, rows)).collect()} == {i: f"{word(i)} {i}" for i in range(20)}


def site(spark, seed=1):
    """Pages whose boilerplate no tag or class declares."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    para = lambda n: " ".join(word() for _ in range(n))
    shared = para(30)
    rows, want = [], {}
    for i in range(120):
        host = "big.example" if i % 3 else f"h{i % 4}.example"
        own = [para(rng.randrange(20, 80)) for _ in range(rng.randrange(2, 5))]
        if i % 5 == 0:
            own.insert(1, shared)               # a passage many articles share
        prose = "".join(f"<p>{p}</p>" for p in own)
        body = (f"<div><span>Site {host}</span><div>Home</div></div><article><h1>T{i}</h1>{prose}<div>Read more on {host}</div></article>"
                if i % 2 else f"<div><span>Site {host}</span><div>Home</div></div><h1>T{i}</h1><div>{prose}</div><div>Read more on {host}</div>")
        rows.append((i, f"https://u@{host.upper()}:8080/p{i}", f"<html><body>{body}</body></html>", "clash", 1))
        want[i] = " ".join([f"T{i}", *own])
    return rows, want


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, hashes int").repartition(4)


def test_templates_are_counted_per_host(spark):
    rows, want = site(spark)
    got = {r.page_id: r for r in H.main_text(frame(spark, rows)).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    # few pages of a host: nothing is a template
    few = {r.page_id: r.text for r in H.main_text(frame(spark, rows[:3])).collect()}
    assert few[1] == "T1 " + want[1].removeprefix("T1 ") + " Read more on big.example"


def test_equal_pages_do_not_delete_each_other(spark):
    page = "<article><h1>Same</h1><div><p>every word of it</p></div></article>"
    got = H.main_text(frame(spark, [(i, "http://h/x", page, None, None) for i in range(20)])).collect()
    assert {r.text for r in got} == {"Same every word of it"} and len(got) == 20


CONTRACT = [  # what is never the article goes inside one, however long
    (f"<article><h1>T</h1><p>short</p><section class='comments'><p>{LONG} {LONG}</p></section></article>", "T short"),
    (f"<article><p>short</p>{''.join(f'<div class=comment>{LONG}</div>' for _ in range(8))}</article>", "short"),
    (f"<article><p>short</p>{''.join(f'<div class=related>{LONG}</div>' for _ in range(6))}</article>", "short"),
    (f"<article><p>a</p><div class='ad-slot'>{LONG}</div></article>", "a"),
    (f"<article><div class='comments-and-content'><p>{LONG}</p></div></article>", LONG),
    (f"<article><div class='comment'><p>{LONG}</p></div></article>", LONG),      # nothing else: the text stays
]


@pytest.mark.parametrize("source,want", CONTRACT)
def test_comments_and_adverts_of_any_size(source, want):
    assert H.Page(source).text() == want


def varied(host, i, rng, comments=0, named=True):
    """A page whose menu, advert and footer change from page to page."""
    para = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    own = [para(rng.randrange(20, 60)) for _ in range(3)]
    thread = "".join(f"<div class='{'comment' if named else 'c7'}'><p>{para(25)}</p></div>" for _ in range(comments))
    return (f"<body><div class='top'><div>{para(8)}</div></div><div class='x1'>{para(6)}</div><div class='mid'><h1>{para(3)}</h1>"
            f"<div class='txt'>{''.join(f'<p>{p}</p>' for p in own)}</div>{thread}</div><div class='low'>{para(9)}</div></body>"), own


def test_frames_are_counted_by_shape(spark):
    """Nothing recurs in text and no tag or word declares it: the shapes do."""
    rng = random.Random(11)
    rows, want = [], {}
    for i in range(60):
        source, own = varied("h", i, rng, comments=6 if i % 2 else 2)
        rows.append((i, f"http://h{i % 2}.example/{i}", source, None, None))
        want[i] = " ".join(own)
    got = {r.page_id: r.text for r in H.main_text(frame(spark, rows)).collect()}
    for i, text in got.items():
        assert text.endswith(want[i]) and len(text) <= len(want[i]) + 21, (i, text)       # the headline stays
    few = {r.page_id: r.text for r in H.main_text(frame(spark, rows[:3])).collect()}
    assert all(len(t) > len(want[i]) + 21 for i, t in few.items())


def test_counting_alone_finds_the_text_of_the_tables(spark):
    """Without declared elements, names and articles the counted shapes give the
    text of nearly all pages; without the counts they give none of them."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    full = {r.page_id: r.text for r in H.main_text(pages).collect()}
    alone = {r.page_id: r.text for r in H.main_text(pages, declared=False).collect()}
    assert sum(alone[i] == t for i, t in full.items()) > 0.9 * len(full)
    bare = {r.page_id: H.Page(r.html, declared=False).text() for r in pages.where("page_id % 50 = 0").collect()}
    assert sum(bare[i] == full[i] for i in bare) == 0


def test_frame_of_a_host():
    shapes = [(1, 0, 1000, 10, 10, 0), (2, 1, 100, 10, 10, 1), (3, 1, 850, 10, 10, 1), (4, 1, 50, 10, 10, 0),
              (5, 3, 500, 60, 10, 1), (6, 3, 30, 10, 10, 1), (7, 3, 300, 10, 10, 2)]
    assert H.frame_of(shapes) == {2: 3, 7: 0}         # 4 is prose, 5 is repeated on its pages, so 6 beside it stays
    assert H.frame_of([(1, 0, 100, 10, 10, 0), (2, 1, 50, 10, 10, 1), (3, 1, 50, 10, 10, 1)]) == {}
    assert H.frame_of([]) == {}


def test_counts_against_brute_force(spark):
    rows, _ = site(spark, 2)
    df = frame(spark, rows).select("page_id", H._host(H.F.col("url")).alias("host"), "html")
    got = {r.host: set(r.hashes) for r in H.templates(df).collect()}
    host = {r.page_id: r.host for r in df.collect()}
    seen, pages = {}, {}
    for i, _, source, *_ in rows:
        pages[host[i]] = pages.get(host[i], 0) + 1
        for h in set(H.Page(source).subtrees()[1]):
            seen[host[i], h] = seen.get((host[i], h), 0) + 1
    want = {}
    for (h, x), n in seen.items():
        if n >= 4 and n >= (0.5 if x & 1 else 0.1) * pages[h]:
            want.setdefault(h, set()).add(x - (x >> 63 << 64))
    assert got == want and got


def test_odd_rows(spark):
    rows = [(1, None, None, "x", 1), (2, "no host", "<p>a", "x", 1), (2, "no host", "<p>a", "x", 1), (None, "http://h/", "", None, None),
            (3, "http://h", "x" * 300_000 + "<b>" * 10, None, 1)]
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in H.main_text(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, None, "", 0), (2, "no host", "a", 1), (2, "no host", "a", 1), (None, "http://h/", "", 0), (3, "http://h", "x" * 300_000, 300_000)], key=repr)
    assert H.main_text(frame(spark, []).limit(0)).count() == 0
