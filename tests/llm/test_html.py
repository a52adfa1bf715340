from orbweave.llm import html


def text_of(spark, pages, **more):
    rows = spark.createDataFrame([(i, u, h, "x", 1) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, text string, block int")
    return {r["page_id"]: r["text"] for r in html.extract(rows, **more).collect()}


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></ul></nav><div class="sidebar">Side</div><!-- <article>no</article> -->
<article class="post"><header><h1>Head &amp; line&nbsp;one</h1></header><p><b>First <i>part</i>
 of it.<br>Still first<p>Second &lt;b&gt; caf&eacute; &#8212; &copy 5&am</p><div class="share-box">Share</div><aside>Aside</aside>
<form><p>Mail</p></form><ul><li>Item 1<li>Item 2</ul><div id="comments"><p>Nice!</p></div></article>
<footer>Foot</footer><div class="cookie-notice">Cookies</div></body></html>"""


def test_marked_article(spark):
    got = text_of(spark, [("http://a.org/1", ARTICLE), ("http://a.org/2", "<main><h2>A</h2>b<table><tr><td>c<td>d</table></main><p>out"),
                          (None, "<div role='main'>only <span>this</span></div><div>not this</div>")])
    assert got[0] == "Head & line one\n\nFirst part of it. Still first\n\nSecond <b> café — © 5&am\n\nItem 1\n\nItem 2"
    assert got[1] == "A\n\nb\n\nc\n\nd"
    assert got[2] == "only this"


def test_wrappers_and_parts_of_an_article_stay(spark):
    body = "<article class='post ad-free'><header class='entry-header'><h1 class='header'>Title</h1></header><p>Body</p><section id='related-work'><h2 id='search'>Related</h2><p>Work</p></section>" \
           "<div class='social-history'>Social</div><p class='notice'>Note <span class='comment'>code</span></p><div class='share-box'>no</div><div id='comments'>no</div></article>"
    whole = "Title\n\nBody\n\nRelated\n\nWork\n\nSocial\n\nNote code"
    wrappers = ['<div class="layout has-sidebar">', '<div id="page" class="with-header">', '<div class="ad-free">', '<div class="header">', '<form id="aspnet">', '<div class="notice"><div class="widget">']
    got = text_of(spark, [("http://a.org/%d" % i, f"<nav>Menu</nav>{w}{body}") for i, w in enumerate(wrappers)]
                  + [("http://b.org/", "<div class='entry'><p>The body of this page is loose.</p></div><div class='sidebar'><article>Teaser</article></div>"),
                     ("http://c.org/", f"<div class='related'><article>Teaser</article></div>{body}")])
    assert [got[i] for i in range(len(wrappers))] == [whole] * len(wrappers)
    assert got[len(wrappers) + 1] == whole and "Teaser" not in html.page_blocks("<p>A longer text than that</p><div class='sidebar'><article>Teaser</article></div>")["article"]


def test_marks_without_text_and_articles_in_main(spark):
    got = text_of(spark, [("http://a.org/", "<div class='entry-content'><p>The body</p></div><article class='comment'><p>Nice</p></article>"),
                          ("http://b.org/", "<script>var s = '<main >';</script><p>The body</p>"), ("http://c.org/", "<main id='app'></main><!-- <article> --><p>The body</p>"),
                          ("http://d.org/", "<main><h1>Title</h1><p>One</p><article>Teaser</article><p>Two</p></main><p>out</p>"),
                          ("http://e.org/", "<article>Text</article><main>Rest</main>"), ("http://f.org/", "<article>A<main>B</main>C</article>"),
                          ("http://g.org/", "<main><nav>no</nav><article>A</article><article>B</article></main>"), ("http://h.org/", "<article class='comment'>only this</article>")])
    assert [got[i] for i in range(8)] == ["The body"] * 3 + ["Title\n\nOne\n\nTeaser\n\nTwo", "Text", "A\n\nB\n\nC", "A\n\nB", ""]


def test_elements_without_end_tags(spark):
    cases = [("<article><h1>T</h1><ul><li class='ad'>buy<li>one<li>two</ul><p>Body one.</p></article>", "T one two Body one."),
             ("<article><table><tr><td class='sidebar'>x<td>y<tr><td>z</table>k</article>", "y z k"), ("<article><dl><dt class='ad'>a<dd>b</dl><p class='ad'>x<p>y</article>", "b y"),
             ("<article><ul><li class='promo-box ad'>a<ul><li>in</ul>more<li>b</ul>z</article>", "b z"), ("<article><ol><li class='ad'>x</ol>end</article>", "end"),
             ("<article><div class='ad'><p>x</div><p>t</p></article>", "t"), ("<article><table><tr><td><div class='ad'>x<td>y</table>z</article>", "y z"),
             ("<article><p>one <div class='ad'>x</div>two</p>three</article>", "one two three"), ("<article><ul><li>a<p>b</li><li class='ad'>c<p>d</ul>e</article>", "a b e"),
             ("<article><p>a <span class='ad'>b<b>c</b></span> d<p>e <span class='ad'>f<p>g</article>", "a d e g"), ("<article>" + "<div>" * 30_000 + "x" + "</p></li>" * 30_000, "x")]
    got = text_of(spark, [(f"http://a.org/{i}", h) for i, (h, _) in enumerate(cases)])
    assert [got[i].replace("\n\n", " ") for i in range(len(cases))] == [t for _, t in cases]


def test_reader_comments_and_links_in_sentences(spark):
    page = "<article><p>a</p><section class='{0}'><p>no</p></section><p>See the <a class='share'>pages</a> here</p><a class='share'>Share</a></article>"
    names = ["post-comments", "user_comments", "reader-comments", "comments-section", "comments", "comment-list"]
    got = text_of(spark, [(f"http://a.org/{n}", page.format(n)) for n in names] + [("http://a.org/", page.format("has-comments"))])
    assert [got[i] for i in range(len(names))] == ["a\n\nSee the pages here"] * len(names)
    assert got[len(names)] == "a\n\nno\n\nSee the pages here"


def test_loose_text_against_the_rest_of_its_host(spark):
    page = "<div>Welcome to the site of all good things</div><p>{0} {0}a {0}b own {0}c words {0}d here</p><div>Made with care by the people of this place in {0}</div><p>short</p>"
    pages = [("http://h.org/%d" % i, page.format(f"year{i}")) for i in range(3)] + [("http://other.org", page.format("alone"))]
    got = text_of(spark, pages)
    assert got[1] == "year1 year1a year1b own year1c words year1d here"  # a block with one own word is covered by what repeats around it
    assert got[3].count("\n\n") == 3  # nothing repeats on its host
    plain = text_of(spark, [("http://q.org/1", "<p>a b c d e f g h</p><p>own text one</p>"), ("http://q.org/2", "<nav>x a b c d e f g h y</nav><article>z</article>")])
    assert plain == {0: "own text one", 1: "z"}  # dropped parts of other pages count


def test_copied_articles_survive(spark):
    import random

    rng = random.Random(3)
    paragraph = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))
    menu = "<div>Home News Sports Weather Jobs Contact Imprint</div><div>All rights reserved by the people of this place</div>"
    page = lambda *own: menu + "".join(f"<p>{o}</p>" for o in own)
    a, b, phrase = [paragraph() for _ in range(3)], paragraph(), "as the saying goes in this very old town"
    pages = [("http://two.org/a", page(*a)), ("http://two.org/a?utm=1", page(*a))]  # nothing else on this host
    pages += [("http://many.org/a", page(*a)), ("http://many.org/a?utm=1", page(*a)), ("http://many.org/print/a", "".join(f"<p>{o}</p>" for o in a)), ("http://many.org/a2", page(*a, b))]
    pages += [(f"http://many.org/{i}", page(paragraph(), phrase if i < 2 else paragraph(), "Summary" if i < 2 else f"Part {i}")) for i in range(20)]
    pages += [(f"http://own.org/{i}", f"<p>This line is on every page of the host and ends with words of page{i}x page{i}y page{i}z</p><p>{paragraph()}</p>") for i in range(4)]
    got = text_of(spark, pages)
    assert got[0] == got[1] and all(x in got[0] for x in a)
    assert [got[i] for i in (2, 3, 4, 5)] == ["\n\n".join(a)] * 3 + ["\n\n".join([*a, b])]
    assert phrase in got[6] and phrase in got[7] and "Summary" in got[6]  # on two of many pages
    assert all("Home" not in got[i] and "rights" not in got[i] for i in range(2, 26))
    assert all(got[26 + i].startswith(f"page{i}x page{i}y page{i}z\n\n") for i in range(4))


def brute_repeats(pages, depth, least, share):
    """{(host, run of ``depth`` tokens or whole shorter block): pages} of what repeats; ``pages``: (host, page, blocks)."""
    seen, total = {}, {}
    for host, page, blocks in pages:
        total.setdefault(host, set()).add(page)
        for t in (b.split(" ") for b in blocks):
            for i in range(max(1, len(t) - depth + 1)):
                seen.setdefault((host, tuple(t[i:i + depth])), set()).add(page)
    return {k: len(v) for k, v in seen.items() if len(v) >= max(2, min(least, len(total[k[0]])), share * len(total[k[0]]))}


def test_suffix_array_equals_brute_force(spark):
    import random

    import numpy as np

    rng = random.Random(8)
    pages, own = [], []
    for i in range(120):
        host, blocks = f"h{min(i % 7, 2)}.org", [" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14))) for _ in range(4)]
        copies = 1 + (i % 10 == 0)  # a copy is no other page
        pages += [(f"http://{host}/{i}/{c}", "".join(f"<p>{b}</p>" if j else f"<article>{b}</article>" for j, b in enumerate(blocks))) for c in range(copies)]
        own.append((host, tuple(blocks), blocks))
    rows = spark.createDataFrame([(1, *p) for p in pages], "page_id long, url string, html string")
    for least, share in ((2, 0.0), (3, 0.1)):
        want = brute_repeats(own, 4, least, share)
        runs = list(want)
        named = {}
        for host, run in runs:
            tokens, _ = html._words([" ".join(run)])
            (_, names) = html._suffixes(np.append(tokens, np.uint32(0)), 4)
            named[host, int(names[0])] = want[host, run]
        for size in ({}, {"piece_pages": 10}, {"limit": 100}, {"piece_pages": 25, "limit": 200}):  # whole hosts, hosts in parts
            got = {(r["host"], f["name"]): f["n"] for r in html.repeats(rows, 4, least, share, **size).collect() for f in r["found"]}
            assert got == named and len(got) > 20


def test_kept_blocks_equal_brute_force():
    import random

    import numpy as np

    rng = random.Random(5)
    for _ in range(300):
        blocks = [" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))) for _ in range(5)]
        runs = {tuple(rng.choice("ab") for _ in range(rng.choice((1, 2, 4)))) for _ in range(3)}
        streams = [np.append(html._words([" ".join(r)])[0], np.uint32(0)) for r in runs]
        names = np.sort(np.array([html._suffixes(s, 4)[1][0] for s in streams], np.int64))
        want = []
        for t in (b.split(" ") for b in blocks):
            cover = {j for i in range(max(1, len(t) - 3)) if tuple(t[i:i + 4]) in runs for j in range(i, min(i + 4, len(t)))}
            free = "".join(" " if i in cover else w for i, w in enumerate(t))
            want.append(" ".join(" ".join(r) for r in free.split() if len(r) >= html.OWN) if 2 * len(cover) >= len(t) else " ".join(t))
        assert html.kept_blocks(blocks, names, 4) == [w for w in want if w]


def test_what_repeats_in_marked_articles(spark):
    line = "Subscribe to our letter for more of these good stories"
    pages = [(f"http://a.org/{i}", f"<article><p>Story{i} has words{i} of its{i} own{i}</p><p>{line}</p><p>{line} by writer number{i} of{i} all{i} the{i} many{i} people{i} here{i} and{i} there{i} x{i} y{i} z{i} w{i}</p></article>") for i in range(6)]
    pages += [(f"http://b.org/{i}", f"<article><p>Story{i} is here</p><p>{line}</p></article>") for i in range(4)]  # too few pages against a marked article
    pages += [(f"http://c.org/{i}", f"<nav><a>World</a></nav><article><h1>World</h1><p>Day {i}</p></article>") for i in range(6)]  # a title like a menu's item
    got = text_of(spark, pages)
    assert got[12] == "World\n\nDay 2"
    assert got[2] == f"Story2 has words2 of its2 own2\n\n{line} by writer number2 of2 all2 the2 many2 people2 here2 and2 there2 x2 y2 z2 w2"
    assert got[7] == f"Story1 is here\n\n{line}"


def test_odd_rows(spark):
    long = "<article>" + "<p>word </p>" * 30_000 + "</article>"
    got = text_of(spark, [(None, None), ("", ""), ("not a url", "just text"), ("http://a/", "<p"), ("http://a/", "<div class='nav'>x"), ("http://a/", long),
                          ("http://a/", "<script>never closed <p>x"), ("http://a/", "<a href='x>y</a><p>z</p>"), ("http://b/", "<p>same line</p>"), ("http://b/", "<p>same line</p>")])
    assert len(got) == 10
    assert got[0] == got[1] == got[4] == got[6] == "" and got[2] == "just text" and len(got[5]) == 30_000 * 6 - 2
    assert got[8] == got[9] == "same line"  # repeated rows are one page
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(none).count() == 0


def test_given_pages(spark):
    import re
    from html import unescape

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in html.extract(rows).collect()}
    for r in rows.collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(unescape(re.sub("<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split("</?(?:h1|p)>", inner)]
        assert got[r["page_id"]]["text"] == "\n\n".join(p for p in parts if p)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])
