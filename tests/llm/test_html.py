import pytest

from wardline.llm import html_extract as H

CASES = [
    ("<div class=ad>x</div><p>A &amp; B<p>C <b>d</b>e<ul><li>1<li>2</ul><footer>f</footer>", "A & B\nC de\n1\n2"),
    ("<article><header><h1>T</h1></header><p>x <span class='ad'>buy</span> y</article><section class=comments><p>c"
     "</section>", "T\nx y"),
    ("<p>a<!-- x --> b<br>c &nbsp; d</p><script>if(a<b){}</script>tail <a href='", "a b c d\ntail"),
    ("", ""), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<article><div><p>q<div>z</div>r</div><table><tr><td>1<td>2<tr><td>3</table></article>", "q\nz\nr\n1\n2\n3"),
    ("<p title=\"a>b\">x</p><p title='un>y</p>z", "x\ny\nz"),
    ("<nav>m</nav><main><p>body &#233;&eacute;</p><aside>no</aside><form><p>no</form></main><p>out", "body éé"),
    ("<p hidden>no</p><div id=cookie-notice><p>no</div><div role=navigation>no</div><p>yes", "yes"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_page_by_itself(page, text):
    assert H.content(page) == text


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z") for i, u, h in rows],
                                 "page_id long, url string, html string, host string, page string, text string")


def test_template_of_a_host(spark):
    rows = []
    for i in range(12):
        body = "".join(f"<p>para {i} {k}</p>" for k in range(1 + i % 5))
        rows.append((i, f"http://User@Same.Example:80/{i}", f"<body><div><p>Welcome to our site</p><div>{body}</div>"
                                                            "<p>All rights reserved</p></div></body>"))
    rows += [(20 + i, "http://other.example/", "<p>Welcome to our site</p><p>only page</p>") for i in range(9)]
    rows += [(40, None, "<p>no url</p>"), (41, "http://same.example/x", None), (42, "http://same.example/y", ""),
             (43, "not a url", "<p>a</p>"), (43, "not a url", "<p>a</p>"), (44, "http://x/", "plain " * 20_000),
             (None, "http://x/", "<p>n</p>")]
    out = {}
    for r in H.extract(pages(spark, rows)).collect():
        assert r.n_chars == len(r.text)
        out.setdefault(r.page_id, []).append(r.text)
    for i in range(12):
        assert out[i] == ["\n".join(f"para {i} {k}" for k in range(1 + i % 5))]
    assert out[20] == ["Welcome to our site\nonly page"]  # equal pages are one page's evidence
    assert out[40] == ["no url"] and out[41] == [""] and out[42] == [""] and out[43] == ["a", "a"]
    assert out[44] == [("plain " * 20_000).strip()] and out[None] == ["n"]
    assert H.extract(pages(spark, [])).collect() == []


def test_tree_matching_keeps_order():
    def tree(*rows):
        return H.unflat([(d, s, []) for d, s in rows])

    a = tree((0, "#"), (1, "x"), (2, "p"), (1, "y"), (2, "q"), (2, "r"))
    b = tree((0, "#"), (1, "w"), (1, "x"), (2, "p"), (1, "y"), (2, "r"))
    memo, found = {}, {}
    assert H.match(a, b, memo) == 5
    H.mapping(a, b, memo, found)
    assert found == {0: 0, 1: 2, 2: 3, 3: 4, 5: 5}


PROSE = [f"Paragraph {k} of the one article that this host shows again and again, word for word." for k in range(4)]


@pytest.mark.parametrize("open_tag,close_tag", [("<article>", "</article>"), ("<div>", "</div>")])
def test_near_copies_are_one_article(spark, open_tag, close_tag):
    rows, want = [], {}
    for i in range(9):
        texts = [f"Title {i}", *PROSE]
        texts[1 + i % 4] = f"Paragraph changed on page {i}, long enough to be told from the others of the host."
        want[i] = "\n".join(texts)
        body = "".join(f"<p>{t}</p>" for t in texts)
        rows.append((i, f"http://copies.example/{i}", f"<body>{open_tag}{body}{close_tag}<div class=ad>buy {i}</div></body>"))
        rows.append((100 + i, f"http://adverts.example/{i}", f"<body>{open_tag}<p>Same text</p>{close_tag}"
                                                             f"<div class=ad>buy {i}</div></body>"))
        want[100 + i] = "Same text"
    assert {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()} == want


def test_marked_article_keeps_constant_paragraphs(spark):
    rows = [(i, f"http://h.example/{i}", f"<p>Menu</p><article><p>Same lead</p><p>news {i}</p></article>") for i in range(9)]
    rows += [(20 + i, f"http://h.example/{20 + i}", f"<p>Menu</p><div><p>old {i}</p></div>") for i in range(3)]
    out = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert all(out[i] == f"Same lead\nnews {i}" for i in range(9))
    assert all(out[20 + i] == f"old {i}" for i in range(3))


def test_template_of_small_hosts_and_second_layouts(spark):
    rows, want = [], {}
    for i in range(3):
        rows.append((i, f"http://small.example/{i}", f"<body><div><p>Welcome</p><div><p>small {i}</p></div></div></body>"))
        want[i] = f"small {i}"
    rows.append((10, "http://two.example/", "<body><section><table><tr><td>landing</table></section></body>"))
    want[10] = "landing"
    for i in range(11, 21):
        a = f"<body><div><p>Front</p><div><p>first {i}</p></div></div></body>"
        b = f"<body><section class=box><section><p>Hello</p></section><section class=text><p>second {i}</p></section></section></body>"
        rows.append((i, f"http://two.example/{i}", b if i % 3 else a))
        want[i] = f"second {i}" if i % 3 else f"first {i}"
    rows += [(30 + i, f"http://pair.example/{i}", f"<body><div><p>Lead</p><div><p>pair {i}</p></div></div></body>") for i in range(2)]
    want |= {30 + i: f"Lead\npair {i}" for i in range(2)}  # two pages do not tell template from content
    assert {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()} == want


def test_deep_pages(spark):
    rows = [(i, f"http://deep.example/{i}", "<div>" * 5000 + f"deep {i}<p>Foot</p>") for i in range(4)]
    out = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert out == {i: f"deep {i}" for i in range(4)}


def test_template_inside_marked_articles(spark):
    rows = [(i, f"http://m.example/{i}", f"<article><p>Same lead</p><p>news {i}</p><div><div>Read our letter</div></div></article>")
            for i in range(5)]
    rows += [(20 + i, f"http://n.example/{i}", f"<main><div>Notice {i // 4}</div><p>text {i}</p></main>") for i in range(5)]
    out = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert all(out[i] == f"Same lead\nnews {i}" for i in range(5))  # the slot of the letter holds nothing else
    assert all(out[20 + i] == f"Notice {i // 4}\ntext {i}" for i in range(5))  # a node whose text varies is no slot


def _plain_match(a, b):
    if a.sig != b.sig:
        return 0, {}
    best = {(0, j): (0, {}) for j in range(len(b.children) + 1)} | {(i, 0): (0, {}) for i in range(len(a.children) + 1)}
    for i, c in enumerate(a.children, 1):
        for j, d in enumerate(b.children, 1):
            n, pairs = _plain_match(c, d)
            both = (best[i - 1, j - 1][0] + n, best[i - 1, j - 1][1] | pairs)
            best[i, j] = next(x for x in (best[i - 1, j], best[i, j - 1], both)
                              if x[0] == max(best[i - 1, j][0], best[i, j - 1][0], both[0]))
    n, pairs = best[len(a.children), len(b.children)]
    return n + 1, pairs | {a.order: b.order}


def test_matching_is_the_plain_one_and_wide_lists_are_cheap():
    import random
    rng = random.Random(3)
    for _ in range(300):
        trees = []
        for _ in range(2):
            rows, depth = [(0, "#", [])], 0
            for _ in range(rng.randrange(12)):
                depth = rng.randrange(1, depth + 2)
                rows.append((depth, rng.choice("xyz"), []))
            trees.append(H.unflat(rows))
        memo, found = {}, {}
        size, pairs = _plain_match(*trees)
        assert H.match(*trees, memo) == size
        H.mapping(*trees, memo, found)
        assert found == pairs
    wide = [H.unflat([(0, "#", []), *((1, "ph"[k % 2], []) for k in range(n))]) for n in (10_000, 9_001)]
    assert H.Matching(*wide).size == 9_002
