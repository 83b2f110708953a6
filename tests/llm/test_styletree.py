import pytest

from martloom.llm import styletree as st


def text_of(html):
    return st.main_text(st.parsed(html))


@pytest.mark.parametrize(
    "html, expected",
    [
        (None, ""),
        ("", ""),
        ("plain\n  words", "plain words"),
        ("<p>a &amp; b&#33; &lt;i&gt; &eacute;&nbsp;x</p>", "a & b! <i> é x"),
        ("<p>one<p>two<br>three</p><p> </p>", "one\ntwo three"),
        ("<div>a<b>b</b>c<div>d</div>e</div>", "abc\nd\ne"),
        ("<title>t</title><style>p{}</style><script>var t='</p>';</script><p>x</p>", "x"),
        ("<p>x</p><script>never closed <p>y</p>", "x"),
        ("<!-- <p>no</p> --><p>yes<!-- cut off", "yes"),
        ("<ul><li>a<li>b</ul>c", "a\nb\nc"),
        ("<p title='a > b'>x</p><p class=\"cut off", "x"),
        ("<p>x</b></p></div>y", "x\ny"),
        ("<nav><ul><li><a href=x>m</a></ul></nav><article><h1>T</h1><p>x</p></article><footer>f</footer>", "T\nx"),
        ("<div class='intro'>out</div><main><p>in the main part</p><div class='ad'>buy</div></main>", "in the main part"),
        ("<article><p>x</p><section id='comments'><article class='comment'>c</article></section></article>", "x"),
        ("<body class='nav-open'><header>h</header><div class='cookie-notice'>c</div><p>x</p></body>", "x"),
        ("<div id='header'>h</div><div class='post-header'><h1>T</h1></div><p>x</p>", "T\nx"),
        ("<form>f<input></form><div role=navigation>m</div><p hidden>h</p><p style='display: none'>i</p><p>x</p>", "x"),
        ("<article><header><h1>T</h1></header><p>x<aside>s</aside>y</p></article>", "T\nx\ny"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ],
)
def test_reading_a_page(html, expected):
    assert text_of(html) == expected


def test_blocks_that_repeat_in_an_article_stay():
    assert text_of("<article>" + "<p>same</p>" * 3 + "</article>") == "same\nsame\nsame"


def pages_of(rows, *data):
    return rows(list(data), "page_id long, url string, html string, n_chars string")


def test_the_tree_finds_what_a_host_repeats(rows):
    """Without any telling names: a bar and a line that all pages of a host share."""
    data = [
        (i, f"http://Host{i % 2}.org/p{i}", f"<div class=x1>Home News Help</div><div class=x2><p>story {i}</p>"
         f"<p>more of {i}</p></div><div class=x3>All rights kept</div>", None)
        for i in range(20)
    ]
    data.append((99, "http://single.org/", "<div class=x1>Home News Help</div><p>lonely</p>", None))
    got = {r.page_id: r.text for r in st.extract(pages_of(rows, *data)).collect()}
    assert got[3] == "story 3\nmore of 3" and got[18] == "story 18\nmore of 18"
    assert got[99] == "Home News Help\nlonely"


def test_copies_on_one_host_keep_their_text(rows):
    data = [(i, "http://a.org/x", "<article><p>the same</p></article>", None) for i in range(10)]
    data += [(10 + i, "http://b.org/x", "<div><p>the same</p></div>", None) for i in range(10)]
    got = st.extract(pages_of(rows, *data)).collect()
    assert len(got) == 20 and {r.text for r in got} == {"the same"}


def test_odd_rows(rows):
    long = "<p>" + "word " * 100_000 + "</p>" * 10
    data = [(1, None, None, "x"), (1, None, None, "x"), (2, "not a url", "", None), (None, "http://[bad", "<p>x", None),
            (3, "http://h.org/", long, None), (4, "http://h.org/", "<div>" * 3000 + "deep", None)]
    got = st.extract(pages_of(rows, *data))
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    by = sorted((r.page_id or 0, r.text[-4:], r.n_chars) for r in got.collect())
    assert by == [(0, "x", 1), (1, "", 0), (1, "", 0), (2, "", 0), (3, "word", 499_999), (4, "deep", 4)]
    assert st.extract(pages_of(rows)).count() == 0


def test_whole_pages_of_the_test_data(spark):
    import re

    from martloom.llm import queries

    rows = queries.op3_html(spark, "/root/testdata/sf0.01").collect()
    html = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(html)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inside)
        plain = [" ".join(st.entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        assert r.text == "\n".join(b for b in plain if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<div class='content has-sidebar'><p>x</p></div>", "x"),
        ("<div id='page-no-comments'><article><p>x</p></article></div>", "x"),
        ("<div class='sidebar-layout'><article>x</article><div class='sidebar'>s</div></div><p>longer</p>", "x\nlonger"),
        ("<div class='widget-page'><p>most of the text</p></div><div class='widget'>w</div>", "most of the text"),
        ("<div class='widgets'><p>most of the text</p></div><div class='widget'>w</div>", "most of the text"),
        ("<form id=all><p>a page inside a form</p></form><form>Find</form>", "a page inside a form"),
        ("<body class='comments-open'><p>text</p></body>", "text"),
        ("<div class='comments'><article class='comment'>c</article></div><p>text</p>", "text"),
        ("<p>text</p><div id='comments'><p>longer than the text itself</p></div>", "text"),
        ("<a class='btn main'>Read on</a><p>the text</p>", "Read on\nthe text"),
        ("<div class=a><article>the page's own</article></div><div class='related'><article>x</article></div>", "the page's own"),
    ],
)
def test_a_name_alone_does_not_empty_a_page(html, expected):
    assert text_of(html) == expected


def test_an_article_elsewhere_does_not_take_the_text():
    long = " ".join(f"Sentence {i} of the text." for i in range(40))
    page = f"<div id=content>{long}</div><div class=more><article>teaser</article></div>"
    assert text_of(page) == f"{long}\nteaser"


def by_page(got):
    return {r.page_id: r.text for r in got.collect()}


def test_the_tree_judges_branches_of_articles(rows):
    data = [
        (i, "http://h.org/", f"<main><div class=c1><p>story {i}</p><h2>Sources</h2><p class=unit>km</p></div>"
         f"<div class=c2><h3>About us</h3><p>We write.</p></div></main>", None)
        for i in range(12)
    ]
    assert by_page(st.extract(pages_of(rows, *data)))[5] == "story 5\nSources"
    alone = by_page(st.extract(pages_of(rows, *data[:3])))
    assert alone[2] == "story 2\nSources\nkm\nAbout us\nWe write."


def test_copies_do_not_make_their_parts_low(rows):
    """Ten copies are one page: what they share is not what the host's pages share."""
    copy = "<main><div class=c1>the same</div><div class=c2>everywhere</div></main>"
    data = [(i, "http://h.org/", copy, None) for i in range(10)]
    data += [(10 + i, "http://h.org/", f"<main><div class=c1>other {i}</div></main>", None) for i in range(12)]
    assert by_page(st.extract(pages_of(rows, *data)))[0] == "the same\neverywhere"


def test_the_host_settles_what_a_page_leaves_in_doubt(rows):
    """A sidebar that is most of one short page, and a wrapper that is little of one page."""
    side = [(i, "http://a.org/", f"<div class=c><p>{'long story ' * 20}{i}</p></div><div class=sidebar>links {i}</div>", None)
            for i in range(8)]
    side.append((8, "http://a.org/", "<div class=c><p>x</p></div><div class=sidebar>links eight</div>", None))
    wrap = [(20 + i, "http://b.org/", f"<div class=widget><p>{'long story ' * 20}{i}</p></div><p>note {i}</p>", None)
            for i in range(8)]
    wrap.append((28, "http://b.org/", "<div class=widget><p>x</p></div><p>note eight</p>", None))
    got = by_page(st.extract(pages_of(rows, *side, *wrap)))
    assert got[8] == "x" and got[28] == "x\nnote eight"


def test_verdicts_are_their_definition(rows):
    import math
    import random
    from collections import Counter, defaultdict

    rnd = random.Random(3)

    def page(i):
        top = rnd.choice(["", "<div class=a>fixed</div>", f"<div class=a>fixed {i % 3}</div>"])
        side = rnd.choice(["", "<div class=sidebar>" + "s " * rnd.randint(1, 30) + "</div>"])
        body = f"<section class=b><p>{rnd.randint(0, 9)}</p><p class=c>{rnd.choice('xy')}</p></section>"
        return top + rnd.choice([body, f"<main>{body}<div>end</div></main><div class=d>{'d ' * rnd.randint(1, 4)}</div>"]) + side

    data = [(i, f"h{rnd.choice('0012')}", page(i)) for i in range(200)]
    table = rows([(h, p) for _, h, p in data], "host string, html string")
    got = {tuple(r) for r in st.verdicts(table).collect()}

    nodes = defaultdict(list)
    for _, host, html in data:
        read = st.parsed(html)
        inside = st.branches(read)
        for path, *rest in st.style_nodes(read, inside):
            nodes[host, path].append((inside.content[0], *rest))

    def entropy(values):
        return -sum(c / len(values) * math.log(c / len(values)) for c in Counter(values).values())

    expected = set()
    for (host, path), found in nodes.items():
        whole, style, content, judged, in_article, held, needed = zip(*found)
        part = 0.9 * entropy(content) + 0.1 * entropy(style)
        bound = (0.1 if any(in_article) else 0.2) * entropy(whole)
        if all(judged) and math.exp(entropy(whole)) > 4 - 1e-9 and part < bound:
            expected.add((host, path, "low"))
        doubts = [(h, n) for h, n in zip(held, needed) if n is not None]
        if len(doubts) >= 4:
            stays = sum(h for h, _ in doubts) >= sum(n for _, n in doubts)
            expected.add((host, path, "stay" if stays else "go"))
    assert got == expected and {v for *_, v in got} == {"low", "stay", "go"}


def test_columns_of_any_name_stay(rows):
    table = rows([(1, "http://h.org/", "<p>x</p>", 1, 2, 3, 4, 5)],
                 "page_id long, url string, html string, host int, low int, stay int, go int, of int")
    assert st.extract(table).first().asDict() == {
        "page_id": 1, "url": "http://h.org/", "html": "<p>x</p>", "host": 1, "low": 2, "stay": 3, "go": 4,
        "of": 5, "text": "x", "n_chars": 1,
    }
