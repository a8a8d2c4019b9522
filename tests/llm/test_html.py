import pytest

from tessera.llm import html_extract as h

CASES = [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<article><h1>T &amp; U</h1><p>x\n\t y</p>", "T & U\nx y"),
    ("<nav><p>menu</p></nav><article><p><b>one<br><p>two</p></article><footer>&copy;</footer>", "one\ntwo"),
    ("<body><div class='ad'>buy</div><div id=content><p>text<script>var t='</p>'</script> more</p></div>", "text more"),
    ("<article>a<div class='comments'><p>first!</p></div><form>q</form>b</article>", "a\nb"),
    ("<article><p>cut <a href='x'>li", "cut li"), ("<p>a<!-- <p>no --> b &lt;c&gt; &#233;</p>", "a b <c> é"),
    ("<article><ul><li>1<li>2</ul><table><tr><td>3<td>4</table></article>", "1\n2\n3\n4"),
    ("<header>H</header><main><aside>s</aside><p>m</p></main>", "m"), ("<div hidden>x</div><p>y</p></div></p>", "y"),
    ("<p title='a>b'>ok</p", "ok"), ("<article>x</article><p>out</p><article>y</article>", "x\ny"), ("a < b > c", "a < b > c"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_blocks(page, text):
    assert h.main_text(page) == text


def test_deep_long_and_broken_pages():
    assert h.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert len(h.main_text("<p>word</p>" * 20000).split("\n")) == 20000
    assert h.main_text("<" * 5000) != None  # noqa: E711
    tree = h.skeleton(h.parse("<div>" * 5000 + "x"))
    assert sum(1 for _ in h.match(h.parse("<div>" * 4000), tree)) > 100
    flat = h.skeleton(h.parse("<p>a</p>" * 900))
    assert sum(1 for _ in h.match(h.parse("<p>b</p>" * 800), flat)) == 801


def test_constant_nodes_are_template_and_slots_are_content(spark):
    """No article element: the wrapper tells the repeated parts from the text."""
    def page(i):
        return (f"<body><div class='x'><p>Welcome to our site</p></div><div class='y'><h2>Title {i}</h2><p>Body {i}.</p>"
                f"{'<p>More.</p>' if i % 2 else ''}</div><div class='z'><p>All rights reserved</p></div></body>")

    rows = [(i, f"http://h.example/{i}", page(i), 1) for i in range(9)] + [
        (20, "http://other.example/", page(1), 1), (21, None, None, 1), (21, None, None, 1), (None, "x", "<p>n</p>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    found = h.extract(df).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r.text for r in found if r.page_id is not None}
    assert by[0] == "Title 0\nBody 0." and by[3] == "Title 3\nBody 3.\nMore."
    assert by[20] == "Welcome to our site\nTitle 1\nBody 1.\nMore.\nAll rights reserved" and by[21] == ""
    assert all(r.n_chars == len(r.text) for r in found)
    assert h.extract(df.limit(0)).collect() == []


def test_copies_of_a_page_keep_their_article(spark):
    page = "<nav>m</nav><article><h1>Same</h1><p>text</p></article>"
    df = spark.createDataFrame([(i, "http://h.example/", page) for i in range(12)], "page_id long, url string, html string")
    assert {r.text for r in h.extract(df).collect()} == {"Same\ntext"}


def test_matching_is_the_largest():
    page, ref = h.parse("<b>1</b><i>2</i><b>3</b><u>4</u>"), h.skeleton(h.parse("<i>x</i><b>y</b><u>z</u><b>w</b>"))
    assert sum(1 for _ in h.match(page, ref)) == 1 + 3


def test_end_tags_of_deep_elements_close_their_own():
    page = "<div id=w><article>" + "<div>" * 250 + "<p>deep</p>" + "</div>" * 250 + "<p>tail</p></article></div>"
    assert h.main_text(page) == "deep\ntail"
    page = "<article>" + "<p><font>a</p>" * 300 + "<div>b</div><p>tail</p><div><nav>menu</nav></div></article><p>out</p>"
    assert h.main_text(page).split("\n") == ["a"] * 300 + ["b", "tail"]
    assert h.main_text("<article>" + "<span>" * 400 + "<div>b</div><p>tail</p></article>") == "b\ntail"


def test_matching_of_long_lists_is_the_largest():
    """The first sibling's label stands last in the reference."""
    ref = h.skeleton(h.parse("<b>x</b><i>y</i>" * 150 + "<u>z</u>"))
    assert sum(1 for _ in h.match(h.parse("<u>z</u>" + "<b>x</b><i>y</i>" * 150), ref)) == 1 + 300
    rows = "".join(f"<div><p>{i}</p>{'<b>c</b>' * (i % 3)}</div><hr><ul></ul>" for i in range(250))
    ref = h.skeleton(h.parse("<ul></ul>" + rows))
    assert sum(1 for _ in h.match(h.parse(rows), ref)) == len(h.skeleton(h.parse(rows))[0])


def template(i, kind):
    if kind == "a":
        return f"<body><div class=top><p>Welcome</p></div><div class=text><p>Body {i}.</p></div></body>"
    return f"<body><section><h2>Shop</h2></section><section id=s><p>Item {i}</p></section><p>Prices in euro</p></body>"


def smallest_first(spark, htmls):
    """Pages of one host; the smallest hash of an id goes to the first html."""
    from pyspark.sql import functions as F

    ids = [r.id for r in spark.range(len(htmls)).orderBy(F.xxhash64("id")).collect()]
    rows = [(i, "http://h.example/", p) for i, p in zip(ids, htmls)]
    found = {r.page_id: r.text for r in h.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    return [found[i] for i in ids]


@pytest.mark.parametrize("first", [None, "", "<html><p>Not found</p>"])
def test_a_host_whose_first_page_has_no_content(spark, first):
    found = smallest_first(spark, [first] + [template(i, "a") for i in range(8)])
    assert found[1:] == [f"Body {i}." for i in range(8)]


def test_a_host_with_two_layouts_and_a_notice_that_one_page_lacks(spark):
    notice = "<div class=x><p>All rights reserved</p></div></body>"
    pages = [template(0, "a")] + [template(i, "a").replace("</body>", notice) for i in range(1, 9)]
    found = smallest_first(spark, pages + [template(i, "b") for i in range(6)])
    assert found == [f"Body {i}." for i in range(9)] + [f"Item {i}" for i in range(6)]


def neutral(html):
    """A page without structural tags, classes, ids and roles."""
    import re

    html = re.sub(r"(?i)<(/?)(article|main|nav|aside|footer|header|section|form|dialog|menu|button)\b", r"<\1div", html)
    return re.sub(r"\s(class|id|role)=(\"[^\"]*\"|'[^']*'|[^\s>]+)", "", html)


def test_slots_find_the_article_without_hints(spark):
    """Pages stripped of every hint: the wrapper alone decides, on all hosts
    with enough pages to learn from."""
    from collections import Counter

    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    want = {i: Counter(h.main_text(x).split("\n")) for i, _, x in rows}
    df = spark.createDataFrame([(i, u, neutral(x)) for i, u, x in rows], "page_id long, url string, html string")
    got = {r.page_id: Counter(r.text.split("\n")) for r in h.extract(df).collect()}
    hosts = Counter(u.split("/")[2] for _, u, _ in rows)
    assert not any(want[i] - got[i] for i in want)  # nothing is lost anywhere
    learnt = [i for i, u, _ in rows if hosts[u.split("/")[2]] >= h.MIN_PAGES]
    right = sum(sum((want[i] & got[i]).values()) for i in learnt)
    assert len(learnt) > 150 and right >= 0.95 * sum(sum(got[i].values()) for i in learnt)


def test_slots_weigh_words_outside_links(spark):
    """A long menu, a constant notice and a varying advert around the text."""
    words = lambda i, n: " ".join(f"w{(i * 37 + k * k) % 997}" for k in range(n))

    def page(i):
        menu = "".join(f"<li><a href='/{k}'>{words(i + k, 5)}</a></li>" for k in range(40))
        body = "".join(f"<p>{words(i * 7 + k, 20)}</p>" for k in range(2 + i % 4))
        return (f"<body><div><ul>{menu}</ul></div><div><p>{'All rights reserved by us. ' * 30}</p></div><div>{words(i, 12)}</div>"
                f"<div><h2>{words(i, 3)}</h2>{body}</div><div>{words(i + 1, 9)}</div></body>")

    df = spark.createDataFrame([(i, "http://h.example/", page(i)) for i in range(20)], "page_id long, url string, html string")
    for r in h.extract(df).collect():
        i = r.page_id
        assert r.text.split("\n") == [words(i, 3), *(words(i * 7 + k, 20) for k in range(2 + i % 4))]


def exhaustive(a, b):
    """Simple tree matching by definition: try every pairing of the children."""
    if a[0] != b[0]:
        return 0

    def best(xs, ys):
        if not xs or not ys:
            return 0
        return max(best(xs[1:], ys), best(xs, ys[1:]), exhaustive(xs[0], ys[0]) + best(xs[1:], ys[1:]))

    return 1 + best(a[1], b[1])


def test_alignment_is_as_large_as_exhaustive_matching():
    import random

    rng = random.Random(6)

    def tree(depth):
        return (rng.choice("biu"), [tree(depth - 1) for _ in range(rng.randint(0, 3))] if depth else [])

    def markup(t):
        return f"<{t[0]}>" + "".join(map(markup, t[1])) + f"</{t[0]}>"

    for _ in range(300):
        x, y = [tree(2) for _ in range(rng.randint(0, 4))], [tree(2) for _ in range(rng.randint(0, 4))]
        pairs = list(h.match(h.parse("".join(map(markup, x))), h.skeleton(h.parse("".join(map(markup, y))))))
        assert len(pairs) == exhaustive(("#", x), ("#", y))
