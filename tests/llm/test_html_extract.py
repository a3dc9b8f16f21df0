import html
import re

from pyspark.sql import functions as F

from remitscope.llm import html_extract
from remitscope.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def plain(page):
    """The text between the article's tags; inline tags join, all others part blocks."""
    inside = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    inside = re.sub(r"<!--.*?-->", "", inside, flags=re.S)
    inside = re.sub(r"</?(?:b|a|i|em|strong|span)(?:\s[^>]*)?>", "", inside)
    blocks = re.split(r"<[a-zA-Z/][^>]*>", inside)
    return " ".join(filter(None, (" ".join(html.unescape(block).split()) for block in blocks)))


def test_articles_of_the_test_pages(spark):
    pages = table(spark, SF_DIR, "pages")
    wanted = {row.page_id: plain(row.html) for row in pages.collect()}
    found = {row.page_id: row for row in html_extract.extract(pages).collect()}
    assert {i: row.text for i, row in found.items()} == wanted
    assert all(row.n_chars == len(row.text) for row in found.values())


PAGE = """<!doctype html><html><head><title>T {i}</title><style>p {{}}</style></head><body>
<div id="top"><ul class="nav"><li><a href="/">Home {i}</a></li></ul></div>
<div id="content"><h1>Story {i}</h1><p>First &amp; best&nbsp;{i}<p>Second <b>bo</b>ld<br>line
</div><div class="comments"><p>Reader {i}</p></div><form><label>Mail</label></form>
<div class="site-footer">Imprint</div><script>if (a < b) document.write("<p>no</p>")</script></body></html>"""


def test_slots_of_a_deduced_template(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i=i)) for i in range(20)]
    found = {
        row.page_id: row.text
        for row in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    }
    assert found == {i: f"Story {i} First & best {i} Second bold line" for i in range(20)}


def test_template_holds_the_elements_that_stand_once_on_each_page(spark):
    rows = [(i, "http://a.example/x", PAGE.format(i=i)) for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    (row,) = html_extract.templates(pages).collect()
    assert row.host == "a.example"
    weights = {t.token: t.weight for t in row.template}
    slot = next(path for path in weights if path.endswith("div id=content"))
    assert weights[slot] > 10
    assert not any(path.endswith("/p") and "content" in path for path in weights)


def test_awkward_pages(spark):
    rows = [
        (1, "http://a.example/", None),
        (2, None, ""),
        (3, "no url", "just text &lt;b&gt; here"),
        (4, "http://a.example/", "<p>open <b>tags <i>everywhere"),
        (5, "http://b.example/", "</p></div>closing first<p>then text</div> and more"),
        (6, "HTTP://User@B.example:80/", "<article></article>"),
        (None, "http://c.example/", "<!-- only a comment"),
        (7, "http://c.example/", "<p>" + "word " * 100_000 + "</p>"),
        (7, "http://c.example/", "<p>" + "word " * 100_000 + "</p>"),
        (8, "http://c.example/", "a < b and c > d <script>x"),
        (9, "http://c.example/", "<div>" * 3000 + "deep" + "</div>" * 3000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(
        {name: F.lit("x") for name in ("host", "template", "text", "token", "template_host")}
    )
    found = [(row.page_id, row.text) for row in html_extract.extract(pages).collect()]
    assert len(found) == len(rows)
    texts = dict(found)
    assert texts[1] == texts[2] == texts[6] == texts[None] == ""
    assert texts[3] == "just text <b> here"
    assert texts[4] == "open tags everywhere"
    assert texts[5] == "closing first then text and more"
    assert texts[7] == ("word " * 100_000).strip()
    assert texts[8] == "a < b and c > d"
    assert texts[9] == "deep"
    assert html_extract.extract(pages.limit(0)).count() == 0


def texts_of(spark, template, n=20):
    rows = [(i, "http://a.example/x", template.format(i=i)) for i in range(n)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {row.page_id: row.text for row in html_extract.extract(pages).collect()}


def test_constant_text_around_the_slot_is_template(spark):
    page = (
        "<body>Welcome all<table><tr><td>Home</td><td>Shop</td></tr></table><div class='c7'>Call us</div>"
        "<div class='c8'><h2>Story</h2><p>Text {i}</p><p>Same everywhere</p></div><div class='widget'><p>Buy <b>now</b></div>"
    )
    assert texts_of(spark, page) == {i: f"Story Text {i} Same everywhere" for i in range(20)}
    damaged = "<body><div class='c7'>Call us</div><div class='c8'><p>Text {i}</p><div></div>"
    assert texts_of(spark, damaged) == {i: f"Text {i}" for i in range(20)}


def test_wrappers_with_any_class_keep_the_article(spark):
    for wrapper in ("wrapper has-sidebar", "with-sidebar", "story social-policy", "sidebar", "search menu", "no-ads"):
        page = f"<body><nav>Home</nav><div class='{wrapper}'><article><h1>T {{i}}</h1><p>One {{i}}</article></div>"
        assert texts_of(spark, page, 5) == {i: f"T {i} One {i}" for i in range(5)}
    for wrapper in ("with-sidebar", "story social-policy", "search"):
        page = (
            f"<body><div id='top'>Site name</div><div class='{wrapper}'><h1>T {{i}}</h1><p>Long text {{i}}</p>"
            "<p>more of it {i}</p></div><div class='foot'>Imprint</div>"
        )
        assert texts_of(spark, page, 5) == {i: f"T {i} Long text {i} more of it {i}" for i in range(5)}


REVISION = (
    "<body><div class='head'>The Paper</div>{open}<h1>Headline</h1><p class='lead'>The lead.</p><p>Body of all.</p>"
    "<p>Own end {i} of the text</p>{close}<div class='foot'>Imprint</div>"
)


def test_revisions_of_an_article_keep_headline_and_lead(spark):
    for tags in (("<article>", "</article>"), ("<div class='c1'>", "</div>"), ("<main><div>", "</div></main>")):
        page = REVISION.format(open=tags[0], close=tags[1], i="{i}")
        wanted = {i: f"Headline The lead. Body of all. Own end {i} of the text" for i in range(4)}
        assert texts_of(spark, page, 4) == wanted


def test_a_headline_before_the_slot_is_kept(spark):
    page = (
        "<body><div class='c0'>Site</div><div class='c1'><h1>Headline</h1><p class='by'>By A</p><div class='c2'>"
        "<p>The text {i} and more of it</p><p>and the end of text {i}</p></div><div class='c3'>More offers</div></div>"
    )
    wanted = {i: f"Headline By A The text {i} and more of it and the end of text {i}" for i in range(6)}
    assert texts_of(spark, page, 6) == wanted


def test_parts_of_an_article_that_are_no_text_go(spark):
    page = (
        "<body><article><header><h1>Title {i}</h1></header><p>One {i}</p><div class='ad'>Buy {i}</div>"
        "<aside>Side {i}</aside><p>Two</p><form>Mail {i}</form><div class='comments'><article class='c'>Reader {i}</article></div>"
        "<section id='comment-list'>Reader too {i}</section><footer>Filed {i}</footer></article><div class='comments'>"
        "<article>Third reader {i}</article></div>"
    )
    assert texts_of(spark, page, 6) == {i: f"Title {i} One {i} Two" for i in range(6)}


OWN_LAYOUTS = {
    "a.example": "<table><tr><td class='m1'>Menu of a</td><td class='x1'><h2>T{i}</h2>Some text {i} of a.</td><td class='m2'>Offers of a</td></tr></table>",
    "b.example": "<div class='q'>We are b</div><div class='r'><p>First {i} of b.</p><p>Second {i}.</p></div><ul><li><a href='/'>Home</a></li></ul>",
    "c.example": "<center>c since 1999</center><div><span>Text {i} of c</span><br>and more {i}</div><div class='z'>Contact c</div>",
}


def test_the_template_decides_where_no_element_is_named(spark):
    rows = [
        (i, f"http://{host}/{i}", f"<html><body>{page.format(i=i)}</body></html>")
        for host, page in OWN_LAYOUTS.items()
        for i in range(12)
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {(row.url, row.text) for row in html_extract.extract(pages).collect()}
    wanted = {(f"http://a.example/{i}", f"T{i} Some text {i} of a.") for i in range(12)}
    wanted |= {(f"http://b.example/{i}", f"First {i} of b. Second {i}.") for i in range(12)}
    wanted |= {(f"http://c.example/{i}", f"Text {i} of c and more {i}") for i in range(12)}
    assert found == wanted
    assert all(html_extract.main_text(page, {}) != text for _, url, page in rows for u, text in wanted if u == url)


def test_templates_too_large_to_broadcast_are_salted(spark, monkeypatch):
    rows = [(i, "http://a.example/x", REVISION.format(open="<div>", close="</div>", i=i)) for i in range(300)]
    rows += [(i, f"http://h{i % 7}.example/x", PAGE.format(i=i)) for i in range(300, 350)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)
    wanted = sorted(map(tuple, html_extract.extract(pages).collect()))
    monkeypatch.setattr(html_extract, "SMALL_TEMPLATES", 0)
    assert sorted(map(tuple, html_extract.extract(pages).collect())) == wanted


def test_pages_that_all_read_the_same_keep_their_text(spark):
    page = "<body><div class='c7'>Call us</div><div class='c8'>Story</div>"
    assert texts_of(spark, page) == {i: "Call us Story" for i in range(20)}


def test_words_of_a_class_take_nothing_from_an_article(spark):
    page = "<body><div class='notice'>Off {i}</div><article><p>One {i}<div class='notice'>Two {i}</div></article>"
    assert texts_of(spark, page) == {i: f"One {i} Two {i}" for i in range(20)}
