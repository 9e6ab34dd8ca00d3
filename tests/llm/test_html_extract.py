from __future__ import annotations

import html
import re

import pytest

from roomlens.llm import html_extract
from tests.conftest import SMALL_DIR

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p", ""),
    ("<p>a<b>c</b>  d<br>e<p>f&amp;g&nbsp;h<ul><li>i<li>j</ul>", "ac d e\nf&g h\ni\nj"),
    ('<script>var a="</p>";</script><style>p{}</style><p>x</p><!-- no --><textarea><p>n</textarea>', "x"),
    ("<body class='menu'><main><p>in</p><aside>out</aside></main><p>after</p>", "in"),
    ('<article><h1>T</h1><div class="ad">no</div><p>y</p><section id="comments"><p>no</p></section></article>', "T\ny"),
    ('<article><p>a</p></article><article class="comment"><p>no</p></article>', "a"),
    ("<header><h1>Site</h1></header><p>text</p><footer>no</footer><form>no</form>", "Site\ntext"),
    ("<article><header><h1>T</h1><span>by x</span></header><p>a &lt;b&gt;</p></article>", "T\na <b>"),
    ("<p title=\"a>b\">q</p><P>r</P></div>", "q\nr"), ("<div>" * 3000 + "deep", "deep"),
])
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


def site(host, count, extra=""):
    return [
        (f"http://{host}/{i}", f"<body><div><p>Our motto</p></div><p>story {host} number {i}</p>{extra}</body>") for i in range(count)
    ]


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_recurring_subtrees_go_by_host(spark, broadcast):
    pages = site("a.org", 30) + site("user@B.org:80", 3) + [("no host", "<p>Our motto</p>"), (None, None)]
    rows = [(i, *p) for i, p in enumerate(pages)] + [(0, *pages[0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", host int, text string")
    found = html_extract.extract(df, max_broadcast_bytes=broadcast)
    assert found.columns == ["page_id", "url", "text"] and found.count() == len(rows)
    texts = {r.page_id: r.text for r in found.collect()}
    assert texts[4] == "story a.org number 4"
    assert texts[31] == "Our motto\nstory user@B.org:80 number 1"  # seldom on its host
    assert texts[33] == "Our motto" and texts[34] == ""
    assert html_extract.extract(df.limit(0)).count() == 0


def test_an_article_is_never_a_template(spark):
    page = "<nav>menu</nav><article><h1>Same</h1><p>copied text</p></article>"
    df = spark.createDataFrame([(i, "http://h.org/", page) for i in range(40)], SCHEMA)
    assert {r.text for r in html_extract.extract(df).collect()} == {"Same\ncopied text"}


@pytest.mark.parametrize("folder", [SMALL_DIR, "/root/testdata/sf0.1"])
def test_given_pages(spark, folder):
    """Every page's text is its cut-out article, however many pages a host has."""
    df = spark.read.parquet(f"{folder}/pages.parquet")
    pages = {r.page_id: r.html for r in df.collect()}
    compared = 0
    for row in html_extract.extract(df).collect():
        article = re.search(r"<article>(.*?)</article>", pages[row.page_id], re.DOTALL)
        if not article:
            continue
        blocks = re.split(r"</?(?:p|h1)>", article[1].replace("<br>", " "))
        wanted = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert row.text == "\n".join(b for b in wanted if b)
        compared += 1
    assert compared == len(pages)


ARTICLE = (
    '<article><ul class="x"><li><a href="/">Up</a></li><li><a href="/t">Topics</a></li></ul><h1>Story {0}</h1>'
    "<p>It is <em>not</em> about {0}.</p><table><tr><td>Yes</td><td>{0}</td></tr></table><h2>Method</h2>"
    "<ul><li>2 eggs</li><li>salt</li></ul><p>Share this with friends</p><p><a>See also</a></p>"
    "<x-box><a>Join us</a></x-box><div>or <button>Sign up here</button></div></article>"
)
BODY = "Story {0}\nIt is not about {0}.\nYes\n{0}\nMethod\n2 eggs\nsalt\nShare this with friends\nSee also"


@pytest.mark.parametrize("count", [10, 2000])
def test_link_blocks_at_the_ends_of_articles_go(spark, count):
    rows = [(i, f"http://h.org/s/{i}", ARTICLE.format(f"n{i}")) for i in range(count)]
    rows += [(10_000 + i, f"http://h.org/copy{i}", "<main><p>told again</p><div><a>by many</a></div></main>") for i in range(20)]
    rows += [(20_000 + i, f"http://few.org/{i}", ARTICLE.format(f"n{i}")) for i in range(3)]
    rows += [(30_000 + i, f"http://h.org/rare/{i}", f"<article><p>r{i}</p></article>") for i in range(7)]
    rows += [(40_000 + i, f"http://h.org/rare/x{i}", ARTICLE.format(f"x{i}")) for i in range(6)]
    texts = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(texts[i] == BODY.format(f"n{i}") for i in range(count))
    assert all(texts[10_000 + i] == "told again\nby many" for i in range(20))  # copies of one article
    whole = "Up\nTopics\n" + BODY + "\nJoin us\nor Sign up here"
    buttons = whole.replace("or Sign up here", "or")  # a button is no text anywhere
    assert all(texts[20_000 + i] == buttons.format(f"n{i}") for i in range(3))  # too few
    assert all(texts[40_000 + i] == buttons.format(f"x{i}") for i in range(6))  # below half of their section


def test_recipes_keep_every_line(spark):
    page = (
        "<article><h1>Cake {0}</h1><p>Text {0}</p><h2>Ingredients</h2><ul><li>2 eggs</li><li>salt</li><li>item {0}</li></ul>"
        "<h2>Method</h2><p>Bake well.</p><pre>import os</pre><blockquote>To be or not to be.</blockquote><p>end {0}</p></article>"
    )
    df = spark.createDataFrame([(i, f"http://r.org/{i}", page.format(i)) for i in range(6)], SCHEMA)
    wanted = "Cake {0}\nText {0}\nIngredients\n2 eggs\nsalt\nitem {0}\nMethod\nBake well.\nimport os\nTo be or not to be.\nend {0}"
    assert {r.page_id: r.text for r in html_extract.extract(df).collect()} == {i: wanted.format(i) for i in range(6)}


@pytest.mark.parametrize("page, text", [
    ('<article class="post category-social tag-newsletter"><p>a</p></article>', "a"),
    ('<article class="social"><p>a</p></article>', "a"),
    ('<div id="page" class="no-sidebar"><article><p>a</p></article></div>', "a"),
    ('<div class="right-sidebar"><p>a</p></div>', "a"),
    ('<div class="wide sidebar"><main><p>a</p><div class="x share">no</div></main></div>', "a"),
    ('<article class="comment"><p>a</p></article>', "a"),
    ('<div class="sidebar"><article><p>a</p></article><article class="comment">no</article></div>', "a"),
    ('<main><p>a</p></main><div class="related-posts"><article><p>no</p></article></div>', "a"),
    ('<article><p>a</p><div class="reader-comments">no</div><div class="alert alert-info">no</div></article>', "a"),
    ('<article><p>a</p><div class="commentary">b</div><p class="alerted">c</p></article>', "a\nb\nc"),
    ('<article><p>a</p><div class="share-buttons">no</div><p class="menu">no</p></article>', "a"),
])
def test_class_names_count_as_whole_words(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_templates_do_not_depend_on_the_size_of_the_host(spark, broadcast):
    menu = "<div><p>Section menu</p></div>"
    pages = site("big.org", 1500) + [(f"http://big.org/s{i}", f"<body>{menu}<p>section page {i}</p></body>") for i in range(20)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], SCHEMA)
    texts = {r.page_id: r.text for r in html_extract.extract(df, max_broadcast_bytes=broadcast).collect()}
    assert [texts[1500 + i] for i in range(20)] == [f"section page {i}" for i in range(20)]


@pytest.mark.parametrize("depth", [500, 100_000])
def test_deep_nesting_keeps_end_tags_matched(depth):
    page = (
        "<div><article><p>before</p>" + "<div>" * depth + "<nav>menu<div>menu</div></nav><form>no</form>deep"
        + "</div>" * depth + "<p>after</p></article></div><p>outside</p>"
    )
    assert html_extract.main_text(page, {1}) == "before\ndeep\nafter"
    assert html_extract.template_candidates(page)
