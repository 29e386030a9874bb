"""Main text of pages: what the wrapper of a host decides, against plain readings of the same pages."""

import json
import time
import tracemalloc
from html.parser import HTMLParser

import pyarrow.parquet as pq
import pytest

from claimweave.llm import html_extract, queries


@pytest.fixture(scope="module", autouse=True)
def importable(spark):
    queries.reachable(spark)


class Article(HTMLParser):
    """Text inside <article>, blocks apart."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.parts.append("" if tag in ("a", "b") else " ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.parts.append("" if tag in ("a", "b") else " ")

    def handle_data(self, data):
        self.parts.append(data if self.depth else "")


def texts(spark, pages: dict[str, list[str]]) -> dict[str, list[str]]:
    made = [(k, f"http://{host}/{k}", page) for host, some in pages.items() for k, page in enumerate(some)]
    found = html_extract.extract_text(spark.createDataFrame(made, "page_id long, url string, html string")).collect()
    by = {(r.url.split("/")[2], r.page_id): r.text for r in found}
    assert len(by) == len(made)
    return {host: [by[host, k] for k in range(len(some))] for host, some in pages.items()}


def words(k, n=30):
    return " ".join(f"w{k}x{i}" for i in range(n))


def test_the_whole_small_table(spark, sf_dir):
    expected = []
    table = pq.read_table(f"{sf_dir}/pages.parquet").to_pydict()
    for page_id, page in zip(table["page_id"], table["html"], strict=True):
        reader = Article()
        reader.feed(page or "")
        reader.close()
        expected.append((page_id, " ".join("".join(reader.parts).split())))
    found = [(r.page_id, r.text) for r in queries.op5_html_extraction(spark, sf_dir).collect()]
    assert sorted(found) == sorted(expected) and any(t for _, t in found)


def test_the_wrapper_decides(spark):
    teasers = "<body><article class=card>card {}</article><div class=text><p>{}</p></div></body>"
    same = "<body><article><p class=by>Read all of our stories every day</p><p>{}</p></article></body>"
    menu = "<body><div class=links><a>One</a> <a>Two</a></div><div class=text><p>{}</p><p>{}</p></div></body>"
    found = texts(
        spark,
        {
            "teasers.example": [teasers.format(k, words(k)) for k in range(5)],
            "same.example": [same.format(words(k)) for k in range(5)],
            "menu.example": [menu.format(words(k), words(-k)) for k in range(5)],
        },
    )
    assert found["teasers.example"] == [f"card {k} {words(k)}" for k in range(5)]  # the tag holds less than the rest
    said = "Read all of our stories every day"
    assert found["same.example"] == [f"{said} {words(k)}" for k in range(5)]  # what is in the tag is the article's
    assert found["menu.example"] == [f"{words(k)} {words(-k)}" for k in range(5)]  # repeated, but constant as a whole


def test_words_around_whole_articles(spark):
    inner = "<nav>menu {0}</nav><div class=ad>buy {0}</div>"
    article = inner + "<article class='post widget'><p>{1}</p><div class=comments><article class=comment>no {1}</article></div></article>"
    plain = inner + "<h1>about {0}</h1><p>{1}</p>"
    made = {
        "a.example": "<body class='has-sidebar'>" + article + "</body>",
        "b.example": "<body><div class='page no-comments'>" + article + "</div></body>",
        "c.example": "<body><form id='aspnetForm'>" + article + "</form></body>",
        "d.example": "<body><div class='content-sidebar-wrap'>" + article + "</div><aside><article>other {0}</article></aside></body>",
        "e.example": "<body class='ad widget'>" + plain + "</body>",
        "f.example": "<body><div class='page no-comments'>" + plain + "</div></body>",
        "g.example": "<body><form id='aspnetForm'>" + plain + "</form></body>",
        "h.example": "<body><div class='content-sidebar-wrap'>" + plain + "</div><p>{0}</p></body>",
        "i.example": "<body><nav>menu {0}</nav><footer>{1}</footer></body>",
    }
    pages = {host: [page.format(k, words(k)) for k in range(4)] for host, page in made.items()}
    pages["alone.example"] = [made["g.example"].format(0, words(0))]
    found = texts(spark, pages)
    for host in ("a.example", "b.example", "c.example"):
        assert found[host] == [words(k) for k in range(4)], host
    assert all(t.startswith(words(k)) for k, t in enumerate(found["d.example"]))
    for host in ("e.example", "f.example", "g.example", "alone.example"):
        assert found[host] == [f"about {k} {words(k)}" for k in range(len(pages[host]))], host
    assert found["h.example"] == [f"about {k} {words(k)} {k}" for k in range(4)]
    assert found["i.example"] == [""] * 4


def test_text_of_one_page_is_kept(spark):
    plain = "<body><p class=slogan>Read us daily</p><div class=text><h1>{}</h1>{}<p>{}</p></div></body>"
    extra = "<blockquote>said once</blockquote><ul><li>first<li>second</ul><table><tr><td>cell</table>"
    dated = "<body><div class=date>day {}</div><div class=text><p>" + words(0) + "</p></div></body>"
    copied = plain.format("one", extra, words(1))
    found = texts(
        spark,
        {
            "once.example": [plain.format(f"title {k}", extra if k == 2 else "", words(k)) for k in range(5)],
            "two.example": [plain.format(f"title {k}", extra if k else "", words(k)) for k in range(2)],
            "copied.example": [copied, copied, plain.format("other", "", words(2))],
            "dated.example": [dated.format(k) for k in range(5)],
        },
    )
    said = "said once first second cell"
    assert found["once.example"] == [f"title {k} {said + ' ' if k == 2 else ''}{words(k)}" for k in range(5)]
    assert found["two.example"] == [f"title 0 {words(0)}", f"title 1 {said} {words(1)}"]
    assert found["copied.example"] == [f"one {said} {words(1)}"] * 2 + [f"other {words(2)}"]
    assert found["dated.example"] == [f"day {k} {words(0)}" for k in range(5)]


@pytest.mark.parametrize("pages", [1, 2, 4, 60])
def test_headings_do_not_depend_on_the_number_of_pages(spark, pages):
    inner = "<h1>Weekly report</h1><h2>Ingredients</h2><p>{0}</p><h2>Method</h2><p>{1}</p>"
    around = "<div class=top><a>One</a> <a>Two</a></div>{}<div class=low>Imprint</div>"
    made = {
        "tag.example": around.format(f"<article>{inner}</article>"),
        "div.example": around.format(f"<div class=text>{inner}</div>"),
    }
    found = texts(spark, {host: [page.format(words(k), words(-k - 1)) for k in range(pages)] for host, page in made.items()})
    whole = [f"Weekly report Ingredients {words(k)} Method {words(-k - 1)}" for k in range(pages)]
    assert found["tag.example"] == whole
    # One page alone does not tell what the host repeats.
    assert found["div.example"] == ([f"One Two {whole[0]} Imprint"] if pages == 1 else whole)


def test_class_words_inside_an_article_are_judged_by_element(spark):
    kept = (
        "<p class='share-price'>fell</p><table class='menu'><tr><td>soup</table><div class='search-results-discussion'>we saw</div>"
        "<section class='comments-on-the-law'>section</section><h2 class='notice'>Notice</h2><span class='ad-hoc'>plan</span>"
    )
    gone = (
        "<div class='share-buttons'>tweet</div><ul class='related-posts'><li>other</ul><div class='comments'>no</div><aside>aside</aside>"
        "<section id='newsletter'>sign up</section><div hidden>unseen</div><div class='ad'>buy</div>"
    )
    page = f"<body><article><p>{{}}</p>{kept}{gone}</article></body>"
    found = texts(spark, {"one.example": [page.format(words(k)) for k in range(5)]})
    assert found["one.example"] == [f"{words(k)} fell soup we saw section Notice plan" for k in range(5)]


@pytest.mark.parametrize(
    "broken",
    ["<a ", "<div>", "<div>x", '<a title="x ', "<b><p>x", "<nav>x", "<script ", "<li><span>x", "</p>", "<!-", "&amp;<", "<p class='ad'>x", "<table><b>"],
)
def test_a_megabyte_of_broken_markup(broken):
    """Time in proportion to the page, however deep it nests."""
    page = broken * (1_000_000 // len(broken))
    start = time.process_time()
    assert len(html_extract.main_text(page, json.dumps(html_extract.page_wrapper(page)))) <= len(page)
    assert time.process_time() - start < 60


@pytest.mark.parametrize("broken", ["<div>x", "<nav>x", "<a "])
def test_memory_of_broken_markup(broken):
    page = broken * (200_000 // len(broken))
    tracemalloc.start()
    html_extract.main_text(page, json.dumps(html_extract.page_wrapper(page)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80_000_000


def test_deep_pages_keep_their_text():
    page = "<div>" * 30_000 + "<article><p>deep text</p></article><nav>menu</nav>" + "</div>" * 30_000 + "<p>tail</p>"
    assert html_extract.main_text(page, None).startswith("deep text")
    assert html_extract.main_text("<nav>" * 20_000 + "x" + "</nav>" * 20_000 + "<p>the text of this page</p>", None) == "the text of this page"


def test_other_columns_do_not_clash(spark):
    made = [(1, "http://a.example/1", "<article>one</article>", "h", "w", "t", "i")]
    df = spark.createDataFrame(made, "page_id long, url string, html string, host string, wrapper string, text string, id string")
    assert [tuple(r) for r in html_extract.extract_text(df).collect()] == [(1, "http://a.example/1", "one", 3)]
