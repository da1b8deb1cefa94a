import random
import re
import time
from html.parser import HTMLParser

import pytest

from folioworks.config import DEFAULT_DOM, DomSearch, Step
from folioworks.operators.dom import dom_facts, dom_pages, dom_text

SCHEMA = "document_id string, status int, error_class string, html string"
SF = "/root/testdata/sf0.001"


def _html(spark, *pages):
    return spark.createDataFrame([(str(i), 200, None, p) for i, p in enumerate(pages)], SCHEMA)


def test_page_ids_are_distinct_in_page_order(spark):
    page = (
        '<div id="page-id-uuid:b"></div><DIV class=x ID=\'page-id-uuid:a\'></DIV><div id="other"></div>'
        '<div id="page-id-uuid:b"/><span id="page-id-uuid:c"></span><!-- <div id="page-id-uuid:d"> -->'
        '<script>"<div id=\'page-id-uuid:e\'>"</script><div data-id="page-id-uuid:f">'
        '<div title="> id=\'page-id-uuid:9\'" id=page-id-uuid:1></div><divx id="page-id-uuid:2">'
        '<div title="a id=page-id-uuid:3"></div><div id="no" id="page-id-uuid:4">'
    )
    row = dom_pages(_html(spark, page)).first()
    assert row.dom_pages == ["uuid:b", "uuid:a", "uuid:1", "uuid:4"] and row.dom_kind == "ok"


def test_page_kinds(spark):
    good = '<div id="page-id-uuid:a">'
    rows = [("a", 200, None, good), ("b", 404, None, good), ("c", None, "cert", None), ("d", None, "tls", None)]
    rows += [("e", 200, None, "<p>"), ("f", 200, None, None), ("g", 200, None, "")]
    found = {r.document_id: (r.dom_kind, r.dom_pages) for r in dom_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {
        "a": ("ok", ["uuid:a"]),
        "b": ("empty", []),
        "c": ("cert", None),
        "d": ("error", None),
        "e": ("empty", []),
        "f": ("empty", []),
        "g": ("empty", []),
    }


def test_texts_join_stripped_nodes(spark):
    steps = {"t": (Step("article"), Step("h1"))}
    cases = {
        "<article><h1> a <b>b</b>c</h1><h1>d</h1></article><h1>no</h1>": "a b c d",
        "<article><h1>a<b> </b>b</h1></article>": "a  b",
        "<article><h1>a<!-- x -->b &lt;i&gt;</h1></article>": "a b <i>",
        "<article><h1>&nbsp;a&amp;b&#160;</h1></article>": "a&b",
        "<article><p><b>x<br><h1>y</h1>": "y",
        "<article class='<h1>no</h1>'><h1 title='>'>z</h1></article>": "z",
        "<h1>out</h1>": "",
        "": "",
    }
    found = {r.document_id: r.t for r in dom_text(_html(spark, *cases), steps).collect()}
    assert [found[str(i)] for i in range(len(cases))] == list(cases.values())


BOOK = (
    '<html><body><app-root><main class="m app-wrapper"><app-book><div class="app-book-wrapper"><app-metadata '
    'class="app-book-metadata"><div><div class="no"><h1>no</h1></div><div class="x app-metadata-content"><h1>Title'
    "</h1><h2>Sub</h2><div></div><div><div><app-metadata><div><div><h1>Part</h1><h2>Part sub</h2></div></div>"
    "</app-metadata></div><div><app-metadata><div><div><h1>no</h1></div></div></app-metadata></div></div></div>"
    '</div></app-metadata></div></app-book></main></app-root><div class="app-metadata-content"><h1>no</h1></div>'
)


def test_default_selectors_tell_book_from_part(spark):
    row = dom_facts(_html(spark, BOOK)).first()
    assert (row.dom_title, row.dom_subtitle, row.dom_part_title, row.dom_part_subtitle) == (
        "Title",
        "Sub",
        "Part",
        "Part sub",
    )


def test_long_attributes_do_not_overflow_the_stack(spark):
    blob = "x" * 2_000_000
    page = f'<div data-a="{blob}" {"y=1 " * 50000} id="page-id-uuid:a">{"<p>" * 50000}</div><div {"z" * 500000}'
    assert dom_pages(_html(spark, page)).first().dom_pages == ["uuid:a"]
    nested = "<article>" + "<div>t" * 3000 + "<h1>deep</h1>" + "</div>" * 3000 + "</article>"
    assert dom_text(_html(spark, nested), {"t": (Step("article"), Step("h1"))}).first().t == "deep"


@pytest.mark.parametrize("depth", [1, 24, 25, 200])
def test_any_depth_ends_where_it_should(spark, depth):
    page = "<article>" + "<article>x" * depth + "</article>" * depth + "<h1>in</h1></article><h1>out</h1>"
    page += "<div>" * depth + "y" + "</div>" * depth + "<p>z"
    texts = dom_text(_html(spark, page), {"t": (Step("article"), Step("h1")), "d": (Step("div"),)}).first()
    assert (texts.t, texts.d) == ("in", "y")
    part = f"<div>{'<p>' * depth}<div>no</div><h1>yes</h1></div>"
    assert dom_text(_html(spark, part), {"t": (Step("div"), Step("h1", outside=("div",)))}).first().t == "yes"


def test_walks_over_random_tags(spark):
    """Outermost elements by a depth counter."""
    r = random.Random(8)
    pages, steps = [], {"all": (Step("div"),), "some": (Step("div", "k"),), "third": (Step("div", nth=3),), "rest": (Step("body"), Step("p", outside=("div",)))}
    want = []
    for n in [0, 1, 2, 63, 127, 128, 129, 256, 257, 700, 2000] * 2:
        tokens = [r.choice(["<div>", "<div class='k'>", "</div>", "</div>"]) for _ in range(n)]
        body = "".join(f"{t}{i}" for i, t in enumerate(tokens))
        pages.append(f"<body><p>{body}</p></body>")
        depth, spans, outside, start = 0, [], [], None
        for i, t in enumerate(tokens):
            if t != "</div>":
                if depth == 0:
                    start = i
                depth += 1
            elif depth:
                depth -= 1
                if depth == 0:
                    spans.append((start, i))
        closed = list(spans)
        if depth:
            spans.append((start, len(tokens)))
        inside = lambda a, b: " ".join(str(i) for i in range(a, b))
        # What is taken out leaves its neighbours side by side.
        covered, ends = {i for a, b in closed for i in range(a, b)}, {b for _, b in closed}
        rest = "".join((t if i not in ends else "") + str(i) for i, t in enumerate(tokens) if i not in covered)
        outside = " ".join(filter(None, re.split("<[^>]*>", rest)))
        texts = [inside(*s) for s in spans]
        want.append((" ".join(texts), " ".join(x for s, x in zip(spans, texts) if "k" in tokens[s[0]]), texts[2] if len(texts) > 2 else "", outside))
    found = {x.document_id: (x["all"], x.some, x.third, x.rest) for x in dom_text(_html(spark, *pages), steps).collect()}
    assert [found[str(i)] for i in range(len(pages))] == want


def test_siblings_cost_what_they_are(spark):
    """Eight times the elements take at most ten times as long."""
    steps = {"t": (Step("article"), Step("h1"))}
    took = {}
    for n in (500, 1000, 1000, 8000):
        pages = _html(spark, *(["<article><h1>x</h1></article>" * n] * 2)).repartition(1)
        started = time.perf_counter()
        assert dom_text(pages, steps).first().t == " ".join("x" * n)
        took[n] = time.perf_counter() - started
    assert took[8000] < 10 * took[1000]


def test_what_opens_first_is_the_noise(spark):
    page = (
        '<div id="page-id-uuid:a"></div><script>var x = "<!--";</script><div id="page-id-uuid:b"></div>'
        "<!-- <script> --><div id='page-id-uuid:c'></div><style>/* --> <!-- */</style><div id='page-id-uuid:d'></div>"
        '<!-- end --><div id="page-id-uuid:e">'
    )
    assert dom_pages(_html(spark, page)).first().dom_pages == [f"uuid:{x}" for x in "abcde"]


def test_tags_in_attributes_of_other_tags_are_no_tags(spark):
    page = "<article><p title='<h1>no</h1>'>t</p><h1 data-a=\"</h1>\">yes</h1><h1 x</article>"
    assert dom_text(_html(spark, page), {"t": (Step("article"), Step("h1"))}).first().t == "yes"


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found, self.headline, self.depth = [], [], 0

    def handle_starttag(self, tag, attrs):
        target = dict(attrs).get("href")
        if tag == "a" and target and target.startswith("/") and len(target) > 1 and target[1:] not in self.found:
            self.found.append(target[1:])
        self.depth += tag == "h1"

    def handle_endtag(self, tag):
        self.depth -= tag == "h1"

    def handle_data(self, data):
        if self.depth:
            self.headline.append(data)


def test_given_pages_agree_with_the_standard_parser(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").selectExpr(
        "cast(page_id as string) document_id", "200 status", "cast(null as string) error_class", "html"
    )
    search = DomSearch("a", "href", "^/(.+)$", {})
    links = {r.document_id: r.dom_pages for r in dom_pages(pages, search).collect()}
    texts = {r.document_id: r.t for r in dom_text(pages, {"t": (Step("article"), Step("h1"))}).collect()}
    for row in pages.collect():
        parser = _Links()
        parser.feed(row.html)
        parser.close()
        assert links[row.document_id] == parser.found
        assert texts[row.document_id] == "".join(parser.headline).strip()


def test_default_search_is_complete():
    assert set(DEFAULT_DOM.metadata) == {"title", "subtitle", "part_title", "part_subtitle"}
