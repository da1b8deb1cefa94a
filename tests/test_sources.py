"""The search over several sources, against a walk with a remembered source written out."""

import random

import pytest

from folioworks.config import METADATA_FIELDS, Library, Options
from folioworks.operators.sources import QUESTIONS, Source, resolve_sources, unsettled
from folioworks.plans.batch import ArchiveRun, HtmlLanding, Landing, RestLanding
from folioworks.sources import landing as landed

SAID = "document_id string, answers array<struct<kind:string,value:string>>, page_count int, maybe_truncated boolean"


class Failed(Exception):
    pass


def walk(answers, explicit):
    """Page source or failure, texts and where they came from; ``answers`` by source, then question."""
    active = None

    def ask(source, question):
        nonlocal active
        kind, value = answers[source][question]
        if kind in ("error", "cert"):
            active = None
            raise Failed(kind)
        return value if kind == "ok" else ""

    def question(q):
        """The value, or the kinds of failures if nobody has one."""
        nonlocal active
        failures = []
        if active is not None:
            try:
                return ask(active, q), []
            except Failed as failed:
                failures.append(str(failed))
        for source in range(len(answers)):
            active = source
            try:
                if value := ask(source, q):
                    return value, []
            except Failed as failed:
                failures.append(str(failed))
        return "", failures

    pages = None
    if not explicit:
        active = 0
        value, failures = question(0)
        if not value:
            return ("certificate" if failures and set(failures) == {"cert"} else "no_pages"), None
        pages = active
    texts = []
    for q in range(1, len(QUESTIONS)):
        value, _ = question(q)
        texts.append((value, active))
    return pages, texts


@pytest.mark.parametrize("count", [1, 2, 3, 4])
@pytest.mark.parametrize("explicit", [False, True])
def test_the_fold_is_the_walk(spark, count, explicit):
    r = random.Random(count)
    kinds = ["ok", "ok", "empty", "error", "cert"]
    documents, tables = {}, [[] for _ in range(count)]
    for i in range(400):
        said = []
        for s in range(count):
            if r.random() < 0.1:  # nothing landed
                said.append([("error" if s == 0 else "empty", "")] * len(QUESTIONS))
                continue
            mine = [(k, f"{s}.{q}" if k == "ok" else "") for q, k in enumerate(r.choice(kinds) for _ in QUESTIONS)]
            said.append(mine)
            tables[s].append((f"d{i}", mine, s + 10, s == 1))
        documents[f"d{i}"] = said
    for table in tables:
        table.append(("unasked", [("ok", "x")] * len(QUESTIONS), 1, False))
    sources = [Source(f"s{s}", spark.createDataFrame(t, SAID).repartition(3), "error" if s == 0 else "empty")
               for s, t in enumerate(tables)]
    ids = spark.createDataFrame([(d,) for d in documents], "document_id string")
    got = {x.document_id: x for x in resolve_sources(ids, sources, ["p"] if explicit else None).collect()}
    assert set(got) == set(documents)
    open_ = {x.document_id for x in unsettled(ids, sources[:-1], explicit).collect()}
    for d, said in documents.items():
        pages, texts = walk(said, explicit)
        row = got[d]
        if texts is None:
            assert (row.pages_source, row.failure_class, row.page_count) == (None, pages, None)
            continue
        assert (row.pages_source, row.page_count) == (("explicit", 1) if explicit else (f"s{pages}", pages + 10))
        assert row.failure_class is None and row.maybe_truncated == (pages == 1)
        assert [row[f] for f in METADATA_FIELDS] == [v for v, _ in texts]
        assert [row[f"{f}_source"] for f in METADATA_FIELDS] == [None if a is None else f"s{a}" for _, a in texts]
        # Whatever came from the last source, that source was wanted.
        if pages == count - 1 or any(a == count - 1 for _, a in texts):
            assert d in open_ or count == 1


LIBRARIES = (Library("A", ("https://a/",), "https://img.a/"),)


def _pages(spark, rows):
    return spark.createDataFrame(rows, landed.HTML_PAGES)


def test_a_run_with_a_browser_and_plain_requests(spark, tmp_path):
    head = ('<app-root><main class="app-wrapper"><app-book><div class="app-book-wrapper"><app-metadata class="app-book-metadata">'
            '<div><div class="app-metadata-content"><h1>{}</h1></div></div></app-metadata></div></app-book></main></app-root>')
    page = '<div id="page-id-uuid:{}"></div>'
    lines = [f"https://a/uuid:{i}" for i in range(1, 6)]
    browser = [("uuid:1", 1, 200, None, page.format("a") + head.format("seen")), ("uuid:2", 1, None, "cert", None),
               ("uuid:3", 1, 200, None, "<p>"), ("uuid:4", 1, 200, None, page.format("b"))]
    plain = [("uuid:1", 1, 200, None, page.format("no")), ("uuid:2", 1, 200, None, page.format("c") + page.format("d") + head.format("plain")),
             ("uuid:3", 1, None, "cert", None), ("uuid:4", 1, 200, None, head.format("late")), ("uuid:5", 1, None, "refused", None)]
    rest = RestLanding(spark.createDataFrame([(f"uuid:{i}", 1, None, "cert", None) for i in range(1, 6)], landed.DOCUMENT_RESPONSES),
                       spark.createDataFrame([], landed.PAGE_RESPONSES))
    landing = Landing(
        url_lines=spark.createDataFrame(list(enumerate(lines)), "pos long, line string"),
        sources=[rest, HtmlLanding(_pages(spark, browser)), HtmlLanding(_pages(spark, plain), name="plain", reports_failures=True)])
    run = ArchiveRun(landing, LIBRARIES, Options(), "now", work_dir=str(tmp_path / "work"))
    found = {r.document_id: (r.pages_source, r.failure_class, r.title, r.title_source) for r in run.resolved.collect()}
    assert found["uuid:1"] == ("dom", None, "seen", "dom")
    assert found["uuid:2"] == ("plain", None, "plain", "plain")
    assert found["uuid:3"][:2] == (None, "certificate")
    assert found["uuid:4"] == ("dom", None, "", "dom")  # the browser answered, if with nothing
    assert found["uuid:5"][:2] == (None, "no_pages")
    assert [(r.doc_key, r.page_id) for r in run.pages.orderBy("doc_key", "page_index").collect()] == [
        (0, "uuid:a"), (1, "uuid:c"), (1, "uuid:d"), (3, "uuid:b")]
    # The plain pages of a document that the browser settled are not read.
    assert {r.document_id for r in run.facts[2].source.said.collect()} == {"uuid:2", "uuid:3", "uuid:5"}
