import re

import json

import pytest

from folioworks.config import Library, Options
from folioworks.operators.rest import admit_responses, decided_facts, deciding, rest_metadata, rest_page_lists, rest_pages
from folioworks.plans.batch import ArchiveRun, Landing
from folioworks.sources import landing as landed

SCHEMA = "document_id string, status int, error_class string, body string"


def _responses(spark, bodies):
    return spark.createDataFrame([(str(i), 200, None, b) for i, b in enumerate(bodies)], SCHEMA)


def _doc(**item):
    return json.dumps({"response": {"docs": [{k.replace("_", "."): v for k, v in item.items()}]}})


def test_metadata_kinds(spark):
    cases = [
        (_doc(dc_title="T", details=["S"]), "string", "T", "string", "S"),
        (_doc(dc_title=None), "missing", "", "missing", ""),
        (_doc(dc_title=42, details=[1]), "invalid", None, "invalid", None),
        (_doc(dc_title=False, details=[]), "invalid", None, "missing", ""),
        (_doc(dc_title=[], details=[None]), "invalid", None, "missing", ""),
        (_doc(dc_title={}, details=[["S"]]), "invalid", None, "invalid", None),
        (_doc(dc_title="", details="abc"), "string", "", "string", "a"),
        (_doc(dc_title="x", details=""), "string", "x", "missing", ""),
        (_doc(dc_title="x", details={"0": "y"}), "string", "x", "missing", ""),
        ('{"response":{"docs":[]}}', "missing", "", "missing", ""),
        ('{"response":"abc"}', "missing", "", "missing", ""),
        ("[]", "invalid", None, "invalid", None),
        ('"s"', "invalid", None, "invalid", None),
        (" null ", "missing", "", "missing", ""),
    ]
    rows = {r.document_id: r for r in rest_metadata(_responses(spark, [c[0] for c in cases])).collect()}
    for i, (body, title_kind, title, subtitle_kind, subtitle) in enumerate(cases):
        row = rows[str(i)]
        assert (row.title_kind, row.subtitle_kind) == (title_kind, subtitle_kind), body
        assert (row.part_title_kind, row.part_subtitle_kind) == (title_kind, subtitle_kind), body
        if title is not None:
            assert (row.title, row.part_title) == (title, title), body
        if subtitle is not None:
            assert (row.subtitle, row.part_subtitle) == (subtitle, subtitle), body


def _pages(*entries):
    return json.dumps({"response": {"docs": list(entries)}})


def _page(identifier, *number):
    return {"PID": identifier, "rels_ext_index": list(number)}


PAGE_CASES = [
    (_pages(_page("b", 1), _page("a", 0)), "ok", ["a", "b"]),
    (_pages(_page("a", 1), _page("b", 0), _page("c", 1)), "ok", ["b", "c"]),
    (_pages(_page("a", 1), _page("b", 1.0), _page("c", True)), "ok", ["c"]),
    (_pages(_page("a", 10), _page("b", 9), _page("c", -1.5)), "ok", ["c", "b", "a"]),
    (_pages({"PID": "a"}, _page("b"), {"PID": "c", "rels_ext_index": {"0": 1}}), "ok", ["c"]),
    (_pages(_page("a", "10"), _page("b", "9"), {"PID": "c", "rels_ext_index": "05"}), "ok", ["c", "a", "b"]),
    (_pages(), "empty", None),
    (_pages(_page("a", 1), _page(7, 2)), "error", None),
    (_pages(_page("a", 1), {"rels_ext_index": [2]}), "error", None),
    (_pages(_page("a", 1), "text"), "error", None),
    (_pages(_page("a", 1), {"PID": "b"}), "error", None),
    (_pages(_page("a", 1), _page("b", "2")), "error", None),
    (_pages(_page("a", [1])), "error", None),
    (_pages(_page("a", 2**60)), "ok", ["a"]),
    (_pages(_page("c", 2**53 + 1), _page("b", 2**53), _page("a", 2**53 - 1)), "ok", ["a", "b", "c"]),
    (_pages(_page("b", 10**37 + 1), _page("a", 10**37), _page("c", 10**37 + 1)), "ok", ["a", "c"]),
    (_pages(_page("b", 2**53 + 1), _page("a", 2.0**53), _page("c", 0.5), _page("d", -0.5)), "ok", ["d", "c", "a", "b"]),
    (_pages(_page("a", 10**40)), "error", None),
    ('{"response":{"docs":{}}}', "error", None),
    ('{"response":{}}', "error", None),
    ("[]", "error", None),
    ("null", "error", None),
    ("{bad", "error", None),
    ('{"response":{"docs":[]},"response":{"docs":[]}}', "error", None),
]


def test_page_lists(spark):
    lists = rest_page_lists(_responses(spark, [c[0] for c in PAGE_CASES]))
    rows = {r.document_id: r for r in lists.collect()}
    for i, (body, kind, pages) in enumerate(PAGE_CASES):
        row = rows[str(i)]
        assert row.rest_pages_kind == kind, body
        assert (None if row.rest_pages is None else [p.page_id for p in row.rest_pages]) == pages, body
    exploded = rest_pages(lists).collect()
    assert [r.page_index for r in exploded if r.document_id == "3"] == [1, 2, 3]
    assert not any(r.document_id == "6" for r in exploded)


def test_a_full_response_may_be_truncated(spark):
    full = _pages(*(_page(f"p{i}", 4000 - i) for i in range(4000)))
    less = _pages(*(_page(f"p{i}", i) for i in range(3999)))
    rows = {r.document_id: r for r in rest_page_lists(_responses(spark, [full, less])).collect()}
    assert rows["0"].maybe_truncated and not rows["1"].maybe_truncated
    assert rows["0"].rest_pages[0].page_id == "p3999" and len(rows["1"].rest_pages) == 3999


def test_the_last_attempt_decides(spark):
    good = _doc(dc_title="T")
    rows = [("a", 1, 500, None, None), ("a", 2, 200, None, good), ("b", 1, 200, None, good), ("b", None, 500, None, None),
            ("c", 2, None, "cert", None), ("c", 1, 200, None, good), ("d", 7, 200, None, good), ("d", 7, 200, None, good),
            (None, 1, 500, None, None), (None, 2, 200, None, good)]
    landed = spark.createDataFrame(rows, "document_id string, attempt int, status int, error_class string, body string")
    found = sorted((str(r.document_id), r.doc_state) for r in rest_metadata(deciding(landed)).collect())
    assert found == [("None", "ok"), ("a", "ok"), ("b", "ok"), ("c", "cert"), ("d", "ok")]
    assert deciding(landed.drop("attempt")).count() == len(rows)


def test_page_lists_do_not_shuffle(spark):
    plan = rest_pages(rest_page_lists(_responses(spark, ["{}"])))._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize(
    "document, pages, expected",
    [
        ((200, None, "{}"), (200, None, "{}"), "ok"),
        ((399, None, "[]"), (200, None, "1"), "ok"),
        ((400, None, "{}"), (200, None, "{}"), "error"),
        ((None, "cert", None), (500, None, "{}"), "cert"),
        ((500, None, "{}"), (None, "cert", None), "error"),
        ((None, "timeout", None), (None, "cert", None), "error"),
        ((200, None, "{bad"), (None, "cert", None), "cert"),
        ((200, None, "{bad"), (200, None, "{}"), "error"),
        ((200, None, "{}"), (200, None, ""), "error"),
        ((404, "cert", "{}"), (200, None, "{}"), "cert"),
        (None, (200, None, "{}"), "error"),
        ((200, None, "{}"), None, "error"),
    ],
)
def test_admission(spark, document, pages, expected):
    ids = spark.createDataFrame([("d",)], "document_id string")
    side = lambda row: spark.createDataFrame([("d", *row)] if row else [], SCHEMA)
    admitted = admit_responses(ids, rest_metadata(side(document)), rest_page_lists(side(pages)))
    assert [r.rest_status for r in admitted.collect()] == [expected]


def exchanged(df):
    """The columns that go through each exchange of the plan, the broadcasts left out."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    parts = re.split(r"\n\(\d+\) ", plan)
    return [re.search(r"Input \[\d+\]: \[(.*?)\]", part)[1] for part in parts if re.match(r"Exchange\b", part)]


def test_no_exchange_carries_a_body(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.createDataFrame([(i, f"https://a/uuid:{i}") for i in range(40)], "pos long, line string")
        tables = {}
        for name, schema in (("documents", landed.DOCUMENT_RESPONSES), ("pages", landed.PAGE_RESPONSES), ("html", landed.HTML_PAGES)):
            rows = [(f"uuid:{i % 50}", i // 50, 200, None, "{}") for i in range(80)]
            path = str(tmp_path / name)
            spark.createDataFrame(rows, schema).write.parquet(path)
            tables[name] = landed.read_landed(spark, path, schema)
        written = []

        class Run(ArchiveRun):
            def _stage(self, df, name):
                written.append((name, exchanged(df)))
                return super()._stage(df, name)

        landing = Landing(lines, tables["documents"], tables["pages"], tables["html"])
        run = Run(landing, (Library("A", ("https://a/",), "https://img.a/"),), Options(), "now",
                  work_dir=str(tmp_path / "work"), broadcast_bytes=0)
        assert run.documents.count() == 0 and run.failures.count() == 40
        read = {name: columns for name, columns in written if name.split("_")[-1] == "facts" or "_facts" in name}
        assert {"document_facts", "page_facts", "html_facts_1"} <= set(read)
        for name, columns in read.items():
            assert columns, name  # facts are dealt out
            assert not any(re.search(r"\b(body|html|_root|_html)#", c) for c in columns), (name, columns)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_are_those_of_the_last_attempt(spark):
    body = lambda t: '{"response":{"docs":[{"dc.title":"%s"}]}}' % t
    rows = [("a", 1, 200, None, body("old")), ("a", 3, 200, None, body("new")), ("a", 2, 500, None, None), ("b", 1, 200, None, body("only")),
            ("c", None, 200, None, body("first")), ("c", 0, 404, None, None), ("d", 1, 200, None, body("x")), ("d", 1, 200, None, body("x"))]
    df = spark.createDataFrame(rows, landed.DOCUMENT_RESPONSES).repartition(3)
    ids = spark.createDataFrame([("a",), ("c",), ("d",)], "document_id string")
    for few in (False, True):
        found = {r.document_id: (r.doc_state, r.title) for r in decided_facts(df, rest_metadata, ids, few).collect()}
        assert found == {"a": ("ok", "new"), "c": ("error", ""), "d": ("ok", "x")}
    assert decided_facts(df, rest_metadata).columns == rest_metadata(df.drop("attempt")).columns
    assert decided_facts(df, rest_metadata).count() == 4


def test_joins_of_bucketed_landings_move_nothing(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(f"uuid:{i}", 1, 200, None, "{}") for i in range(30)]
        df = spark.createDataFrame(rows, landed.DOCUMENT_RESPONSES).drop("attempt")
        documents, pages = (landed.bucketed_copy(df, "document_id", 4) for _ in range(2))
        ids = documents.select("document_id")
        admitted = admit_responses(ids, rest_metadata(documents), rest_page_lists(pages))
        assert exchanged(admitted) == [] and admitted.count() == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
