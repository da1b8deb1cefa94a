"""Whole runs: the batch plan with and without staging, streams, the manifest sink."""

import os

import pytest

from folioworks.config import Library, OptionLayer, Options
from folioworks.plans.batch import ArchiveRun, Landing
from folioworks.sources import landing as landed
from folioworks.streaming.intake import stream_documents, stream_outcomes

LIBRARIES = (Library("A", ("https://a/",), "https://img.a/"), Library("B", ("https://b/",), "https://img.b/"))


def _landing(spark):
    lines = ["https://b/uuid:1", "https://a/uuid:2", "# x", "https://z/uuid:1", "https://a/none", "https://a/uuid:3", "https://b/uuid:1"]
    body = '{"response":{"docs":[{"PID":"p2","rels_ext_index":[5]},{"PID":"p1","rels_ext_index":[2]}]}}'
    return Landing(
        url_lines=spark.createDataFrame(list(enumerate(lines)), "pos long, line string"),
        document_responses=spark.createDataFrame(
            [("uuid:1", 2, 200, None, '{"response":{"docs":[{"dc.title":"One"}]}}'), ("uuid:1", 1, 500, None, None),
             ("uuid:2", 1, None, "cert", None), ("uuid:77", 1, 200, None, "{not wanted")],
            landed.DOCUMENT_RESPONSES,
        ),
        page_responses=spark.createDataFrame([("uuid:1", 1, 200, None, body)], landed.PAGE_RESPONSES),
        html_pages=spark.createDataFrame(
            [("uuid:1", 1, 200, None, '<div id="page-id-uuid:no">'), ("uuid:2", 1, 404, None, "")], landed.HTML_PAGES
        ),
    )


@pytest.mark.parametrize("staged", [False, True])
def test_batch_run(spark, tmp_path, staged):
    options = Options(shared=OptionLayer(subfolder="img"))
    run = ArchiveRun(_landing(spark), LIBRARIES, options, "now", work_dir=str(tmp_path / "work") if staged else None)
    failures = {r.pos: r.reason for r in run.failures.collect()}
    assert failures == {1: "certificate", 3: "unsupported_library", 4: "no_identifier", 5: "no_pages"}
    documents = {r.doc_key: (r.title, r.page_count, r.dir_granted) for r in run.documents.collect()}
    assert documents == {0: ("One", 2, True), 6: ("One", 2, False)}
    assert run.urls.count() == len(failures) + len(documents)
    pages = [(r.doc_key, r.page_index, r.page_id, r.output_base) for r in run.pages.orderBy("page_index").collect()]
    folder = "output/B/uuid_1_One/img/"
    assert pages == [(0, 1, "p1", folder + "page_001_p1"), (0, 2, "p2", folder + "page_002_p2")]
    attempts = spark.createDataFrame([(0, 1, True, False, 0, "", "", False)], landed.ATTEMPTS)
    report = run.report(attempts)
    assert [tuple(r) for r in report.outcomes.collect()] == [(0, 1, 0, 1)]
    assert tuple(report.verdict.first()) == (6, 6, 1)
    assert {r.library_name: r.documents for r in report.libraries.collect()} == {"A": 0, "B": 2}
    landed.write_manifest(run.manifest, str(tmp_path / "manifest"))
    assert [d for d in os.listdir(tmp_path / "manifest") if d.startswith("library")] == ["library_name=B"]


def test_an_explicit_run_parses_no_rest_answer_and_leaves_nothing(spark, tmp_path):
    work = tmp_path / "work"
    run = ArchiveRun(_landing(spark), LIBRARIES, Options(), "now", explicit_pages=["x"], work_dir=str(work))
    assert run.pages.count() == 3
    assert not {"document_facts", "page_facts"} & set(os.listdir(work))
    run.close()
    assert not work.exists()


def test_counts_read_no_page_lists(spark, tmp_path):
    run = ArchiveRun(_landing(spark), LIBRARIES, Options(), "now", work_dir=str(tmp_path / "work"))
    plan = run.resolved.select("document_id", "page_count")._jdf.queryExecution().executedPlan().toString()
    assert "rest_pages:array" not in plan and "dom_pages:array" not in plan


def test_explicit_pages_go_to_every_document(spark):
    run = ArchiveRun(_landing(spark), LIBRARIES, Options(), "now", explicit_pages=["x", "y"])
    found = {(r.doc_key, r.page_index): r.page_id for r in run.pages.collect()}
    assert found == {(k, i): p for k in (0, 1, 5) for i, p in ((1, "x"), (2, "y"))}
    none = ArchiveRun(_landing(spark), LIBRARIES, Options(), "now", explicit_pages=[])
    assert none.pages.count() == 0 and none.documents.count() == 4


def test_streams(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(0, " https://a/uuid:1 "), (1, "#")], "pos long, line string").write.parquet(path)
    stream = spark.readStream.schema("pos long, line string").parquet(path)
    query = stream_documents(stream, LIBRARIES).writeStream.format("memory").queryName("intake").start()
    query.processAllAvailable()
    query.stop()
    assert [(r.library_name, r.document_id) for r in spark.table("intake").collect()] == [("A", "uuid:1")]
    log = str(tmp_path / "log")
    spark.createDataFrame([(0, 1, True, False, 1, "", "", False)], landed.ATTEMPTS).write.parquet(log)
    judged = stream_outcomes(spark.readStream.schema(landed.ATTEMPTS).parquet(log))
    query = judged.writeStream.format("memory").queryName("judged").start()
    query.processAllAvailable()
    query.stop()
    assert [r.reason for r in spark.table("judged").collect()] == ["error"]


def test_the_manifest_replaces_libraries_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "manifest")
    rows = lambda *r: spark.createDataFrame(list(r), "doc_key long, library_name string")
    read = lambda: sorted((r.library_name, r.doc_key) for r in spark.read.parquet(path).collect())
    for _ in range(2):
        landed.write_manifest(rows((1, "A"), (2, "A"), (3, "B")), path)
        assert read() == [("A", 1), ("A", 2), ("B", 3)]
    landed.write_manifest(rows((9, "B")), path)
    assert read() == [("A", 1), ("A", 2), ("B", 9)]
    broken = rows((4, "A")).selectExpr("if(doc_key = 4, raise_error('no'), doc_key) doc_key", "library_name")
    with pytest.raises(Exception):
        landed.write_manifest(broken, path)
    assert read() == [("A", 1), ("A", 2), ("B", 9)]
