"""Only bodies of wanted documents are parsed, also where these are many."""

from pyspark.sql import functions as F

from folioworks.config import Library, Options
from folioworks.operators.rest import likely_of
from folioworks.plans.batch import ArchiveRun, Landing


def test_the_filter_keeps_every_wanted_row_and_moves_none(spark):
    responses = spark.range(20000).select(F.concat(F.lit("uuid:"), F.col("id").cast("string")).alias("document_id"), F.lit("x").alias("body"))
    ids = responses.filter("cast(substring(document_id, 6) as int) % 3 = 0").select("document_id")
    twice = responses.union(responses).union(spark.createDataFrame([(None, "y")], "document_id string, body string"))
    count = ids.count()
    kept = likely_of(twice, ids, count)
    assert kept.join(ids, "document_id", "left_semi").count() == 2 * count
    assert kept.count() < 2.3 * count and kept.filter("document_id IS NULL").count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert not any("Exchange" in line and "body" in line for line in plan.splitlines())
    assert likely_of(twice, ids.limit(0), 0).count() == 0


def test_request_addresses_are_not_written(spark, tmp_path):
    lines = spark.createDataFrame([(1, "https://a/uuid:1")], "pos long, line string")
    run = ArchiveRun(Landing(lines), (Library("A", ("https://a/",), "https://img.a/"),), Options(), "now", work_dir=str(tmp_path / "work"))
    assert "uuid\\:1" in run.urls.first().document_request_url and "uuid:1" in run.urls.first().pages_request_url
    assert "document_request_url" not in spark.read.parquet(str(tmp_path / "work/urls")).columns


def test_many_ids_give_what_few_give(spark, tmp_path):
    lines = spark.createDataFrame([(i, f"https://a/uuid:{i:x}") for i in range(0, 600, 3)], "pos long, line string")
    body = '{"response":{"docs":[{"PID":"uuid:%x","rels_ext_index":[1],"dc.title":"T%d"}]}}'
    page = '<div id="page-id-uuid:%x"></div>'
    schema = "document_id string, status int, error_class string, %s string"
    answers = [(f"uuid:{i:x}" if i % 50 else None, 500 if i % 2 else 200, None, body % (i, i)) for i in range(600)]
    html = [(f"uuid:{i:x}", 200, None, page % i) for i in range(600)]
    landing = Landing(lines, *(spark.createDataFrame(answers, schema % "body") for _ in range(2)), spark.createDataFrame(html, schema % "html"))
    found = []
    for limit in (1 << 24, 0):
        run = ArchiveRun(landing, (Library("A", ("https://a/",), "https://img.a/"),), Options(), "now",
                         work_dir=str(tmp_path / str(limit)), broadcast_bytes=limit)
        pages = run.pages.select("doc_key", "page_index", "page_id").collect()
        found.append((sorted(map(tuple, run.resolved.collect()), key=repr), sorted(map(tuple, pages))))
    assert found[0] == found[1] and len(found[0][0]) == 200 and len(found[0][1]) == 200
