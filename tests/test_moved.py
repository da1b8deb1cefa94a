"""What a run moves and writes, and shorter ways that must give what the longer ones give."""

from pyspark.sql import functions as F

from folioworks.functions.html import attribute, outline, pieces_of, without_noise
from folioworks.functions.text import clean_path
from folioworks.operators.sources import QUESTIONS, Source, resolve_sources, unsettled
from folioworks.sources.landing import write_table
from workloads import derived

LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate string"
SAID = "document_id string, answers array<struct<kind:string,value:string>>, page_count int, maybe_truncated boolean"


def test_pages_never_landed_are_told_before_html_is_made(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "BLOCK", 2)
    # The second block of order 1 has the key of an order that never landed, and of those of 3 one does not.
    second = 1 + derived.BLOCK_OFFSET
    assert second % 5 == 1
    keys = [1, 2, 3, 7, -3, None, 2 + derived.BLOCK_OFFSET]
    folder = str(tmp_path / "t")
    for many in (False, True):
        folder = str(tmp_path / str(many))
        lines = [(k, n, 1, 1, 1.0, "d") for k in keys if k for n in range(5 if many and k in (2, 3) else 1)]
        spark.createDataFrame(lines, LINE).write.parquet(f"{folder}/lineitem.parquet")
        spark.createDataFrame([(k, 1, "low") for k in keys + [7]], "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
        spark.createDataFrame([(1, "c")], "c_custkey long, c_name string").write.parquet(f"{folder}/customer.parquet")
        every = derived.html_pages(spark, folder)
        missing = spark.read.parquet(f"{folder}/orders.parquet").filter("o_orderkey % 5 = 2")
        wanted = every.join(missing.select(derived.document_id(F.col("o_orderkey")).alias("document_id")), "document_id", "left_anti")
        landed = derived.gathered_orders(spark, folder)
        found = derived.html_pages(spark, folder, derived.ever_landed(landed, spark, folder))
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
        assert found.count() >= 4
        if not many:
            # No body goes through an exchange or meets another table.
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Join" not in plan


def _answers(*kinds):
    return [(kind, kind[0] if kind == "ok" else "") for kind in kinds]


def test_an_answer_that_comes_twice_counts_once(spark):
    said = lambda rows: spark.createDataFrame([(i, a, 1, False) for i, a in rows], SAID)
    good, failed = _answers(*["ok"] * len(QUESTIONS)), _answers(*["error"] * len(QUESTIONS))
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "document_id string")
    first = said([("a", good), ("b", failed), ("c", failed)])
    second = said([("b", good)] * 3 + [("x", good)] * 2 + [(None, good)])
    for complete in (False, True):
        sources = [Source("one", first, "error", complete), Source("two", second)]
        rows = resolve_sources(ids, sources).select("document_id", "pages_source", "title").collect()
        assert sorted(map(tuple, rows)) == [("a", "one", "o"), ("b", "two", "o"), ("c", None, "")]
        assert sorted(r.document_id for r in unsettled(ids, sources[:1]).collect()) == ["b", "c"]
    # What is complete is dealt out for no one to find what is open.
    plan = unsettled(ids, sources[:1])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_attributes_spelled_plainly_and_otherwise(spark):
    rows = [' id="a"', ' ID="a" ', ' x="1" id="a" y=""/', ' id=""', " id='a'", " id=a", ' title=" id=" b="c" id="a"', ' id="b" id="a"',
            ' id="a&amp;"', ' id="\'a\'"', ' data-id="b" id="a"', " id", ' idx="b"', ' id = "a"', '/id="a"', ' é="b" id="a"', ""]
    found = spark.createDataFrame([(r,) for r in rows], "a string").select(attribute(F.col("a"), "id").alias("v")).collect()
    assert [r.v for r in found] == ["a", "a", "a", "", "a", "a", "a", "a", "a&", "'a'", "a", "", None, "a", "a", "a", None]


def test_pages_without_noise_and_pieces_that_are_no_tags(spark):
    rows = ["<p>a</p>", "<!-- b --><p>a", "<SCRIPT>x</script >a", "<style>x</style>a", "<scripted>a", None]
    found = spark.createDataFrame([(r,) for r in rows], "h string").select(without_noise(F.col("h")).alias("h")).collect()
    assert [r.h for r in found] == ["<p>a</p>", "<!----><p>a", "a", "a", "<scripted>a", None]
    pages = ["<div id='<p>'<p>", "<div ", "x<DIV\nid=1>a</div\t><p/>", "<divs><div>", "", "<div <p>a<div>"]
    tags = ["div", "p"]
    made = lambda html: outline(pieces_of(html, tags), tags)
    found = spark.createDataFrame([(p,) for p in pages], "h string").select(made(F.col("h")).alias("o")).collect()
    assert found[1].o == "-0" and found[2].o == "-0a1b2c3" and found[3].o == "-0a1" and found[4].o == ""


def test_clean_paths_pass_and_others_are_cleaned(spark):
    rows = ["a/b", "/a/b c/.d", "a//b", "a/./b", "../a", "a /b", "a./b", "a:b", "a\\b", "a/b/", "", "/", "é/ b", "a\n/b", None]
    found = spark.createDataFrame([(r,) for r in rows], "p string").select(clean_path(F.col("p")).alias("p")).collect()
    assert [r.p for r in found] == [
        "a/b", "/a/b c/.d", "a/b", "a/./b", "../a", "a/b", "a/b", "ab", "a/b", "a/b", "", "/", "é/ b", "a/b", None]


def test_ids_are_written_in_half_their_length(spark, tmp_path):
    ids = spark.range(0, 20000, 1, 1).select(derived.document_id(F.col("id")).alias("document_id"))
    back = write_table(ids, str(tmp_path / "ids"))
    assert back.exceptAll(ids).count() == 0 and back.count() == 20000
    assert sum(f.stat().st_size for f in (tmp_path / "ids").glob("*.parquet")) < 20000 * 24
