"""What grows no faster than its input."""

import time

from folioworks.config import Step
from folioworks.operators.dom import dom_text
from folioworks.operators.manifest import with_text
from folioworks.sources import landing
from workloads import derived


def test_very_wide_pages_cost_what_they_are(spark):
    """Sixteen times the elements take at most ten times as long, the fixed costs being most of the smaller."""
    steps, took = {"t": (Step("article"), Step("h1"))}, {}
    for n in (500, 2000, 2000, 32000):
        pages = spark.createDataFrame(
            [("0", 200, None, "<article><h1>x</h1></article>" * n)],
            "document_id string, status int, error_class string, html string").repartition(1)
        started = time.perf_counter()
        assert dom_text(pages, steps).first().t == " ".join("x" * n)
        took[n] = time.perf_counter() - started
    assert took[32000] < 10 * took[2000]


def _tables(spark, folder, lines):
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_shipdate string"
    spark.createDataFrame(lines, line).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, 1), (2, 1), (3, 1), (None, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(1, "c")], "c_custkey long, c_name string").write.parquet(f"{folder}/customer.parquet")
    return str(folder)


def test_only_long_orders_are_ranked(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(derived, "BLOCK", 3)
    few = [(1, 5, 1, 1, 1.0, "d"), (1, 4, 1, 2, 1.0, "d"), (2, 3, 1, 1, 1.0, "d"), (None, 1, 1, 1, 1.0, "d")]
    found = lambda df: sorted((str(r.doc), [x.l_partkey for x in r._lines or ()]) for r in df.collect())
    orders = derived.landed_orders(spark, _tables(spark, tmp_path / "few", few))
    assert found(orders) == [("1", [4, 5]), ("2", [3]), ("3", []), ("None", [])]
    # Nothing is left of the ranking once it shows that no order is long.
    assert "Window" not in orders._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    many = few + [(2, 900 - n, 1, 1, 1.0, "d") for n in range(6)]
    second, third = (str(2 + k * derived.BLOCK_OFFSET) for k in (1, 2))
    assert found(derived.landed_orders(spark, _tables(spark, tmp_path / "many", many))) == [
        ("1", [4, 5]), (second, [897, 898, 899]), ("2", [3, 895, 896]), (third, [900]), ("3", []), ("None", [])]


def test_the_manifest_text_is_made_behind_its_exchange(spark, tmp_path):
    columns = ("source_url", "document_uuid", "title", "subtitle", "part_title", "part_subtitle", "tool_path", "args",
               "allow_insecure", "subfolder", "written_at", "library_name")
    rows = spark.range(2).selectExpr("id doc_key", "array('p') pages", "1L page_count", *(f"'{c}' {c}" for c in columns))
    seen = []
    landing.write_manifest(rows, str(tmp_path / "m"), lambda dealt: seen.append(dealt) or with_text(dealt))
    assert "text" not in seen[0].columns and "REBALANCE" in seen[0]._jdf.queryExecution().executedPlan().toString()
    back = spark.read.parquet(str(tmp_path / "m"))
    assert sorted(back.collect(), key=str) == sorted(with_text(rows).select(back.columns).collect(), key=str)
