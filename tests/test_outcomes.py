import random

import pytest
from pyspark.sql import functions as F

from folioworks.functions.numbering import in_ranges, number_by_ranges, number_in_groups
from folioworks.operators import rollup
from folioworks.operators.attempts import attempt_outcomes, cert_logs
from folioworks.operators import causes
from folioworks.operators.causes import cert_causes
from folioworks.session import cut_lineage

HEADER = "Dezoomer error: discovery failed: no discovery candidate accepted the input"
TLS = "error:99:SSL routines:certificate verify failed:chain ends too early"
LOG = (
    f"warn {HEADER} (3)\n"
    "  - atlas: not an Atlas file\n"
    f"  - mosaic: error sending request for url (https://scans.test/m?x=(1)): {TLS}\n"
    f"  - krpano: failed to download krpano metadata: error sending request for url (https://scans.test/k): {TLS}\n"
    "nothing else was tried\n"
)

LOG_CASES = [
    (LOG, True),
    *((LOG.replace(part, ""), False) for part in (":SSL routines:", ":certificate verify failed:", "): error:", "error sending request for url (")),
    *((LOG + f"  - grid: {start} Grid{end}\n", start in ("not a", "not an") and end in (" URL", " file", " template"))
      for start in ("not a", "not an", "no", "a") for end in (" URL", " file", " template", "", " URLs", " page")),
    (LOG + "  - grid: " + "\u2003" * 50 + "!\n", False),
    (LOG + "  - grid: \n", True),
    (LOG + "  - grid: not a Grid URL\n", True),
    (LOG + "  - grid: not a Grid URL\r\n", False),
    (LOG + "\t-\tg_2:\tnot a Grid template\n", True),
    (LOG + "  - gríd: whatever\n", True),
    (LOG + "  - grid: a b\n", False),
    (LOG.split("\n", 1)[1], False),
    (HEADER + "\n - atlas: not an Atlas file\n", False),
    (HEADER, False),
    ("", False),
]


def test_certificate_logs(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(LOG_CASES)], "i int, stderr string")
    found = [r.certificate_only for r in cert_logs(df).orderBy("i").collect()]
    assert found == [c[1] for c in LOG_CASES]


def test_only_the_text_after_the_first_request_end_counts(spark):
    head = LOG.split("\n")[0] + "\n"
    before = " - a: error sending request for url (:SSL routines::certificate verify failed:): error: x\n"
    df = spark.createDataFrame([(head + before,)], "stderr string")
    assert not cert_logs(df).first().certificate_only


def test_attempt_outcomes(spark):
    rows = [
        (True, False, 0, "ok", "", False, "ok", "ok"),
        (True, False, 1, "", "bad", False, "failed", "error"),
        (True, False, 1, " \n", LOG, False, "failed", "certificate"),
        (True, False, 1, "partial", LOG, False, "failed", "error"),
        (True, False, 0, "", LOG, False, "ok", "ok"),
        (True, True, None, None, None, False, "failed", "timeout"),
        (False, False, None, None, None, True, "failed", "tool_missing"),
        (True, True, None, None, None, True, "exception", "exception"),
        (True, False, 2, None, None, False, "failed", "error"),
    ]
    schema = (
        "tool_found boolean, timed_out boolean, returncode int, stdout string, stderr string, exception boolean, "
        "want string, why string"
    )
    for r in attempt_outcomes(spark.createDataFrame(rows, schema)).collect():
        assert (r.outcome, r.reason) == (r.want, r.why)


def _brute(pages):
    for i, outcome in enumerate(pages):
        if outcome == "exception":
            return pages[:i].count("ok"), pages[:i].count("failed") + 1, len(pages) - i - 1
    return pages.count("ok"), pages.count("failed"), 0


@pytest.mark.parametrize("block", [4096, 3])
def test_document_outcomes_agree_with_walking(spark, monkeypatch, block):
    monkeypatch.setattr(rollup, "_BLOCK", block)
    pick = random.Random(5)
    log = {0: ["ok", "failed", "ok"], 1: ["ok", "exception", "ok"], 2: ["exception"], 3: ["ok"] * 9 + ["exception"]}
    log |= {k: pick.choices(["ok", "failed", "exception"], [8, 3, 1], k=pick.randint(1, 30)) for k in range(4, 60)}
    rows = [(k, i, o) for k, pages in log.items() for i, o in enumerate(pages, 1)]
    df = spark.createDataFrame(rows, "doc_key long, page_index long, outcome string")
    found = {r.doc_key: tuple(r)[1:] for r in rollup.document_outcomes(df).collect()}
    assert found == {k: _brute(v) for k, v in log.items()}
    counts = spark.createDataFrame([(0, 5), (1, 3), (99, 2), (98, 0)], "doc_key long, page_count int")
    found = {r.doc_key: tuple(r)[1:] for r in rollup.document_outcomes(df, counts).collect()}
    assert found == {0: (2, 1, 2), 1: (1, 1, 1), 99: (0, 0, 2), 98: (0, 0, 0)}


def test_failures_and_verdict(spark):
    urls = [(0, "u0", None), (1, "u1", "B"), (2, "u2", "A"), (3, "u3", "B"), (4, "u4", "A"), (5, "u5", "C")]
    urls = spark.createDataFrame(urls, "pos long, url string, library_name string")
    failures = spark.createDataFrame(
        [(0, "u0", None, "unsupported_library"), (5, "u5", "C", "no_identifier")],
        "pos long, url string, library_name string, reason string",
    )
    documents = spark.createDataFrame(
        [(1, "u1", "B", True), (2, "u2", "A", True), (3, "u3", "B", False), (4, "u4", "A", True)],
        "doc_key long, source_url string, library_name string, dir_granted boolean",
    )
    outcomes = spark.createDataFrame(
        [(1, 8, 1, 1), (2, 3, 0, 0), (4, 0, 0, 2)], "doc_key long, succeeded long, failed long, unattempted long"
    )
    order = rollup.library_order(urls)
    failed = rollup.failed_documents(failures, documents, outcomes, order)
    rows = [tuple(r) for r in failed.orderBy("phase", "library_first", "pos").collect()]
    assert rows == [
        (0, -1, 0, "u0", "unsupported_library", None, None, None),
        (1, -1, 5, "u5", "no_identifier", None, None, None),
        (2, 1, 1, "u1", "pages", 8, 1, 1),
        (2, 1, 3, "u3", "dir_exists", None, None, None),
        (2, 2, 4, "u4", "pages", 0, 0, 2),
    ]
    assert tuple(rollup.run_summary(urls, failed).first()) == (6, 5, 1)
    assert tuple(rollup.run_summary(urls, failed.limit(0)).first()) == (6, 0, 0)
    assert tuple(rollup.run_summary(urls.limit(0), failed.limit(0)).first()) == (0, 0, 0)
    per_library = {r.library_name: r.documents for r in rollup.library_documents(documents, order).collect()}
    assert per_library == {"A": 2, "B": 2, "C": 0}


def test_causes_through_chains_and_cycles(spark):
    nodes = [(i, "E") for i in range(1, 41)] + [(41, "SSLCertVerificationError"), (50, "SSLError"), (51, "E")]
    edges = [(i, i + 1) for i in range(1, 41)] + [(50, 51), (51, 50), (41, 1), (7, 7)]
    df = cert_causes(
        spark.createDataFrame(nodes, "error_id long, error_class string"),
        spark.createDataFrame(edges, "from_id long, to_id long"),
        spark.createDataFrame([(1,), (41,), (50,), (60,)], "error_id long"),
    )
    assert {r.error_id: r.is_certificate for r in df.collect()} == {1: True, 41: True, 50: False, 60: False}


@pytest.mark.parametrize("seed", range(4))
def test_causes_of_any_graph(spark, seed):
    """Chains, circles, tails into circles, branches, loops, repeated edges, errors nobody knows."""
    r = random.Random(seed)
    n = 700
    edges = {(i, i + 1) for i in range(n) if i % 97} | {(i, r.randrange(n)) for i in range(0, n, 97)}
    edges |= {(r.randrange(n), r.randrange(n)) for _ in range(8 * seed)} | {(5, 5), (n + 5, 3)}
    bad = set(r.sample(range(n), 2))
    reached, grown = set(bad), True
    while grown:
        more = {a for a, b in edges if b in reached} - reached
        reached |= more
        grown = bool(more)
    df = cert_causes(
        spark.createDataFrame([(i, "SSLCertVerificationError" if i in bad else "E") for i in range(n)], "error_id long, error_class string"),
        spark.createDataFrame([*edges, (1, 2), (None, 3), (4, None)], "from_id long, to_id long").repartition(3),
        spark.createDataFrame([(i,) for i in range(n + 10)], "error_id long"))
    assert {x.error_id for x in df.filter("is_certificate").collect()} == reached


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    written = []
    monkeypatch.setattr(causes, "cut_lineage", lambda df: written.append(df) or cut_lineage(df))
    n = 1000
    df = cert_causes(
        spark.createDataFrame([(i, "SSLCertVerificationError" if i == n else "E") for i in range(n + 1)], "error_id long, error_class string"),
        spark.createDataFrame([(i, i + 1) for i in range(n)], "from_id long, to_id long"),
        spark.createDataFrame([(0,), (n,)], "error_id long"))
    assert [x.is_certificate for x in df.collect()] == [True, True]
    assert len(written) < 22


def test_numbers_in_groups_are_dense_across_buckets(spark):
    pick = random.Random(3)
    rows = [(pick.choice(["a", "a", "b", None]), pick.choice([None, *range(50)]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, t int, i int")
    found = number_in_groups(df, ["k"], ["t", "i"], F.floor(F.col("t") / 7), "n").collect()
    expected = {}
    for k in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for n, (_, _, i) in enumerate(own, 1):
            expected[i] = n
    assert {r.i: r.n for r in found} == expected


def test_numbers_by_ranges_are_dense_whatever_one_key_holds(spark):
    pick = random.Random(4)
    rows = [(pick.choice(["a", "b", None]), pick.choice([None, *range(50)]), i, "x", 0) for i in range(400)]
    rows += [("hot", 7, 1000 + i, "x", 0) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t int, i int, _block string, _of_k int").repartition(5)
    found = number_by_ranges(df, ["k"], ["t", "i"], "n")
    assert found.columns == [*df.columns, "n"]
    expected = {}
    for k in ("a", "b", None, "hot"):
        own = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        for n, r in enumerate(own, 1):
            expected[r[2]] = n
    assert {r.i: r.n for r in found.collect()} == expected
    # One key and value with all rows equal: each number once, and no range takes much more than its share.
    same = spark.createDataFrame([("k", 1)] * 4000, "k string, t int").repartition(4)
    assert sorted(r.n for r in number_by_ranges(same, ["k"], ["t"], "n").collect()) == list(range(1, 4001))
    shares = [r["count"] for r in in_ranges(same, ["k"], ["t"], "b", "p").groupBy("b").count().collect()]
    assert len(shares) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(shares) < 2 * 4000 / len(shares)
    assert number_by_ranges(same.limit(0), ["k"], ["t"], "n").collect() == []
