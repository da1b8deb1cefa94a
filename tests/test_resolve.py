import itertools

from folioworks.config import METADATA_FIELDS
from folioworks.operators.resolve import needs_dom, resolve_metadata, resolve_pages

# REST outcome, HTML outcome -> source or failure; the rows of the decision table written out.
DECISIONS = {
    ("ok", "ok"): "rest",
    ("ok", "empty"): "rest",
    ("ok", "error"): "rest",
    ("ok", "cert"): "rest",
    ("empty", "ok"): "no_pages",
    ("empty", "empty"): "no_pages",
    ("empty", "error"): "no_pages",
    ("empty", "cert"): "no_pages",
    ("error", "ok"): "dom",
    ("error", "empty"): "no_pages",
    ("error", "error"): "no_pages",
    ("error", "cert"): "no_pages",
    ("cert", "ok"): "dom",
    ("cert", "empty"): "certificate",
    ("cert", "error"): "no_pages",
    ("cert", "cert"): "certificate",
}


def test_decision_table(spark):
    rows = []
    for (rest, dom), _ in DECISIONS.items():
        status, kind = (rest, "ok") if rest == "cert" else ("ok", rest)
        rows.append((f"{rest}-{dom}", status, kind, dom))
    rows.append(("error-ok*", "error", "ok", "ok"))  # an unavailable source, whatever its body would say
    rows.append(("cert-missing", "cert", "ok", None))
    df = spark.createDataFrame(rows, "document_id string, rest_status string, rest_pages_kind string, dom_kind string")
    found = {r.document_id: r.pages_source or r.failure_class for r in resolve_pages(df).collect()}
    expected = {f"{rest}-{dom}": result for (rest, dom), result in DECISIONS.items()}
    assert found == expected | {"error-ok*": "dom", "cert-missing": "certificate"}
    explicit = resolve_pages(df, ["a"]).collect()
    assert {(r.pages_source, r.failure_class) for r in explicit} == {("explicit", None)}


def _fields(spark, rows):
    names = ["document_id string", "pages_source string"]
    for f in METADATA_FIELDS:
        names += [f"{f}_kind string", f"{f} string", f"dom_{f} string"]
    return spark.createDataFrame(rows, ", ".join(names))


def _walk(source, kinds):
    """The events in order: fields one by one, a failed source stays out."""
    use_rest, result = source == "rest", []
    for i, kind in enumerate(kinds):
        if use_rest and kind == "invalid":
            use_rest = False
        result.append((f"r{i}" if kind == "string" else "") if use_rest else f"d{i}")
    return result


def test_a_failed_source_stays_out(spark):
    rows, expected = [], {}
    for source in ("rest", "dom", "explicit"):
        for n, kinds in enumerate(itertools.product(("string", "missing", "invalid"), repeat=4)):
            key = f"{source}{n}"
            values = [v for i, k in enumerate(kinds) for v in (k, f"r{i}" if k == "string" else "", f"d{i}")]
            rows.append((key, source, *values))
            expected[key] = _walk(source, kinds)
    found = resolve_metadata(_fields(spark, rows)).collect()
    assert {r.document_id: [r[f] for f in METADATA_FIELDS] for r in found} == expected


def test_missing_html_texts_become_empty(spark):
    row = resolve_metadata(_fields(spark, [("a", "dom", *(["invalid", "42", None] * 4))])).first()
    assert [row[f] for f in METADATA_FIELDS] == [""] * 4


def test_html_is_only_wanted_when_it_can_matter(spark):
    schema = "rest_status string, rest_pages_kind string, " + ", ".join(f"{f}_kind string" for f in METADATA_FIELDS)
    good = ["string", "missing", "string", "missing"]
    rows = [("ok", "ok", *good), ("ok", "empty", *good), ("ok", "error", *good), ("cert", "ok", *good)]
    rows += [("ok", "ok", "string", "invalid", "string", "string"), (None, None, None, None, None, None)]
    found = [r.w for r in spark.createDataFrame(rows, schema).select(needs_dom().alias("w")).collect()]
    assert found == [False, False, True, True, True, True]
