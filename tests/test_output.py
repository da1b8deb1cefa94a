from pyspark.sql import functions as F

from folioworks.config import OptionLayer, Options
from folioworks.operators.documents import page_file_name, page_table
from folioworks.operators.manifest import document_manifest, page_lists
from folioworks.operators.options import effective_options, option_layers, option_warnings, work_orders
from folioworks.operators.output import dir_conflicts, document_path, output_dirs

REFUSED = '\\/:*?"<>|' + "".join(map(chr, [*range(32), 127]))


def _clean(name):
    return "".join(c for c in name if c not in REFUSED).rstrip(" .")


def _name(doc_id, title):
    both = doc_id.replace(":", "_") + ("_" if doc_id and title else "") + title
    return _clean(both)[:255]


def test_document_paths(spark):
    """Every refused character at the start, in the middle and at the end of each part, and names around the limit."""
    placed = [(c + "ab", "a" + c + "b", "ab" + c) for c in REFUSED]
    cases = [("out", i, t, "/".join(filter(None, ["out", _name(i, t)])))
             for word in ("ab", "a b", "é.b") for i in ("", f"uuid:{word}") for t in ("", word)]
    for word in (w for words in placed for w in words):
        cases.append(("out", f"uuid:{word}", "t", f"out/{_name('uuid:' + word, 't')}"))
        cases.append(("out", "uuid:1", word, f"out/{_name('uuid:1', word)}"))
        # In the base both slashes part folders.
        base = "/".join(filter(None, (_clean(x) for x in word.replace("\\", "/").split("/"))))
        cases.append((word, "uuid:1", "t", f"{'/' if word[0] in '/' else ''}{base}/uuid_1_t"))
    for length in (254, 255, 256, 700):
        title = "x" * (length - len("uuid_1_"))
        cases.append(("out", "uuid:1", title, f"out/{('uuid_1_' + title)[:255]}"))
    cases += [
        ("out//x/", "uuid:1", "a:b?\x07 .", "out/x/uuid_1_ab"),
        ("/abs", "uuid:1", "", "/abs/uuid_1"),
        ("../scans", "uuid:1", "..", "../scans/uuid_1_"),
        ("./scans/../more.", "uuid:1", "x", "./scans/../more/uuid_1_x"),
        ("scans", "", "..", "scans"),
    ]
    df = spark.createDataFrame(cases, "base string, id string, title string, expected string")
    for r in df.select("*", document_path(F.col("base"), F.col("id"), F.col("title")).alias("found")).collect():
        assert r.found == r.expected, r


def test_page_file_names(spark):
    rows = [(7, "plate"), (7, "z" * 90), (1000, "uuid:x")]
    df = spark.createDataFrame(rows, "i int, id string").select(page_file_name(F.col("i"), F.col("id")).alias("n"))
    assert [r.n for r in df.collect()] == ["page_007_plate", "page_007_" + "z" * 55, "page_1000_uuid:x"]


def _documents(spark, rows):
    schema = (
        "doc_key long, library_name string, document_id string, source_url string, title string, subtitle string, "
        "part_title string, part_subtitle string, page_detail_url string, page_ids array<string>"
    )
    return spark.createDataFrame(rows, schema)


def test_first_claim_wins_and_old_folders_stay(spark):
    rows = [(k, lib, f"uuid:{i}", "", "", "", "", "", "", []) for k, lib, i in ((9, "A", 1), (3, "A", 1), (5, "B", 1), (7, "A", 2), (8, "A", 2))]
    existing = spark.createDataFrame([("output/A/uuid_2",), ("output/A/uuid_2",)], "output_dir string")
    df = output_dirs(_documents(spark, rows))
    assert {r.doc_key for r in dir_conflicts(df).filter("dir_granted").collect()} == {3, 5, 7}
    found = dir_conflicts(df, existing).collect()
    assert {r.doc_key for r in found if r.dir_granted} == {3, 5} and len(found) == 5


OPTIONS = Options(
    libraries={"A": OptionLayer(("--accept-invalid-certs",), True), "B": OptionLayer((), None, "scans"), "C": OptionLayer(None, False)},
    shared=OptionLayer(("--largest",), True, "images"),
)


def _effective(spark, options):
    df = spark.createDataFrame([(n,) for n in "ABCD"], "library_name string")
    return {r.library_name: tuple(r)[1:] for r in effective_options(df, options).collect()}


def test_option_precedence(spark):
    assert _effective(spark, OPTIONS) == {
        "A": (["--accept-invalid-certs"], True, "images", True, False),
        "B": ([], True, "scans", True, False),
        "C": (["--largest"], False, "images", False, False),
        "D": (["--largest"], True, "images", True, False),
    }
    run = Options(OptionLayer(("--accept-invalid-certs",), False), OPTIONS.libraries, OPTIONS.shared)
    assert {v[:2] + v[3:] for v in map(lambda t: (tuple(t[0]),) + t[1:], _effective(spark, run).values())} == {
        (("--accept-invalid-certs",), False, False, True)
    }
    empty = Options(OptionLayer(()), OPTIONS.libraries, OPTIONS.shared)
    assert {tuple(v[0]) for v in _effective(spark, empty).values()} == {()}
    assert _effective(spark, Options())["A"] == ([], False, None, False, False)


def test_warnings_per_scope(spark):
    found = {tuple(r) for r in option_warnings(spark, OPTIONS).collect()}
    assert found == {(None, True, False), ("A", True, False), ("B", True, False)}
    clash = Options(
        libraries={"A": OptionLayer(("--accept-invalid-certs",)), "B": OptionLayer(subfolder="x"), "C": OptionLayer(None, True)},
        shared=OptionLayer(("--accept-invalid-certs",), False))
    assert {tuple(r) for r in option_warnings(spark, clash).collect()} == {
        (None, False, True), ("A", False, True), ("C", True, False)}
    assert option_warnings(spark, Options()).count() == 0


def test_option_rows():
    rows = [("global", None, ["--largest"], False, "images"), ("library", "A", None, True, None), ("run", None, [], None, None)]
    options = option_layers(rows)
    assert options.run.args == [] and options.libraries["A"].allow_insecure is True
    assert options.shared.subfolder == "images"


def test_pages_orders_and_manifest(spark):
    rows = [
        (1, "A", "uuid:1", "https://a/1", "T", "S", "PT", "PS", "https://img/", ["p1", "p2"]),
        (2, "C", "uuid:2", "https://a/2?x", "", "", "", "", "https://img/", []),
        (3, "E", "uuid:3", "https://a/3", "", "", "", "", "https://img/", ["p3"]),
    ]
    options = Options(libraries=OPTIONS.libraries, shared=OptionLayer(("--largest",), None, None))
    documents = output_dirs(effective_options(_documents(spark, rows), options))
    pages = {(r.doc_key, r.page_index): r for r in page_table(documents).collect()}
    assert set(pages) == {(1, 1), (1, 2), (3, 1)}
    assert pages[1, 2].page_url == "https://a/1?page=p2"
    assert pages[1, 2].download_url == "https://img/search/zoomify/p2/ImageProperties.xml"
    assert pages[1, 2].output_base == "output/A/uuid_1_T/page_002_p2"
    orders = {(r.doc_key, r.page_index): r.command for r in work_orders(page_table(documents)).collect()}
    url = "https://img/search/zoomify/{}/ImageProperties.xml"
    assert orders[1, 1] == ["dezoomify-rs", "--accept-invalid-certs", url.format("p1"), "output/A/uuid_1_T/page_001_p1"]
    assert orders[3, 1] == ["dezoomify-rs", "--largest", url.format("p3"), "output/E/uuid_3/page_001_p3"]
    lists = {r.doc_key: (r.page_ids, r.page_count) for r in page_lists(documents).collect()}
    assert lists == {1: (["p1", "p2"], 2), 2: ([], 0), 3: (["p3"], 1)}
    texts = {r.doc_key: r.text for r in document_manifest(documents, "/tool", "2024-01-02 03:04:05").collect()}
    assert texts[1] == (
        "Source URL: https://a/1\nDocument_uuid: uuid:1\nTitle: T\nSubtitle: S\nPart title: PT\nPart subtitle: PS\n"
        "pages:\n    p1\n    p2\nPage count: 2\nDezoomify-rs path: /tool\nDezoomify-rs args: --accept-invalid-certs\n"
        "Allow insecure: true\nImages subfolder: \nDate: 2024-01-02 03:04:05\n"
    )
    assert "pages:\nPage count: 0\n" in texts[2]


def test_switch_is_appended_once_and_images_get_their_subfolder(spark):
    rows = [(1, "X", "uuid:1", "https://a/1", "", "", "", "", "https://img/", ["p1"])]
    options = Options(shared=OptionLayer(("--largest",), True, "images"))
    documents = output_dirs(effective_options(_documents(spark, rows), options))
    command = work_orders(page_table(documents), "/tool").first().command
    assert command[:3] == ["/tool", "--largest", "--accept-invalid-certs"]
    assert command[-1] == "output/X/uuid_1/images/page_001_p1"
