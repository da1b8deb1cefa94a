import random
import html
from urllib.parse import urlparse

import pytest

from pyspark.sql import functions as F

from folioworks.config import DEFAULT_LIBRARIES, Library
from folioworks.functions.text import strip, unescape, url_path
from folioworks.operators.urls import assign_library, document_ids, url_manifest
from folioworks.sources.url_lists import read_url_lines


def test_manifest_trims_and_skips(spark):
    lines = ["https://a/1", "# c", "   https://a/2   ", "", "  \t ", "  # c", "\x1chttps://a/3　", "u 1 # x", "https://a/1"]
    df = spark.createDataFrame(list(enumerate(lines)), "pos long, line string")
    rows = [tuple(r) for r in url_manifest(df).orderBy("pos").collect()]
    assert rows == [(0, "https://a/1"), (2, "https://a/2"), (6, "https://a/3"), (7, "u 1 # x"), (8, "https://a/1")]


def test_strip_agrees_with_python_on_every_space(spark):
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()] + ["​", "﻿", "\x1b"]
    df = spark.createDataFrame([(f"{c}x{c}y{c}",) for c in spaces], "s string")
    for row in df.select("s", strip(F.col("s")).alias("t")).collect():
        assert row.t == row.s.strip()


def test_read_url_lines_keeps_file_order(spark, tmp_path):
    path = tmp_path / "urls.txt"
    path.write_bytes("﻿https://a/1\n# c\nhttps://a/2\r\nhttps://a/3".encode())
    rows = url_manifest(read_url_lines(spark, str(path))).orderBy("pos").collect()
    assert [r.url for r in rows] == ["https://a/1", "https://a/2", "https://a/3"]


def test_empty_file_gives_no_rows(spark, tmp_path):
    path = tmp_path / "empty.txt"
    path.write_text("\n# comment\n  \n")
    assert url_manifest(read_url_lines(spark, str(path))).count() == 0


@pytest.mark.parametrize("many", [False, True])
def test_first_registered_prefix_wins(spark, many):
    libraries = [
        Library("short", ("https://a/", "https://a/b/"), "d1"),
        Library("long", ("https://a/b/c/",), "d2"),
        Library("other", ("http://o/",), "d3"),
    ]
    if many:
        libraries += [Library(f"x{i}", (f"https://x{i}/",), "") for i in range(80)]
    urls = [(0, "https://a/b/c/1"), (1, "http://o/"), (2, "HTTPS://a/"), (3, "ftp://z")]
    df = assign_library(spark.createDataFrame(urls, "pos long, url string"), libraries)
    rows = {r.pos: (r.library_name, r.base_url, r.page_detail_url) for r in df.collect()}
    assert rows == {
        0: ("short", "https://a/", "d1"),
        1: ("other", "http://o/", "d3"),
        2: (None, None, None),
        3: (None, None, None),
    }
    assert "Join" not in df._jdf.queryExecution().toString()


def test_document_id_comes_from_the_path(spark):
    base = DEFAULT_LIBRARIES[0].prefixes[0]
    cases = {
        base + "view/uuid:1a-2b?page=uuid:ff": "uuid:1a-2b",
        base + "view/none?page=uuid:ff": None,
        base + "view/none#uuid:ff": None,
        "https://a/b;uuid:12": None,
        "https://a/uuid:12;x": "uuid:12",
        "https://a/uuid:12/uuid:34": "uuid:12",
        "https://a/x y/uuid:ab": "uuid:ab",
        "https://a/UUID:12": None,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "pos long, url string")
    found = {r.url: (r.document_id, r.document_request_url, r.pages_request_url) for r in document_ids(df).collect()}
    assert {u: f[0] for u, f in found.items()} == cases
    _, document, pages = found["https://a/uuid:12;x"]
    assert "q=PID:uuid\\:12&" in document and 'parent_pid:"uuid:12"&rows=4000' in pages


def test_url_path_agrees_with_the_standard_library(spark):
    urls = ["https://a/b/c;d?e#f", "http://a", "//h/p", "p/q;r/s;t", "a:b/c", "https://u:p@h:1/x;y/z", "", "?q", "#f/g"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    for row in df.select("u", url_path(F.col("u")).alias("p")).collect():
        assert row.p == urlparse(row.u).path, row.u


def test_unescape_agrees_with_the_standard_library(spark):
    cases = [
        "a &amp;lt; b", "&#233;&#xE9;&eacute;", "&copy &middot;x&nope;", "& &", "&#128512;", "&check; &check &notit; &notin;",
        "&#150;&#x80;&#129;&#159;", "&#13;", "&#0;&#xD800;&#99999999;", f"&#x{'f' * 40};&#{'9' * 40};&#x0000000041;",
        "&ampersand &ltx;&NotEqualTilde;&fjlig;&frac12x", "&;&#;&#x;&#xg;",
    ]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    found = {r.s: r.t for r in df.select("s", unescape(F.col("s")).alias("t")).collect()}
    assert found == {c: html.unescape(c) for c in cases}


@pytest.mark.parametrize("seed", range(2))
def test_many_prefixes_are_assigned_like_few(spark, seed):
    r = random.Random(seed)
    said = lambda: "https://" + "".join(r.choice("ab") for _ in range(r.randint(0, 7)))
    libraries = [Library(f"L{i}", tuple(said() for _ in range(r.randint(0, 6))), f"https://img{i}/") for i in range(120)]
    assert sum(len(x.prefixes) for x in libraries) > 200
    urls = [said() for _ in range(300)] + ["", "https:/", "http://a", "HTTPS://a"]
    df = spark.createDataFrame([(i, u, 0) for i, u in enumerate(urls)], "pos long, url string, prefix_of_url int")
    found = {x.pos: (x.library_pos, x.library_name, x.base_url) for x in assign_library(df, libraries).collect()}
    for i, url in enumerate(urls):
        owners = ((k, x.name, p) for k, x in enumerate(libraries) for p in x.prefixes if url.startswith(p))
        assert found[i] == next(owners, (None, None, None))


def test_lines_are_numbered_in_the_order_of_the_paths(spark, tmp_path):
    """Files of rising and falling size, cut into pieces, in a given order that is not that of their names."""
    want, paths = [], []
    for name, count in (("m", 3), ("c", 900), ("z", 1), ("a", 2500), ("e", 0), ("k", 40)):
        text = [f"https://{name}/{i}{'x' * (i % 50)}" for i in range(count)]
        (tmp_path / name).write_text("".join(f"{t}\n" for t in text))
        paths.append(str(tmp_path / name))
        want += text
    folder = tmp_path / "folder"
    folder.mkdir()
    for part in ("2", "10", "1"):
        (folder / part).write_text(f"last {part}\nend {part}")
    want += [f"{x} {part}" for part in ("1", "10", "2") for x in ("last", "end")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        df = read_url_lines(spark, [*paths, str(folder)])
        found = sorted((r.pos, r.line) for r in df.collect())
        assert found == list(enumerate(want)) and df.rdd.getNumPartitions() > 5
        assert sorted(r.pos for r in read_url_lines(spark, paths[1]).collect()) == list(range(900))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
