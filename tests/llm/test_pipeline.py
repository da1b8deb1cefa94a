"""The pipeline's stages, each on its own input."""

import re
from collections import defaultdict

import pytest

import corpus_pipeline
from folioworks.llm.queries import ORACLES, QUERIES
from tests.llm.brute import SCHEMA, awkward, groups, id_order, shingles, words

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows that go into each stage and come out of it, for the given documents and awkward ones together."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(r[0] + 10_000 if r[0] is not None else None, *r[1:5]) for r in awkward(2)], docs.schema)
    passed = {}
    current = docs.union(extra)
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path_factory.mktemp(name))
        stage(spark, current, SF).write.mode("overwrite").parquet(out)
        passed[name] = ([tuple(r) for r in current.collect()], spark.read.parquet(out))
        current = spark.read.parquet(out)
    return passed


def test_shape():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near", "decontamination", "mix"]
    assert len(QUERIES) == 13 and set(ORACLES) <= set(QUERIES)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


def test_language_keeps_what_has_letters(stages):
    before, after = stages["language"]
    assert after.columns == COLUMNS
    kept = sorted((id_order(r.doc_id), r.text) for r in after.collect())
    assert kept == sorted((id_order(r[0]), r[1]) for r in before if r[1] and any(c.isalpha() for c in r[1]))


def test_lines_keep_every_document_that_says_something_of_its_own(stages):
    before, after = stages["lines"]
    assert after.columns == COLUMNS
    rows = after.collect()
    left = {(r.doc_id, len(words(r.text))) for r in rows}
    texts = {r[0]: r[1] for r in before}
    assert all(set((r.text or "").split("\n")) <= set(texts[r.doc_id].split("\n")) for r in rows)
    assert all(r.n_chars == len(r.text) for r in rows if r.text != texts[r.doc_id])
    gone = set(texts) - {i for i, _ in left}
    lines = defaultdict(set)
    for i, t in texts.items():
        for line in t.split("\n"):
            lines[line.strip()].add(i)
    assert all(len(lines[line.strip()]) > 1 or texts[i].count(line) > 1 for i in gone for line in texts[i].split("\n") if line.strip())


def test_near_keeps_one_of_each_group(stages):
    before, after = stages["near"]
    rows = [r for r in before if r[0] is not None]
    sets = [shingles(r[1]) for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    least = defaultdict(lambda: 1 << 62)
    root = groups(len(rows), links)
    for r, g in zip(rows, root, strict=True):
        least[g] = min(least[g], r[0])
    assert {r.doc_id for r in after.collect() if r.doc_id is not None} == set(least.values())
    assert len(least) < len({r[0] for r in rows})


def test_near_judges_each_row_by_its_own_text(spark):
    say = lambda word: " ".join(f"{word}{i}" for i in range(60))
    near = say("a").rsplit(" ", 1)[0] + " other"
    rows = [(5, say("a")), (None, near), (None, say("b")), (None, None), (7, near), (7, say("c")), (9, say("c")), (None, say("d")),
            (None, say("d"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = sorted(((id_order(r.doc_id), r.text or "") for r in corpus_pipeline.near(spark, docs.repartition(3), SF).collect()))
    left = [rows[i] for i in (0, 2, 3, 5, 7, 8)]
    assert got == sorted((id_order(i), t or "") for i, t in left)


def test_leaks_go_and_clean_documents_stay(spark, stages):
    before, after = stages["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    said = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    holds = [any(said(i) in said(r[1]) for i in items) for r in before]
    kept = {r.doc_id for r in after.collect()}
    assert sum(holds) > 0
    for r, leak in zip(before, holds, strict=True):
        assert (r[0] in kept) == (not leak)


def test_the_mix_covers_what_is_left(stages):
    before, after = stages["mix"]
    rows = after.collect()
    assert sorted(id_order(r.doc_id) for r in rows) == sorted(id_order(r[0]) for r in before)
    assert abs(sum(r.taken for r in rows) - sum(len(words(r[1])) for r in before)) <= 30


def test_empty_documents(spark):
    none = spark.createDataFrame([], SCHEMA).select(COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
