"""Repeated strings, passages and lines against brute force."""

import numpy as np
import pytest

from folioworks.llm import lines
from folioworks.llm.anchors import bodies
from folioworks.llm.lines import Repeats, repeated_runs, without_repeated_lines
from folioworks.llm.passages import Passage, deep_nodes, passage_report, repeated_passages
from folioworks.llm.suffixes import Strings, equal_windows, induced, string_report
from folioworks.llm.tokens import mix
from folioworks.llm.trees import internal_nodes, maximal_repeats, suffix_tree
from tests.llm.test_documents import morse
from tests.llm.brute import SCHEMA, WORD, awkward, id_order, sha, words


def removed(rows, tokens, length, by_document):
    """Covered tokens of each row by the definition."""
    first = {}
    for doc_id, seq in zip((id_order(r[0]) for r in rows), tokens, strict=True):
        for s in range(len(seq) - length + 1):
            w = tuple(seq[s : s + length])
            here = (doc_id,) if by_document else (doc_id, s)
            if w not in first or here < first[w]:
                first[w] = here
    out = []
    for doc_id, seq in zip((id_order(r[0]) for r in rows), tokens, strict=True):
        gone = [False] * len(seq)
        for s in range(len(seq) - length + 1):
            if first[tuple(seq[s : s + length])] < ((doc_id,) if by_document else (doc_id, s)):
                gone[s : s + length] = [True] * length
        out.append(gone)
    return out


def runs(gone):
    return sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))


def stretch(gone):
    starts = [i for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1])]
    ends = [i + 1 for i, g in enumerate(gone) if g and (i + 1 == len(gone) or not gone[i + 1])]
    return [(a, b - a) for a, b in zip(starts, ends, strict=True)]


@pytest.mark.parametrize("most", [20_000, 2])
def test_passages(spark, most):
    rows = awkward()
    tokens = [words(r[1]) for r in rows]
    gone = removed(rows, tokens, 50, True)
    want = sorted(
        (id_order(r[0]), len(t), sum(g), runs(g), sha(" ".join(w for w, x in zip(t, g, strict=True) if not x).encode()))
        for r, t, g in zip(rows, tokens, gone, strict=True))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = passage_report(docs, Passage(most=most)).collect()
    assert sorted((id_order(r.doc_id), r.n_words, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert sum(w[2] for w in want) > 500
    where = sorted((id_order(r[0]), *x) for r, g in zip(rows, gone, strict=True) for x in stretch(g))
    assert sorted((id_order(r.doc_id), r.start, r.size) for r in repeated_passages(docs, Passage(most=most)).collect()) == where


@pytest.mark.parametrize("length", [1024, 4096])
def test_passages_of_words_that_fool_polynomials(spark, length):
    one, other = morse(length)
    said = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*said[:25], w, *said[26:]])) for i, w in enumerate((one, other))]
    got = passage_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [x.n_removed for x in got] == [0, 0]


@pytest.mark.parametrize("most", [60_000, 2])
def test_strings(spark, most):
    rows = awkward(8)
    tokens = [(r[1] or "").encode() for r in rows]
    gone = removed(rows, tokens, 100, False)
    want = sorted(
        (id_order(r[0]), len(t), sum(g), runs(g), sha(bytes(b for b, x in zip(t, g, strict=True) if not x)))
        for r, t, g in zip(rows, tokens, gone, strict=True))
    got = string_report(spark.createDataFrame(rows, SCHEMA).repartition(3), Strings(most=most)).collect()
    assert sorted((id_order(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert sum(w[2] for w in want) > 5000


def test_many_texts_of_one_id_keep_their_own_places(spark):
    """With 18 bits of a hash, texts of one id would share bodies and spans."""
    shared = [f"shared{i}" for i in range(60)]
    passages = [[7, " ".join([f"n{i}w{j}" for j in range(i % 23)] + shared + [f"end{i}"])] for i in range(3000)]
    passages.append([1, " ".join(shared)])
    strings = [[None, f"{i} " + "." * (i % 29) + "".join(f"{j:03}" for j in range(50)) + f"{i}"] for i in range(3000)]
    for rows, seqs, length, report, glue in (
        (passages, [words(t) for _, t in passages], 50, passage_report, lambda t: " ".join(t).encode()),
        (strings, [t.encode() for _, t in strings], 100, string_report, bytes),
    ):
        gone = removed(rows, seqs, length, report is passage_report)
        want = sorted((id_order(r[0]), len(t), sum(g), runs(g), sha(glue([b for b, x in zip(t, g, strict=True) if not x])))
                      for r, t, g in zip(rows, seqs, gone, strict=True))
        got = report(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
        assert sorted(tuple(-(1 << 63) if v is None else v for v in r) for r in got) == want
        assert sum(w[2] for w in want) > 3000


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert passage_report(none, Passage()).count() == 0
    assert string_report(none, Strings()).count() == 0
    assert without_repeated_lines(none).count() == 0


def test_every_window_has_an_anchor_that_depends_on_the_window_alone():
    rng = np.random.default_rng(0)
    values = mix(rng.integers(0, 3, 400).astype(np.uint64))
    first = np.array([0, 150, 150, 170, 400])
    doc, start, windows, offset, gram, _ = bodies(values, first, 20, 4)
    seen = {}
    count = 0
    for d, s, n, o, g in zip(doc, start, windows, offset, gram, strict=True):
        for w in range(s, s + n):
            count += 1
            key = tuple(values[first[d] + w : first[d] + w + 20])
            assert seen.setdefault(key, (g, s + o - w)) == (g, s + o - w)
    assert count == sum(max(0, n - 19) for n in np.diff(first))


@pytest.mark.parametrize("depth", [3, 10, 1000])
def test_induced_sorting(depth):
    rng = np.random.default_rng(depth)
    for trial in range(60):
        t = rng.integers(1, rng.integers(2, 6), rng.integers(1, 150))
        text = np.append(np.tile(t, 1 + trial % 3), 0).astype(np.int16)
        out = [(int(p), int(c)) for ps, cs in induced(text, depth, memory=1 << 10) for p, c in zip(ps, cs, strict=True)]
        assert sorted(p for p, _ in out) == list(range(len(text)))
        for (a, _), (b, common) in zip(out, out[1:], strict=False):
            x, y = text[a : a + depth].tolist(), text[b : b + depth].tolist()
            assert x >= y
            shared = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
            assert min(common, depth) == shared


def test_windows_of_bodies():
    rng = np.random.default_rng(4)
    first = np.concatenate(([0], np.cumsum(rng.integers(0, 60, 30))))
    v = rng.integers(0, 2, first[-1])
    for length in (1, 5, 9):
        for names in (equal_windows(length, v.astype(np.uint8), first), deep_nodes(length, v.astype(np.uint64), first)):
            there, back = {}, {}
            for a, b in zip(first, first[1:], strict=False):
                for i in range(a, b):
                    if i + length > b:
                        assert names[i] == -1
                        continue
                    key = tuple(v[i : i + length])
                    assert there.setdefault(key, names[i]) == names[i] and back.setdefault(names[i], key) == key


def test_suffix_trees():
    rng = np.random.default_rng(9)
    for trial in range(80):
        sizes = rng.integers(0, 25, rng.integers(0, 12))
        first = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        v = np.tile(rng.integers(0, 1 + trial % 4, 12), 25)[: first[-1]].astype(np.uint64)
        if trial % 2:
            v = rng.integers(0, 3, first[-1]).astype(np.uint64)
        tails = {a: tuple(v[a:e].tolist()) for s, e in zip(first, first[1:], strict=False) for a in range(s, e)}
        tree = suffix_tree(v, first)
        assert [tails[p] for p in tree.order] == sorted(tails.values()) and len(set(tree.order)) == len(v)
        for i in range(1, len(v)):
            x, y = tails[tree.order[i - 1]], tails[tree.order[i]]
            assert tree.common[i] == next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        places = {}
        for p, tail in tails.items():
            for k in range(1, len(tail) + 1):
                places.setdefault(tail[:k], set()).add(p)
        for least in (1, 3):
            nodes = internal_nodes(tree, least)
            assert len(set(nodes)) == len(nodes)
            # A repeat that no token to the right extends for all its places.
            right = {(len(w), frozenset(at)) for w, at in places.items()
                     if len(w) >= least and len(at) > 1 and not any(places.get((*w, x)) == at for x in range(4))}
            assert {(d, frozenset(tree.order[a:b])) for d, a, b in nodes} == right
            both = {(d, at) for d, at in right
                    if any(p in first for p in at) or len({v[p - 1] for p in at}) > 1}
            assert {(d, frozenset(tree.order[a:b])) for d, a, b in maximal_repeats(tree, v, first, least)} == both


@pytest.mark.parametrize("rule", [Repeats(), Repeats(lines=1), Repeats(lines=3, words=99), Repeats(lines=4, words=6)])
def test_lines(spark, rule):
    rows = [(r[0], (r[1] or "").replace("  ", "\n") if r[1] is not None else None, *r[2:]) for r in awkward(5)]
    rows += [(5000 + i, "a\nb\n\nc\nd\ne" + f"\n{i}" * (i % 3), *rows[0][2:]) for i in range(6)]
    docs = spark.createDataFrame(rows, SCHEMA).dropDuplicates(["doc_id", "text"])
    rows = [tuple(r) for r in docs.collect()]
    strip = " \t\n\x0b\x0c\r"
    seq = [[(i, x.strip(strip)) for i, x in enumerate((r[1] or "").split("\n")) if x.strip(strip)] for r in rows]
    first_line, first_run = {}, {}
    for r, s in zip(rows, seq, strict=True):
        for at in range(len(s)):
            here = (id_order(r[0]), at)
            first_line[s[at][1]] = min(first_line.get(s[at][1], here), here)
            if at + rule.lines <= len(s):
                run = tuple(x for _, x in s[at : at + rule.lines])
                first_run[run] = min(first_run.get(run, here), here)
    want = []
    for r, s in zip(rows, seq, strict=True):
        gone = set()
        for at in range(len(s)):
            here = (id_order(r[0]), at)
            if len(WORD.findall(s[at][1])) >= rule.words and first_line[s[at][1]] < here:
                gone.add(s[at][0])
            if at + rule.lines <= len(s) and first_run[tuple(x for _, x in s[at : at + rule.lines])] < here:
                gone |= {i for i, _ in s[at : at + rule.lines]}
        lines = (r[1] or "").split("\n")
        text = None if r[1] is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        want.append((id_order(r[0]), text or "", len(gone), 0 if r[1] is None else len(lines)))
    got = [(id_order(r.doc_id), r.text or "", r.n_removed, r.n_lines)
           for r in without_repeated_lines(docs.repartition(3), rule).collect()]
    assert sorted(got) == sorted(want)
    assert sum(w[2] for w in want) > 3


@pytest.mark.parametrize("rule", [Repeats(), Repeats(lines=1), Repeats(lines=3)])
def test_runs_of_lines(spark, rule):
    pick = np.random.default_rng(rule.lines)
    texts = [[f"l{x}" for x in pick.integers(0, 12, pick.integers(0, 14))] for _ in range(60)]
    long = [f"p{i}" for i in range(23)]
    texts += [["x0", *long, "y0"], ["x1", "x2", *long, "y1"], long[4:17], ["again"] * 9]
    rows = [(i if i != 3 else None, "\n\n".join(t), "clash") for i, t in enumerate(texts)]
    rows += [(7, rows[7][1], "a row like another"), (900, None, ""), (901, "", "")]
    of = {r[0]: t for r, t in zip(rows, texts, strict=False)}
    got = repeated_runs(spark.createDataFrame(rows, "doc_id bigint, text string, first string").repartition(3), rule).collect()
    order = lambda d, at: (d is not None, d or 0, at)
    covered, first = set(), {}
    for r in got:
        assert r.size >= rule.lines and order(r.first_doc, r.first_start) < order(r.doc_id, r.start)
        assert of[r.doc_id][r.start : r.start + r.size] == of[r.first_doc][r.first_start : r.first_start + r.size]
        assert len(of[r.doc_id]) >= r.start + r.size
        covered |= {(r.doc_id, i) for i in range(r.start, r.start + r.size)}
    for a in got:
        assert not any(a is not b and a.doc_id == b.doc_id and b.start <= a.start and a.start + a.size <= b.start + b.size for b in got)
    for d, t in sorted(of.items(), key=lambda x: order(x[0], 0)):
        for at in range(len(t) - rule.lines + 1):
            first.setdefault(tuple(t[at : at + rule.lines]), (d, at))
    assert covered == {(d, at + k) for d, t in of.items() for at in range(len(t) - rule.lines + 1)
                       if first[tuple(t[at : at + rule.lines])] != (d, at) for k in range(rule.lines)}
    assert {(r.doc_id, *r[1:]) for r in got if r.size > 12} == {(61, 2, 23, 60, 1), (62, 0, 13, 60, 5)}
    # In a periodic text all parts start earliest at its beginning, so none goes on with the one before.
    assert sorted(tuple(r) for r in got if r.doc_id == 63) == (
        [(63, i, 6, 63, 0) for i in (1, 2, 3)] if rule.lines == 3 else [(63, 1, 8, 63, 0)])


def test_texts_stay_where_they_are_to_lose_lines(spark, monkeypatch):
    """Whatever the size: no text is shuffled, and a round deals its places by document once."""
    said = [f"line {i} has ten words or more to be told apart" for i in range(9)]
    rows = [(i % 23 or None, "\n".join(said[i % 5 :][: i % 7]), i) for i in range(60)] + [(70, None, 0), (70, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, row_of_copy int").repartition(3)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    plans, write, old = [], lines.staged, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(lines, "staged", lambda df: plans.append(plan(df)) or write(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = without_repeated_lines(docs)
        dealt = [x for x in plan(out).split("\n") if "Exchange" in x]
        assert len(dealt) == 1 and "chunk_of_copy" in dealt[0]
        assert not any(" at#" in x for p in plans for x in p.split("\n") if "Exchange hashpartitioning(key#" in x
                       and "lines_repeated" not in p)
        want = sorted(map(tuple, out.collect()), key=str)
        assert out.columns == [*docs.columns, "n_lines", "n_removed", "n_runs"] and sum(r[4] for r in want) > 60
        monkeypatch.setattr(lines, "CHUNK_BITS", 1)
        assert sorted(map(tuple, without_repeated_lines(docs).collect()), key=str) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_small_batches_settle_the_same(spark):
    """Anchors that go on over many batches, in one partition."""
    rows = awkward(31)
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, passage_report(docs).collect()), key=str)
    bytes_want = sorted(map(tuple, string_report(docs).collect()), key=str)
    old = {k: spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.shuffle.partitions")}
    try:
        for batch in (1, 3):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
            spark.conf.set("spark.sql.shuffle.partitions", "1")
            assert sorted(map(tuple, passage_report(docs).collect()), key=str) == want
            if batch == 3:
                assert sorted(map(tuple, string_report(docs).collect()), key=str) == bytes_want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
