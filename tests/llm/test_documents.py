"""Secrets, near duplicates, leaks, language and mixing against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from folioworks.llm.credentials import secret_report, secret_spans
from folioworks.llm.decontamination import leak_report
from folioworks.llm.language import Training, identified, learned, train
from folioworks.llm.minhash import Near, near_documents
from folioworks.llm.mixing import Mix, mixed
from folioworks.llm.tokens import word_hashes
from tests.llm.brute import SCHEMA, awkward, groups, id_order, sha, shingles, words
from pyspark.sql import functions as F

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets(spark):
    r = random.Random(1)
    live, example = "Zk3vQ9xT1mB7yLw2Rd8sPf", "Example9Token0Value1Shared2Everywhere"
    bits = ["password = 'hunter2hunter'", "Secret:abc", "secret=token:abcdef", 'api_key="a/b+c_d.e=f-"', "APIKEY : x1y2z3",
            "AKIA" + "Q7" * 9, "AKIA12", "0123456789abcdef" * 2, "deadbeef", "é 日本 token=ñandú", "passwd==secret99", example,
            "token:" + "A1b2C3d4E5f6G7h8I9j0K1l2", "\U0001f600 secret = abcdefgh", "TOKEN= \n password:zzzzzz"]
    rows = [(i, " ".join(r.choice(bits) for _ in range(r.randint(0, 7))), "en", f"s{i % 4}", 0, i, "k", "t") for i in range(80)]
    rows += [(90, f"{live} here", "en", "s1", 0, 0, "", ""), (91, None, None, None, 0, 0, "", ""), (92, "", None, None, 0, 0, "", ""),
             (90, f"{live} here", "en", "s1", 0, 0, "", ""), (None, "password=abcdef", None, None, 0, 0, "", ""),
             (95, "token=abcdef " * 3000, "en", "s1", 0, 0, "", "")]
    got = secret_report(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    kinds = ("assign", "access", "hex")
    want, seen = [], []
    for row in rows:
        spans = base_spans(row[1])
        listed = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans)
        want.append((id_order(row[0]), *(sum(k == n for _, k, _ in spans) for n in range(3)), sha(listed.encode())))
    for x in got:
        seen.append((id_order(x.doc_id), x.n_assign, x.n_access, x.n_hex, x.base_sha256))
        kept = [s for s in x.spans.split(",") if s and not s.startswith("token")]
        assert sha(",".join(kept).encode()) == x.base_sha256
    assert sorted(seen) == sorted(want)
    assert [x.spans for x in got if x.doc_id == 90] == [f"token:0:{len(live)}"] * 2
    assert all(x.n_shared > 0 for x in got if x.doc_id is not None and x.doc_id < 80 and "assign" in x.spans)
    # What many owners hold is listed and no live token.
    texts = {row[0]: row[1] for row in rows}

    def tokens(column):
        return [texts[x.doc_id][int(a) : int(b)] for x in got if x.doc_id is not None
                for k, a, b in (s.split(":") for s in x[column].split(",") if s) if k == "token"]

    assert example in tokens("spans") and example not in tokens("live_spans") and live in tokens("live_spans")
    assert all(x.n_live == x.live_spans.count(":") // 2 for x in got)
    assert all(x.n_live + x.n_shared == x.spans.count(":") // 2 for x in got)
    assert secret_report(spark.createDataFrame([], SCHEMA)).count() == 0


def near_rows():
    r = random.Random(11)
    rows = awkward(21, 40)
    base = [f"w{r.randrange(5000)}" for _ in range(120)]
    for i in range(40):
        w = list(base)
        for _ in range(r.choice([0, 1, 1, 2, 3, 4])):
            w[r.randrange(len(w))] = f"x{i}"
        rows.append((2000 - i, " ".join(w).upper() if i % 3 == 0 else " ".join(w), "en", "s", 0, 0, "", ""))
    # A chain: each differs from the next by little, the ends by much.
    for i in range(12):
        w = [f"c{j}" if j >= i * 4 else f"d{j}" for j in range(150)]
        rows.append((3000 + i, " ".join(w), "en", "s", 0, 0, "", ""))
    return rows


@pytest.mark.parametrize("copies", [3, 4, 400, 4000])
def test_a_secret_is_found_however_often_its_owner_repeats_it(spark, copies):
    live, lent = "Zk3vQ9xT1mB7yLw2Rd8sPf", "Ab5cD7eF9gH1iJ3kL5mN7o"
    rows = [(i, f"{live} in {i % 7}", "en", "one", 0, 0, "", "") for i in range(copies)]
    rows += [(i + copies, f"{lent} in {i}", "en", f"s{i % 2}", 0, 0, "", "") for i in range(copies)]
    rows.append((None, f"{live} and {lent}", "en", "one", 0, 0, "", ""))
    got = secret_report(spark.createDataFrame(rows, SCHEMA)).collect()
    span = f"token:0:{len(live)}"
    assert all((x.spans, x.live_spans, x.n_live, x.n_shared) == (span, span, 1, 0)
               for x in got if x.doc_id is not None and x.doc_id < copies)
    assert all((x.spans, x.live_spans, x.n_live, x.n_shared) == (span, "", 0, 1)
               for x in got if x.doc_id is not None and x.doc_id >= copies)
    both = next(x for x in got if x.doc_id is None)
    assert (both.n_token, both.n_live, both.n_shared) == (2, 1, 1)
    _, spans = secret_spans(spark.createDataFrame(rows, SCHEMA))
    texts = len({r[1] for r in rows if live in r[1]})
    assert {r.repos for r in spans.filter("owners = 1").collect()} == {texts}


def morse(length):
    """A word in which sums of powers of any odd base cancel out against its opposite, and that opposite."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(length))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_words_that_fool_polynomials_are_not_equal(spark, length):
    rows = [(i, w, "en", "s", 0, 0, "", "") for i, w in enumerate(morse(length))]
    got = near_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((x.doc_id, x.component_id, x.kept) for x in got) == [(0, 0, True), (1, 1, True)]


def test_word_hashes_tell_words_apart():
    r = random.Random(6)
    said = {"".join(r.choice("abAB\u00e9\u00ff\U0001f600\x00\x01") for _ in range(r.randint(1, 14))) for _ in range(30_000)}
    said |= {w + "\x00" for w in list(said)[:500]}
    texts = [w.encode() for w in sorted(said)]
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = ends - [len(t) for t in texts]
    assert len(np.unique(word_hashes(raw, starts, ends, lower=False))) == len(texts)
    low = {re.sub(b"[A-Z]", lambda m: m[0].lower(), t) for t in texts}
    assert len(np.unique(word_hashes(raw, starts, ends, lower=True))) == len(low)


@pytest.mark.parametrize("percent", [85, 80])
def test_near_documents(spark, percent):
    rows = near_rows()
    sets = [shingles(r[1]) for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = groups(len(rows), links)
    least = defaultdict(list)
    for i, g in enumerate(root):
        if rows[i][0] is not None:
            least[g].append(rows[i][0])
    want = sorted((id_order(r[0]), len(s), id_order(min(least[g])) if least[g] else id_order(None))
                  for r, s, g in zip(rows, sets, root, strict=True))
    got = near_documents(spark.createDataFrame(rows, SCHEMA).repartition(4), Near(percent)).collect()
    assert sorted((id_order(x.doc_id), x.n_shingles, id_order(x.component_id)) for x in got) == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in got)
    assert len(set(root)) < len(rows) - 30
    assert near_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_leaks(spark):
    r = random.Random(2)

    def said(n):
        return [f"{r.choice('abcdefgh')}{r.randrange(900)}" for _ in range(n)]

    items = [(i, " ".join(said(n))) for i, n in enumerate([30, 30, 45, 59, 15, 20, 3, 1])]
    items += [(20, None), (21, " ! "), (22, items[0][1])]
    rows = []
    for i in range(120):
        w = said(r.choice([0, 2, 30, 200, 800]))
        if i % 3 == 0:
            leak = r.choice(items[:6])[1].split()
            change = r.random()
            if change < 0.3:
                leak[r.randrange(len(leak))] = "other"
            elif change < 0.5:
                leak.insert(len(leak) // 2, "more")
            elif change < 0.6:
                leak = leak[: len(leak) // 2]
            at = r.randint(0, len(w))
            w[at:at] = [x.upper() + "," if change > 0.8 else x for x in leak]
        rows.append((i, " ".join(w), "en", "s", 0, 0, "", ""))
    rows += [(500, None, None, None, 0, 0, "", ""), (501, "", None, None, 0, 0, "", ""), rows[3], (None, items[3][1], None, None, 0, 0, "", ""),
             (502, items[6][1], None, None, 0, 0, "", "")]

    def spoken(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    def weighted(w, width):
        return Counter(tuple(w[i : i + width]) for i in range(len(w) - width + 1))

    want = []
    for row in rows:
        w = spoken(row[1])
        found = set()
        for item, text in items:
            t = spoken(text)
            if not t:
                continue
            width = min(5, len(t))
            a = weighted(t, width)
            for s in range(-len(t) + 1, len(w)):
                b = weighted(w[max(0, s) : max(0, s + len(t))], width)
                both = sum((a & b).values())
                if both and both / (sum(a.values()) + sum(b.values()) - both) >= 0.8:
                    found.add(item)
        want.append((id_order(row[0]), sorted(found)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = leak_report(docs, bench).collect()
    assert sorted((id_order(x.doc_id), list(x.item_ids)) for x in got) == sorted(want)
    assert sum(bool(w[1]) for w in want) > 20
    assert all(x.contaminated == bool(x.item_ids) == (x.similarity >= 0.8) for x in got)
    assert leak_report(docs.limit(0), bench).count() == 0
    assert not leak_report(docs, bench.limit(0)).filter("contaminated").count()


def test_leaks_in_another_order(spark):
    """Halves that stand the other way round: most shingles are there, none in the place it has in the item."""
    items = [(n, [f"i{n}w{j}" for j in range(n)]) for n in (40, 59)]
    around = [f"x{j}" for j in range(100)]
    rows = [(n * 10 + k, " ".join(around[:k] + w[n // 2 :] + w[: n // 2] + around[k:])) for n, w in items for k in (0, 3, 100)]
    rows.append((7, " ".join(around)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id bigint, text string")
    got = {x.doc_id: (list(x.item_ids), x.similarity) for x in leak_report(docs, bench).collect()}
    assert got.pop(7) == ([], 0.0)
    # 51 of 59 shingles at 59 words, 32 of 40 at 40 words.
    assert all(got[590 + k][0] == [59] and abs(got[590 + k][1] - 51 / 59) < 1e-9 for k in (0, 3, 100))
    assert all(got[400 + k] == ([40], 0.8) for k in (0, 3, 100))


def test_language(spark):
    r = random.Random(3)
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["sch", "ung", "ein"], "cc": ["é", "aux", "que"]}
    rows = [(i, " ".join("".join(r.choice(syllables[lang]) for _ in range(3)) for _ in range(r.randint(5, 80))),
             lang if i % 9 else None, "s", 0, 0, "", "") for i in range(300) for lang in [r.choice(list(syllables))]]
    rows += [(900, None, "aa", "s", 0, 0, "", ""), (901, "", "bb", "s", 0, 0, "", ""), (902, "12 !?", "aa", "s", 0, 0, "", ""), rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", F.lit(1).alias("score"))
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    got = identified(docs, learned(docs, part != 1)).collect()
    assert len(got) == len(rows)
    for x in got:
        if x.doc_id >= 900:
            assert (x.lang_pred, x.score, x.rejected) == ("und", 0.0, True)
        else:
            assert x.lang is None or x.lang_pred == x.lang
            assert 0 <= x.score <= 1
    assert sum(x.rejected for x in got) < 10
    nothing = identified(docs, train([], [], Training())).collect()
    assert {x.lang_pred for x in nothing} == {"und"}
    assert identified(docs.limit(0), learned(docs.limit(0), F.lit(True))).count() == 0


def filled(sizes):
    """Targets by resharing what is over the cap, step by step."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def test_mixing(spark):
    rows = [(*r[:3], {0: "a", 1: "é", 2: None, 3: "Z", 4: "tiny"}[min(4, n % 9)], *r[4:]) for n, r in enumerate(awkward(9, 90))]
    rows.append((7000, "word " * 3, None, "\U0001f600", 0, 0, "", ""))
    rows.append((7001, None, None, "empty", 0, 0, "", ""))
    docs = spark.createDataFrame(rows, SCHEMA)
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(words(r[1]))
    target = filled(size)
    first = mixed(docs.repartition(5)).collect()
    again = mixed(docs.repartition(2), Mix(cells=1)).collect()
    key = lambda x: (id_order(x.doc_id), x.size, x.source or "", x.taken, x.position or -1, str(x.positions))
    assert sorted(map(key, first)) == sorted(map(key, again))
    assert Counter((id_order(x.doc_id), x.source, x.size) for x in first) == Counter(
        (id_order(r[0]), r[3], len(words(r[1]))) for r in rows)
    taken = defaultdict(int)
    for x in first:
        assert x.source_size == size[x.source] and abs(x.target - target[x.source]) < 1e-6
        assert 0 <= x.taken <= 3 * x.size
        assert (x.positions is None) == (x.taken == 0)
        assert x.positions is None or (sorted(x.positions) == list(x.positions) and 0 <= x.positions[0] < 1)
        taken[x.source] += x.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in size)
    order = [x.position for x in first if x.position is not None]
    assert order == sorted(order)
    # A source on the rise is met late, one on the fall early.
    middle = {s: sum(p for x in first if x.source == s for p in x.positions or []) / max(
        1, sum(len(x.positions or []) for x in first if x.source == s)) for s in size}
    assert middle["Z"] > 0.5 > middle["tiny"] or len(size) < 4
    assert mixed(docs.limit(0)).count() == 0
