"""Exact copies, spelling variants and phrases against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from folioworks.llm.bloom import block_of, collected, holds, marked
from folioworks.llm.copies import Exchange, exact_copies, golomb, golomb_read
from folioworks.llm.phrases import Phrases, _cut, collocations
from folioworks.llm.spelling import Spelling, near_words, spelling_variants, vocabulary
from tests.llm.brute import awkward, id_order, sha

# Extra columns have the names the operators use inside.
EXTRA = "doc_id bigint, text string, lang string, part int, at int, marks string, word string, n bigint, phrase string, hash bigint"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def table(spark, rows):
    return spark.createDataFrame([(i, t, l, 0, 0, "m", "w", 0, "p", 0) for i, t, l in rows], EXTRA)


@pytest.mark.parametrize("seed", range(6))
def test_golomb_codes_come_back(seed):
    r = np.random.default_rng(seed)
    for n, top in ((1, 1), (1, 1 << 40), (7, 10), (3000, 4000), (3000, 1 << 34)):
        values = np.unique(r.integers(0, top, n)).astype(np.uint64)
        shift, unary, rest = golomb(values)
        assert (golomb_read(len(values), shift, unary, rest) == values.astype(np.int64)).all()
        if n == 3000 and top > 4000:
            assert len(unary) + len(rest) < len(values) * 4


@pytest.mark.parametrize("how", [Exchange(), Exchange(spare_bits=0, owner_rows=3)])
def test_exact_copies(spark, how):
    rows = [(r[0], r[1], "en") for r in awkward(5)]
    rows += [(5000 + i, t, None) for i, t in enumerate(["Same TEXT", "same text", "SAME text", "É", "é", "same text "] * 3)]
    rows += [(None, "same text", "en"), (None, "only null ids", "en"), (None, "Only null ids", "en"), (7000, "x" * 3_000_000, "en"),
             (7001, "X" * 3_000_000, "en"), (7002, "twice", "en"), (7002, "twice", "en")]
    rows += [(9000 + i, "a very common text", "en") for i in range(400)]
    got = exact_copies(table(spark, rows).repartition(5), how).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[lower(t)].append(i)
    assert len(got) == len(rows)
    seen = defaultdict(list)
    for x in got:
        seen[x.text_sha256].append(x)
    for text, ids in groups.items():
        mine = seen.pop(sha(text.encode()))
        best = max(ids, key=id_order)
        assert sorted(id_order(x.doc_id) for x in mine) == sorted(map(id_order, ids))
        assert {(x.keep_id, x.group_size) for x in mine} == {(best, len(ids))}
        assert [x.doc_id for x in mine if x.kept] == [best]
    assert not seen
    empty = exact_copies(table(spark, []))
    assert empty.count() == 0 and empty.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_bloom_filters_lose_nothing(spark):
    hashes = np.random.default_rng(2).integers(0, 2**63, 5000).astype(np.uint64)
    for blocks in (1, 3, 200):
        where = block_of(hashes, blocks)
        df = spark.createDataFrame(list(zip(where.tolist(), hashes.view(np.int64).tolist())), "block bigint, hash bigint")
        bits = collected(marked(df.repartition(3)), 0, blocks)
        assert holds(bits, where, hashes).all()
    other = np.random.default_rng(3).integers(0, 2**63, 5000).astype(np.uint64)
    assert holds(bits, block_of(other, 200), other).mean() < 0.02


def spoken(seed, docs=60):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdÉéßÿ") for _ in range(r.randint(4, 8))) for _ in range(60)]

    def said():
        w = r.choice(stems)
        if r.random() < 0.3:
            at = r.randrange(len(w) + 1)
            w = w[:at] + r.choice(["", "a", "é", "z"]) + w[at + r.randint(0, 1):]
        return w.upper() if r.random() < 0.1 else w

    rows = [(r.choice([i, i, None]), "".join(said() + r.choice([" ", ", ", "1", "\n", "ñ×", "ŵ"]) for _ in range(r.randint(0, 80))), "en")
            for i in range(docs)]
    return rows + [(900, None, "en"), (901, "", "en"), (902, "é" * 300 + " aabbb" * 30, None), rows[3]]


def variants(rows, damage):
    n = Counter()
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower(t)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % damage else run[: h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    others = {w: [x for x in n if x != w and near(w, x)] for w in n}
    form = {}
    for w, xs in others.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(others[w]), n.get(form[w], -1)) for w in n), others


@pytest.mark.parametrize("how", [Spelling(damage=7), Spelling(damage=7, filter_bytes=64, bits=200, chunk=40), Spelling(damage=3, bits=1)])
def test_spelling_variants(spark, how):
    rows = spoken(4)
    want, others = variants(rows, how.damage)
    docs = table(spark, rows).repartition(4)
    got = spelling_variants(docs, how).collect()
    assert sorted((x.word, x.form or "", x.root, x.n, x.n_near, -1 if x.form_n is None else x.form_n) for x in got) == want
    assert sum(w[1] != "" for w in want) > 2
    pairs = near_words(vocabulary(docs, how), how).collect()
    assert sorted((p.word, p.other) for p in pairs) == sorted((w, x) for w, xs in others.items() for x in xs)
    assert spelling_variants(table(spark, []), how).count() == 0


def test_roots_of_long_chains(spark):
    """Each word twice as frequent as the one before it, ten steps to the root."""
    chain = ["a" * k + "b" * (15 - k) for k in range(11)]
    rows = [(1, " ".join(w + " x" for k, w in enumerate(chain) for _ in range(3 * 2**k)), "en")]
    got = {x.word: x for x in spelling_variants(table(spark, rows), Spelling(damage=None)).collect()}
    assert [got[w].form for w in chain] == chain[1:] + [None]
    assert {got[w].root for w in chain} == {chain[-1]}


def phrases(rows, support, top):
    f, n = defaultdict(Counter), Counter()
    for _, t, lang in rows:
        for piece in re.split("[.,;:!?\n-\r]", lower(t)):
            w = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(w)
            for k in (1, 2, 3):
                f[lang or "und"].update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        often = {p: c for p, c in count.items() if c >= support}
        best = []
        for p, a in often.items():
            w = p.split(" ")
            around = [c for q, c in often.items() if len(q.split(" ")) > len(w) and f" {p} " in f" {q} "]
            if len(w) == 1 or any(100 * c >= 50 * a for c in around):
                continue
            cuts = [(10**6 * a * a // (count[x] * count[y]), k, count[x], count[y])
                    for k in range(1, len(w)) for x, y in [(" ".join(w[:k]), " ".join(w[k:]))]]
            score, _, left, right = min(cuts)
            best.append((-score, -a, p.encode(), p, left, right))
        for rank, (s, a, _, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, p, -a, left, right, n[lang], -s))
    return sorted(out)


def chatter(seed, docs=80):
    r = random.Random(seed)
    words = ["".join(r.choice("abcß") for _ in range(r.randint(1, 3))) for _ in range(14)]
    set_ = [["new", "york", "city"], ["of", "the"], ["New", "York"], ["Ünder", "way"]]
    rows = []
    for i in range(docs):
        said = [x for _ in range(r.randint(0, 60)) for x in (r.choice(set_) if r.random() < 0.3 else [r.choice(words)])]
        text = "".join(w + r.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "\r\n"]) for w in said)
        rows.append((i, text, r.choice(["en", "en", "en", "de", None, "und"])))
    return rows + [(800, None, "en"), (801, "", None), (802, "a a a a a a " * 400, "en"), (803, "a. " * 500, "de"), rows[1]]


@pytest.mark.parametrize("how", [
    Phrases(support=4, top=40), Phrases(support=4, top=40, shard=300), Phrases(support=25, top=9, shard=5000, filter_bytes=64),
    Phrases(support=4, top=40, languages=1, bits=1)])
def test_collocations(spark, how):
    rows = chatter(9)
    got = collocations(table(spark, rows).repartition(4), how)
    assert sorted(tuple(x) for x in got.collect()) == phrases(rows, how.support, how.top)
    assert collocations(table(spark, []), how).count() == 0


def test_shards_of_one_long_text_end_at_breaks():
    text = b"one two three. " * 500 + b"x" * 900 + b" and, " + b"four five"
    raw = np.frombuffer(text, np.uint8)
    parts = [text[a:b] for a, b, _ in _cut(raw, np.array([0, len(raw)]), 200)]
    assert b"".join(parts) == text and all(p[-1:] in b".," for p in parts[:-1]) and max(map(len, parts)) < 1100
    assert len(parts) > 30
