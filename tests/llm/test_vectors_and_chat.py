"""Embeddings and conversations against brute force."""

import itertools
import random

import numpy as np

from folioworks.llm.chat import Costs, FOLLOWS, ROLES, ending, repaired_turns, steps
from folioworks.llm.embeddings import Polytopes, near_embeddings
from tests.llm.brute import groups, id_order

VECTORS = "vec_id bigint, embedding array<float>, label int, class string, unit int"


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        kind = i % 5
        v = rng.normal(size=48)
        if kind == 1 and rows:
            v = np.array(rows[rng.integers(len(rows))][1], float) + rng.normal(size=48) * rng.choice([0.05, 0.1, 0.2])
        if kind == 2:
            v = np.ones(48) + rng.normal(size=48) * 0.12  # one crowded place
        if kind == 3 and len(rows) > 5:
            v = np.array(rows[4][1], float)  # copies
        rows.append((1000 - i, [float(x) for x in v.astype(np.float32)], int(rng.integers(2)), "c", 0))
    rows += [(1, None, 1, "", 0), (2, [0.0] * 48, 1, "", 0), (3, [1.0, None], 1, "", 0), (4, [float("nan")] * 48, 0, "", 0),
             (5, rows[0][1], None, "", 0), (6, [], 1, "", 0), (7, [float("inf")] * 48, 1, "", 0), (8, [1.0, 2.0], 1, "", 0),
             (9, [2.0, 4.0], 1, "", 0), (None, [-1.0, 2.0], 1, "", 0), (11, [1e30] * 3, 1, "", 0), (12, [1e-30] * 3, 1, "", 0), rows[4]]
    unit = {}
    for n, (_, v, label, *_) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            x /= np.abs(x).max()
            unit[n] = x / np.sqrt((x * x).sum())
    links = [(a, b) for a, b in itertools.combinations(unit, 2)
             if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98]
    got = near_embeddings(spark.createDataFrame(rows, VECTORS).repartition(3), Polytopes(block=16)).collect()
    n_links = [0] * len(rows)
    for a, b in links:
        n_links[a] += 1
        n_links[b] += 1
    assert sum(x.n_links for x in got) >= 0.98 * sum(n_links) > 500
    assert len(got) == len(rows)
    root = groups(len(rows), links)
    least = {}
    for n, g in enumerate(root):
        if rows[n][0] is not None:
            least[g] = min(least.get(g, 1 << 62), rows[n][0])
    want = sorted((id_order(r[0]), n, id_order(least.get(g))) for r, n, g in zip(rows, n_links, root, strict=True))
    found = sorted((id_order(x.vec_id), x.n_links, id_order(x.component_id)) for x in got)
    assert sum(a == b for a, b in zip(found, want, strict=True)) >= 0.97 * len(rows)
    assert all(a[1] <= b[1] for a, b in zip(found, want, strict=True))
    assert all(x.kept == (x.vec_id == x.component_id) for x in got)
    assert near_embeddings(spark.createDataFrame([], VECTORS)).count() == 0


def cheapest(turns, costs):
    """All ways through the automaton."""
    best = {0: 0}
    for role, blank in turns:
        after = {}
        for state, cost in best.items():
            for c, to, _, _ in steps(role, blank, costs)[state]:
                after[to] = min(after.get(to, 1 << 60), cost + c)
        best = after
    return min(c + ending(s, costs)[0] for s, c in best.items())


def test_chat(spark):
    r = random.Random(6)
    roles = ["user", "assistant", "system", "User ", "human", "tool", None, "gpt"]
    rows = []
    for conv in range(60):
        for turn in range(r.choice([1, 2, 5, 9])):
            rows.append((conv, turn if r.random() < 0.9 else None, r.choice(roles), r.choice(["hello", "", None, "a\nb", " "]), "x"))
    rows += [(None, t, "user", "lost", "x") for t in range(3)] + [(77, 1, "user", "same", "x")] * 4
    rows += [(99, t, r.choice(roles), "long", "x") for t in range(700)]  # meets many partitions
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, block string")
    got = repaired_turns(turns.repartition(3)).collect()
    costs = Costs()
    names = dict(costs.names)
    talks, pieces = {}, {}
    for row in rows:
        talks.setdefault(row[0], []).append(row)
    for x in got:
        pieces.setdefault(x.conv_id, []).append(x)
    assert talks.keys() == pieces.keys()
    for conv, own in pieces.items():
        own.sort(key=lambda x: x.piece)
        said = [x for x in own if x.action in ("keep", "relabel", "merge")]
        assert len(said) == len(talks[conv])
        assert [x.turn if x.turn is not None else -1 for x in said] == sorted(x.turn if x.turn is not None else -1 for x in said)
        heard = [(names.get((x.role or "").strip().lower(), 0)) for x in said]
        texts = {}
        for row in talks[conv]:
            texts.setdefault((row[1], row[2]), []).append(not (row[3] or "").strip(" "))
        # The result is legal, and what it costs is the least.
        out = [ROLES.index(x.out_role) for x in own if x.action in ("keep", "relabel", "insert")]
        state = 0
        for role in out:
            assert role in FOLLOWS[state]
            state = role
        assert state == 3 and own[-1].action == "end"
        rendered = "".join(x.rendered for x in own)
        assert rendered.count("<|end|>") == len(out) == own[-1].out_turn
        assert [x.split("|>")[0] for x in rendered.split("<|")[1::2]] == [ROLES[s] for s in out]
        if all(len(set(b)) == 1 for b in texts.values()):
            paid, state = 0, 0
            blanks = [texts[(x.turn, x.role)][0] for x in said]
            for x in own:
                if x.action == "insert":
                    paid += costs.insert
                elif x.action in ("keep", "relabel", "merge"):
                    role, blank = heard.pop(0), blanks.pop(0)
                    if x.action == "relabel":
                        paid += costs.relabel_unknown if role == 0 else costs.relabel
                    elif x.action == "merge":
                        paid += (costs.merge_blank if blank else costs.merge_same if role == state
                                 else costs.merge_unknown if role == 0 else costs.merge_other)
                if x.out_role:
                    state = ROLES.index(x.out_role)
            heard = [(names.get((x.role or "").strip().lower(), 0)) for x in said]
            blanks = [texts[(x.turn, x.role)][0] for x in said]
            assert paid == cheapest(list(zip(heard, blanks, strict=True)), costs)
    assert repaired_turns(turns.limit(0)).count() == 0
