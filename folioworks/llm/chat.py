"""Chat formatting: the cheapest repair of a conversation's roles, then its rendering.

Legal conversations are those of a small automaton: an optional system turn, then user and assistant turns in
alternation, the assistant last. Each turn is kept, given another role, merged into the turn before or preceded by an
empty turn; dynamic programming over the automaton's states finds the cheapest way. Costs add up along a path, so a
block of turns acts as a small matrix of costs from state to state, and blocks combine in order: a conversation that
holds most rows is worked on in as many blocks as it has range partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from folioworks.llm.common import for_workers, no_null, partitions, staged

# States: nothing said yet, or the role of the turn said last.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FAR = 1 << 60


@dataclass(frozen=True)
class Costs:
    """What each repair costs; keeping a turn is free. ``names`` map the spellings of roles to states."""

    relabel: int = 4
    relabel_unknown: int = 1
    merge_same: int = 2
    merge_unknown: int = 3
    merge_other: int = 6
    merge_blank: int = 1
    insert: int = 5
    names: tuple[tuple[str, int], ...] = (
        ("system", SYSTEM), ("developer", SYSTEM), ("user", USER), ("human", USER), ("assistant", ASSISTANT),
        ("ai", ASSISTANT), ("bot", ASSISTANT), ("gpt", ASSISTANT), ("model", ASSISTANT),
    )


def steps(role: int, blank: bool, costs: Costs) -> list[list[tuple[int, int, int, int]]]:
    """For each state the ways to take one turn: (cost, next state, empty turn inserted before or 0, merged).

    ``role`` is START for an unknown one. Ways come in the order in which ties are settled: keep, merge, relabel,
    insert.
    """
    ways: list[list[tuple[int, int, int, int]]] = []
    for state in range(4):
        found = []
        said = [(0, r) for r in FOLLOWS[state]] + [(i, r) for i in FOLLOWS[state] for r in FOLLOWS[i]]
        for inserted, r in said:
            cost = 0 if r == role else costs.relabel_unknown if role == START else costs.relabel
            found.append((cost + (costs.insert if inserted else 0), r, inserted, 0))
        if state != START:
            cost = (costs.merge_blank if blank else costs.merge_same if state == role
                    else costs.merge_unknown if role == START else costs.merge_other)
            found.append((cost, state, 0, 1))
        found.sort(key=lambda w: (w[0], w[2] != 0, w[3] == 0 and w[1] != role))
        ways.append(found)
    return ways


def ending(state: int, costs: Costs) -> tuple[int, list[int]]:
    """What it costs to end in a state, and the empty turns that do it."""
    turns: list[int] = []
    while state not in (START, ASSISTANT):
        state = FOLLOWS[state][0]
        turns.append(state)
    return costs.insert * len(turns), turns


def block_costs(turns: Sequence[tuple[int, bool]], start: int, costs: Costs, known: dict) -> tuple[list, list]:
    """From one state through a block: the cheapest cost of each end state, and for each turn how it is reached."""
    best = [FAR] * 4
    best[start] = 0
    back = []
    for turn in turns:
        ways = known.get(turn)
        if ways is None:
            ways = known[turn] = steps(*turn, costs)
        after: list[int] = [FAR] * 4
        how: list[tuple | None] = [None] * 4
        for state in range(4):
            if best[state] < FAR:
                for cost, to, inserted, merged in ways[state]:
                    if best[state] + cost < after[to]:
                        after[to], how[to] = best[state] + cost, (state, inserted, merged)
        best = after
        back.append(how)
    return best, back


def path(back: list, end: int) -> list[tuple[int, int, int, int]]:
    """(state before, state after, inserted, merged) for each turn of the cheapest way to an end state."""
    out = []
    for how in reversed(back):
        before, inserted, merged = how[end]
        out.append((before, end, inserted, merged))
        end = before
    return out[::-1]


def _blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole (conversation, block) groups out of frames sorted by them."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat((rest, frame), ignore_index=True)
        if frame.empty:
            continue
        key = frame[["conversation", "block"]]
        last = (key == key.iloc[-1]).all(axis=1)
        whole = frame[~last]
        rest = frame[last].reset_index(drop=True)
        if len(whole):
            for _, group in whole.groupby(["conversation", "block"], sort=False):
                yield group
    if rest is not None and len(rest):
        yield rest


def _turns(group: pd.DataFrame) -> list[tuple[int, bool]]:
    return list(zip(group["state"].tolist(), group["blank"].tolist(), strict=True))


def repaired_turns(turns: DataFrame, costs: Costs = Costs(), id_column: str = "conv_id", turn_column: str = "turn",
                   role_column: str = "role", text_column: str = "text") -> DataFrame:
    """One row per piece of the repaired conversations: conv_id, piece, turn, role, action, out_turn, out_role, rendered.

    Pieces in the order of ``piece`` joined together are the rendered conversation. There is a piece for every row of
    ``turns`` (action keep, relabel or merge) and for every empty turn (insert, with null turn and role, just before
    the piece of the turn it makes legal, or at the end); ``out_turn`` counts the turns of the result from 0. A role is
    read without case or outer spaces; null or any other is unknown and takes what is cheapest. Null and blank text is
    an empty turn, cheap to merge. Turns are ordered by number (null first), then role and text; equal rows are
    repeated turns. Rows with a null conversation are one conversation. An empty table gives no rows, other columns
    are not read.
    """
    spark = for_workers(turns.sparkSession)
    names = F.create_map(*(F.lit(x) for pair in costs.names for x in pair))
    rows = turns.select(
        F.col(id_column).alias("conv_id"), no_null(F.col(id_column)).alias("conversation"),
        F.col(turn_column).alias("turn"), F.col(role_column).cast("string").alias("role"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    order = ["conversation", F.asc_nulls_first("turn"), "role", "_text"]
    # Equal rows may be spread over partitions by their place in the input.
    ordered = staged(
        rows.withColumn("_text", F.xxhash64("text")).withColumn("_place", F.monotonically_increasing_id())
        .repartitionByRange(partitions(spark), *order, "_place").sortWithinPartitions(*order, "_place")
        .select(
            "conv_id", "conversation", "turn", "role", "text",
            F.spark_partition_id().alias("block"),
            F.monotonically_increasing_id().alias("at"),
            F.coalesce(F.try_element_at(names, F.lower(F.trim("role"))), F.lit(START)).alias("state"),
            F.trim("text").eqNullSafe("").alias("blank"),
        )
    )
    dealt = (
        ordered.select("conversation", "block", "at", "state", "blank")
        .repartition(partitions(spark), "conversation", "block").sortWithinPartitions("conversation", "block", "at")
    )

    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        out = []
        for group in _blocks(frames):
            these = _turns(group)
            cost, turns_said = [], []
            for start in range(4):
                best, back = block_costs(these, start, costs, known)
                cost += best
                turns_said += [
                    sum((i > 0) + (1 - m) for _, _, i, m in path(back, end)) if best[end] < FAR else 0
                    for end in range(4)]
            out.append((group["conversation"].iloc[0], int(group["block"].iloc[0]), cost, turns_said))
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=["conversation", "block", "cost", "said"])
                out = []
        yield pd.DataFrame(out, columns=["conversation", "block", "cost", "said"])

    def chosen(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for conversation, blocks in zip(frame["conversation"], frame["blocks"], strict=True):
                best, trail = [0, FAR, FAR, FAR], []
                for b in blocks:
                    after, came = [FAR] * 4, [0] * 4
                    for s in range(4):
                        for e in range(4):
                            if best[s] + b["cost"][4 * s + e] < after[e]:
                                after[e], came[e] = best[s] + b["cost"][4 * s + e], s
                    best = after
                    trail.append(came)
                end = min(range(4), key=lambda e: best[e] + ending(e, costs)[0])
                states = [end]
                for came in reversed(trail):
                    states.append(came[states[-1]])
                states.reverse()
                said = 0
                for n, b in enumerate(blocks):
                    s, e = states[n], states[n + 1]
                    out.append((conversation, b["block"], s, e, said, n == len(blocks) - 1))
                    said += b["said"][4 * s + e]
            yield pd.DataFrame(out, columns=["conversation", "block", "from", "to", "said", "final"])

    matrix = dealt.mapInPandas(matrices, "conversation string, block int, cost array<bigint>, said array<bigint>")
    # One entry per block of a conversation: at most as many as there are range partitions.
    plan = (
        matrix.groupBy("conversation")
        .agg(F.array_sort(F.collect_list(F.struct("block", "cost", "said"))).alias("blocks"))
        .mapInPandas(chosen, "conversation string, block int, from int, to int, said bigint, final boolean")
    )

    def decisions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        columns = ["at", "step", "action", "before", "out_turn", "out_state"]
        out = []
        for group in _blocks(frames):
            first = group.iloc[0]
            _, back = block_costs(_turns(group), int(first["from"]), costs, known)
            said = int(first["said"])
            for at, role, (before, after, inserted, merged) in zip(
                    group["at"].tolist(), group["state"].tolist(), path(back, int(first["to"])), strict=True):
                if inserted:
                    out.append((at, 0, "insert", before, said, inserted))
                    said, before = said + 1, inserted
                said += not merged
                action = "merge" if merged else "keep" if role == after else "relabel"
                out.append((at, 1, action, before, said - 1, after))
            if first["final"]:
                before = int(first["to"])
                for turn in ending(before, costs)[1]:
                    out.append((at, 2 + turn, "insert", before, said, turn))
                    said, before = said + 1, turn
                out.append((at, 9, "end", before, said, START))
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=columns)
                out = []
        yield pd.DataFrame(out, columns=columns)

    decided = (
        dealt.join(plan, ["conversation", "block"])
        .repartition(partitions(spark), "conversation", "block").sortWithinPartitions("conversation", "block", "at")
        .mapInPandas(decisions, "at bigint, step int, action string, before int, out_turn bigint, out_state int")
    )
    said = F.array(*(F.lit(r) for r in ROLES))
    closing = F.when(F.col("before") != START, "<|end|>\n").otherwise("")
    turn = ~F.col("action").isin("insert", "end")
    rendered = (
        F.when(F.col("action") == "merge", F.concat(F.lit("\n"), "text"))
        .when(F.col("action") == "end", closing)
        .otherwise(F.concat(closing, F.lit("<|"), F.get(said, F.col("out_state")), F.lit("|>\n"),
                            F.when(turn, F.col("text")).otherwise("")))
    )
    return decided.join(ordered, "at").select(
        "conv_id",
        (F.col("at") * 16 + F.col("step")).alias("piece"),
        F.when(turn, F.col("turn")).alias("turn"),
        F.when(turn, F.col("role")).alias("role"),
        "action", "out_turn",
        F.when(F.col("action") != "end", F.get(said, F.col("out_state"))).alias("out_role"),
        rendered.alias("rendered"),
    )
