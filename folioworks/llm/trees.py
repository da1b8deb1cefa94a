"""Suffix trees of many short sequences at once, as the order of their suffixes and the prefixes neighbours share.

A node of the tree is a run of suffixes in this order; its depth is the shortest prefix that neighbours within the run
share. Cutting the order wherever neighbours share fewer than ``depth`` tokens gives the tops of all subtrees of that
depth: each holds all places of one sequence of ``depth`` tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Tree:
    """``order`` holds the places of all suffixes, ``common`` how many tokens each shares with the one before it."""

    order: np.ndarray
    common: np.ndarray


def _tied(new: np.ndarray) -> np.ndarray:
    """Which members of runs, that begin where ``new``, are not alone in theirs."""
    return ~(new & np.append(new[1:], True))


def suffix_tree(values: np.ndarray, first: np.ndarray) -> Tree:
    """The tree of the sequences that begin at ``first`` (one more entry than sequences).

    Suffixes end with their sequence; an end sorts before any token, equal suffixes by place. A level orders tied
    suffixes by what follows their first 2^k tokens, whose rank is known; leaves, which are tied with none, keep their
    rank and leave the work. Levels are kept until neighbours are held against each other, longest steps first.
    """
    n = len(values)
    if not n:
        return Tree(np.zeros(0, np.int64), np.zeros(0, np.int64))
    end = np.repeat(first[1:], np.diff(first))
    longest = int(np.diff(first).max())
    order = np.argsort(values, kind="stable")
    new = np.append(True, values[order][1:] != values[order][:-1])
    rank = np.empty(n, np.int32)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1
    levels = [rank]
    live = np.flatnonzero(_tied(new))
    depth = 1
    while depth < longest and len(live):
        places = order[live]
        ahead = places + depth
        # 0 stands for the end of a sequence.
        follows = np.where(ahead < end[places], rank[np.minimum(ahead, n - 1)], 0)
        pair = rank[places].astype(np.int64) * (n + 1) + follows
        sort = np.argsort(pair, kind="stable")
        places, pair = places[sort], pair[sort]
        order[live] = places
        new = np.append(True, pair[1:] != pair[:-1])
        rank = rank.copy()
        rank[places] = live[np.flatnonzero(new)][np.cumsum(new) - 1] + 1
        levels.append(rank)
        live = live[_tied(new)]
        depth *= 2
    common = np.zeros(n, np.int64)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[near - 1], order[near]
    left = np.minimum(end[a] - a, end[b] - b)
    shared = np.zeros(len(near), np.int64)
    for k in reversed(range(len(levels))):
        x, y = np.minimum(a + shared, n - 1), np.minimum(b + shared, n - 1)
        shared += (1 << k) * ((shared < left) & (levels[k][x] == levels[k][y]))
    common[near] = np.minimum(shared, left)
    return Tree(order, common)


def tops(tree: Tree, depth: int) -> np.ndarray:
    """For each place the number, in tree order, of the subtree of at least ``depth`` tokens that holds it.

    A suffix of fewer tokens has a number too, which is its own.
    """
    node = np.empty(len(tree.order), np.int64)
    node[tree.order] = np.cumsum(tree.common < depth) - 1
    return node


def internal_nodes(tree: Tree, least: int) -> list[tuple[int, int, int]]:
    """(depth, first, end) of every internal node at least ``least`` deep, as runs of the order; children come first.

    A stack holds the open nodes on the way down to the current leaf; a neighbour that shares less closes the deeper
    ones. Leaves below shallow nodes are never visited.
    """
    found = []
    deep = np.flatnonzero(tree.common >= least)
    starts = np.append(True, deep[1:] != deep[:-1] + 1) if len(deep) else np.zeros(0, bool)
    cuts = np.append(np.flatnonzero(starts), len(deep))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        at = int(deep[a]) - 1
        shared = tree.common[deep[a:b]].tolist()
        stack: list[tuple[int, int]] = []
        for i, depth in enumerate([*shared, 0]):
            begin = at + i
            while stack and stack[-1][0] > depth:
                open_depth, begin = stack.pop()
                found.append((open_depth, begin, at + i + 1))
            if depth and (not stack or stack[-1][0] < depth):
                stack.append((depth, begin))
    return found


def maximal_repeats(tree: Tree, values: np.ndarray, first: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The internal nodes that no token in front extends: their places have different tokens before them, or one of
    them begins its sequence. Nodes never extend to the right, since their children differ there."""
    begins = np.zeros(len(values) + 1, bool)
    begins[first] = True
    places = tree.order
    before = values[np.maximum(places - 1, 0)] if len(values) else values
    # How many neighbours in the order differ in what comes before, so that any run is judged by one subtraction.
    differs = np.zeros(len(places), np.int64)
    differs[1:] = (before[1:] != before[:-1]) | begins[places[1:]] | begins[places[:-1]]
    running = np.cumsum(differs)
    return [x for x in internal_nodes(tree, least) if running[x[2] - 1] > running[x[1]]]
