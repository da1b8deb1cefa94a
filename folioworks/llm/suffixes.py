"""Suffix-array dedup of bytes by external induced sorting.

Suffixes are sorted as in induced sorting: those that start a descent after a rise (the seeds) are sorted first, then
one pass up through the first bytes puts the descending suffixes in order and one pass down the ascending ones, each
from the order of the suffix one byte further on. In the passes every first byte has a queue. A queue is filled in the
order in which it is emptied, so it is a priority queue that needs no comparisons; it carries (place, common prefix
with the tuple before) and writes what exceeds its share of memory to disk. Common prefixes are carried along: that of
two tuples is one more than the smallest between the suffixes that pushed them.

Seeds are themselves sorted by the same means one level down: their substrings are named in order, and the sequence
of names is sorted recursively by pairs of names, which doubles the length they stand for.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folioworks.llm.anchors import Plan, covered, given, repeated, with_spans
from folioworks.llm.common import for_workers
from folioworks.llm.passages import named
from folioworks.llm.tokens import Runs, byte_values, pieces

FAR = np.int32(1 << 30)


@dataclass(frozen=True)
class Strings:
    """Strings of ``bytes`` bytes; anchors have ``anchor`` bytes and at most ``most`` bodies in a shard."""

    bytes: int = 100
    anchor: int = 24
    most: int = 60_000


class Queue:
    """Tuples (place, common prefix) in the order in which they were pushed; blocks beyond ``memory`` bytes go to disk.

    The file has no name, so nothing is left behind, whatever ends the task.
    """

    def __init__(self, memory: int) -> None:
        self.memory = memory
        self.blocks: list[tuple[np.ndarray, np.ndarray] | tuple[int, int]] = []
        self.held = 0
        self.file = None

    def push(self, place: np.ndarray, common: np.ndarray) -> None:
        size = place.nbytes + common.nbytes
        if self.held + size > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, 2)
            self.blocks.append((self.file.tell(), len(place)))
            self.file.write(np.ascontiguousarray(place, np.int64).data)
            self.file.write(np.ascontiguousarray(common, np.int32).data)
        else:
            self.blocks.append((place, common))
            self.held += size

    def _block(self, block: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(block[0], np.ndarray):
            return block
        at, n = block
        self.file.seek(at)
        return np.frombuffer(self.file.read(8 * n), np.int64), np.frombuffer(self.file.read(4 * n), np.int32)

    def pop(self, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples in order, also those pushed meanwhile; they are forgotten as they are read.

        Blocks that wait are handed out together, up to about ``most`` tuples at once.
        """
        while self.blocks:
            together, n = [], 0
            for block in self.blocks:
                together.append(self._block(block))
                n += len(together[-1][0])
                if isinstance(block[0], np.ndarray):
                    self.held -= block[0].nbytes + block[1].nbytes
                if n >= most:
                    break
            del self.blocks[: len(together)]
            places, common = zip(*together, strict=True)
            yield np.concatenate(places), np.concatenate(common)

    def blocks_back(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All blocks from the last to the first; they stay."""
        for block in reversed(self.blocks):
            yield self._block(block)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Pass:
    """The queues of one pass: pushes keep, for each first byte, the smallest common prefix since its last push."""

    def __init__(self, symbols: int, memory: int) -> None:
        self.queues = [Queue(memory) for _ in range(symbols)]
        self.low = np.full(symbols, FAR, np.int32)

    def extracted(self, common: np.ndarray, place: np.ndarray, to: np.ndarray) -> None:
        """After suffixes with these common prefixes came up in order: push ``place`` to queue ``to``; -1 pushes none."""
        if not len(common):
            return
        for symbol in np.unique(to).tolist():
            if symbol < 0:
                continue
            at = np.flatnonzero(to == symbol)
            least = np.minimum.reduceat(common[: at[-1] + 1], np.concatenate(([0], at[:-1] + 1)))
            least[0] = min(least[0], self.low[symbol])
            self.queues[symbol].push(place[at], (least + 1).astype(np.int32))
            self.low[symbol] = FAR
            if at[-1] + 1 < len(common):
                self.low[symbol] = common[at[-1] + 1 :].min()
        pushed = np.zeros(len(self.low), bool)
        pushed[np.unique(to[to >= 0])] = True
        np.minimum(self.low, common.min(), out=self.low, where=~pushed)


def _rising(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that starts one place on; the last is, since it is the smallest."""
    n = len(text)
    differs = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    up = np.append(text[1:] > text[:-1], True)
    lengths = np.diff(np.concatenate(([-1], differs)))
    return np.repeat(up[differs], lengths)


def _seed_order(text: np.ndarray, seeds: np.ndarray, depth: int) -> np.ndarray:
    """Seeds sorted by at least their first ``depth`` bytes.

    Their substrings, up to the next seed, are named in order six symbols at a time; then names are paired.
    """
    m = len(seeds)
    length = np.diff(np.append(seeds, len(text)))
    padded = np.append(text, np.zeros(8, text.dtype)).astype(np.uint64)
    name = np.zeros(m, np.int64)
    done = 0
    live = np.arange(m)
    # A substring runs to the first symbol of the next seed. One that is the beginning of another is the larger one:
    # its last symbol starts a rise, where the other still falls. So what is missing counts as the largest symbol.
    while len(live):
        word = np.zeros(len(live), np.uint64)
        for k in range(6):
            at = seeds[live] + done + k
            inside = done + k <= length[live]
            word = word * np.uint64(512) + np.where(inside, padded[np.minimum(at, len(padded) - 1)], np.uint64(511))
        order = np.argsort(word) if not done else np.lexsort((word, name[live]))
        same_name = name[live][order]
        new = np.ones(len(live), bool)
        new[1:] = (same_name[1:] != same_name[:-1]) | (word[order][1:] != word[order][:-1])
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        first = np.flatnonzero(new)
        # Names are ranks: those of the old name, plus how many of it are smaller.
        begin = np.flatnonzero(np.append(True, same_name[1:] != same_name[:-1]))
        base = begin[np.searchsorted(begin, first, "right") - 1]
        name[live[order]] = same_name + (first - base)[group]
        done += 6
        keep = (size[group] > 1) & (length[live[order]] + 1 >= done)
        live = live[order][keep]
    step = 1
    covers = length.copy()
    while step < m:
        pair = (name << 32) + np.append(name[step:] + 1, np.zeros(step, np.int64))
        order = np.argsort(pair)
        new = np.ones(m, bool)
        new[1:] = pair[order][1:] != pair[order][:-1]
        ranked = np.empty(m, np.int64)
        ranked[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        name = ranked
        covers = covers + np.append(covers[step:], np.full(step, depth))
        step *= 2
        sizes = np.bincount(name, minlength=m)
        tied = (sizes[name] > 1) & (covers < depth)
        if not tied.any():
            break
    return np.argsort(name, kind="stable")


def _common(runs: Runs, a: np.ndarray, b: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes up to ``depth``, by bisection over hashes of runs."""
    low = np.zeros(len(a), np.int64)
    high = np.minimum(depth, n - np.maximum(a, b))
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = runs.of(a, a + middle) == runs.of(b, b + middle)
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)
    return low.astype(np.int32)


def induced(text: np.ndarray, depth: int, memory: int = 1 << 26) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of ``text`` (symbols from 1, ending in the only 0) from the largest down, in blocks: (places, common
    prefix with the suffix before). Order and prefixes hold up to ``depth`` symbols; prefixes may be cut off there.

    ``memory`` bounds the bytes of tuples held by the queues of a pass.
    """
    n = len(text)
    symbols = int(text.max()) + 1
    rising = _rising(text)
    seeds = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    # Seeds only order suffixes that reach them within the depth.
    seeds = seeds[_seed_order(text, seeds, depth + 1)] if len(seeds) else seeds
    runs = Runs(byte_values(text.astype(np.uint8)) + text.astype(np.uint64), 5)
    seed_common = np.zeros(len(seeds), np.int32)
    if len(seeds) > 1:
        seed_common[1:] = _common(runs, seeds[:-1], seeds[1:], n, depth)
    first = text[seeds]
    bound = np.searchsorted(first, np.arange(symbols + 1))
    share = max(1 << 16, memory // (2 * symbols))
    up, down, falling = Pass(symbols, share), Pass(symbols, share), [Queue(share) for _ in range(symbols)]

    def preceding(place: np.ndarray, symbol: int, rise: bool) -> tuple[np.ndarray, np.ndarray]:
        before = np.maximum(place - 1, 0)
        to = text[before].astype(np.int64)
        good = (place > 0) & (to <= symbol if rise else to >= symbol)
        return before, np.where(good, to, -1)

    for c in range(symbols):
        queue, last = up.queues[c], None
        start = True
        for place, common in queue.pop():
            if start:
                # The first of a bucket shares nothing with the last of the one before.
                common = common.copy()
                common[0] = 0
                start = False
            falling[c].push(place, common)
            up.extracted(common, *preceding(place, c, rise=False))
            last = place[-1]
        place, common = seeds[bound[c] : bound[c + 1]], seed_common[bound[c] : bound[c + 1]].copy()
        if len(place):
            common[0] = 0 if last is None else _common(runs, np.array([last]), place[:1], n, depth)[0]
            before = place - 1
            up.extracted(common, before, np.where(before >= 0, text[before], -1).astype(np.int64))
        queue.close()
    # The last suffix, the lone 0, rises and starts the way down by itself.
    for c in range(symbols - 1, -1, -1):
        queue, start, last = down.queues[c], True, None
        if c == 0:
            queue.push(np.array([n - 1]), np.zeros(1, np.int32))
        for place, common in queue.pop():
            if start:
                common = common.copy()
                common[0] = 0
                start = False
            yield place, common
            down.extracted(common, *preceding(place, c, rise=True))
            last = place[-1]
        carried = None
        for place, common in falling[c].blocks_back():
            # From the largest down, the prefix shared with the one before is the next one's on the way up.
            place = place[::-1]
            if last is None:
                head = 0
            elif carried is None:
                head = int(_common(runs, np.array([last]), place[:1], n, depth)[0])
            else:
                head = carried
            shared = np.concatenate(([head], common[::-1][:-1])).astype(np.int32)
            carried, last = int(common[0]), place[-1]
            yield place, shared
            before = np.maximum(place - 1, 0)
            to = text[before].astype(np.int64)
            down.extracted(shared, before, np.where((place > 0) & (to < c), to, -1))
        falling[c].close()
        queue.close()


def equal_windows(length: int, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for each place of a sequence of bodies, equal for equal strings of ``length`` bytes; -1 where the body
    ends before: intervals of the suffix array whose common prefix is at least ``length``."""
    sizes = np.diff(first)
    text = np.zeros(len(values) + len(sizes) + 1, np.int16)
    at = np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes)
    text[at] = values.astype(np.int16) + 2
    text[first[1:] + np.arange(len(sizes))] = 1
    names = np.empty(len(text), np.int64)
    interval = 0
    for place, common in induced(text, length):
        part = interval + np.cumsum(common < length)
        names[place] = part
        interval = int(part[-1])
    out = names[at]
    end = np.repeat(first[1:], sizes)
    out[np.arange(len(values)) + length > end] = -1
    return out


def _bytes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return byte_values(raw), offsets


def string_report(docs: DataFrame, rule: Strings = Strings(), id_column: str = "doc_id",
                  text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte of the UTF-8 text is removed if a string of ``rule.bytes`` bytes covers it that also starts earlier, in a
    document with a smaller id or further up in the same one; strings are judged on the input and may overlap. The
    digest is of the bytes that stay. Null and empty texts have no bytes. A null id is the smallest; places with equal
    id and start are one place, whatever rows they stand in. An empty table gives no rows, other columns are not read.
    """
    for_workers(docs.sparkSession)
    texts = given(docs, id_column, text_column)
    plan = Plan(rule.bytes, rule.anchor, False, _bytes, partial(equal_windows, rule.bytes), np.uint8, shard=1 << 22,
                most=rule.most)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index("spans"))
            for lo, hi, raw, offsets in pieces(batch, "text"):
                gone, runs = covered(spans, lo, hi, offsets, len(raw))
                removed = np.concatenate(([0], np.cumsum(gone)))
                stay = raw[~gone].tobytes()
                left = offsets - removed[offsets]
                digests = [hashlib.sha256(stay[a:b]).hexdigest()
                           for a, b in zip(left[:-1].tolist(), left[1:].tolist(), strict=True)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets)),
                     pa.array(removed[offsets[1:]] - removed[offsets[:-1]]), pa.array(runs),
                     pa.array(digests, pa.string())],
                    ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return named(with_spans(texts, repeated(texts, plan)).mapInArrow(
        kept, "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"))
