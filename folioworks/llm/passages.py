"""Substring dedup by prefix-partitioned suffix trees over words.

Suffixes are dealt into groups by prefixes of variable length: the anchor that a window holds, and whole windows where
one anchor has more suffixes than fit in memory (see :mod:`anchors`). For each group the suffix tree is built, as the
order of the suffixes and the prefixes that neighbours share (see :mod:`trees`). Its deep internal nodes, those of at
least a window, hold the places of one repeated word sequence; what they cover of a document are its repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioworks.llm.anchors import NULL_ID, Plan, covered, given, repeated, with_spans
from folioworks.llm.common import for_workers
from folioworks.llm.tokens import pieces, word_hashes, words
from folioworks.llm.trees import suffix_tree, tops


@dataclass(frozen=True)
class Passage:
    """Windows of ``words`` words; anchors have ``anchor`` words and at most ``most`` bodies in a shard."""

    words: int = 50
    anchor: int = 8
    most: int = 20_000


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = words(raw, offsets)
    return word_hashes(raw, starts, ends, lower=False), first


def deep_nodes(depth: int, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The subtree of at least ``depth`` tokens, in the suffix tree of a sequence of bodies, that holds each place; -1
    where the body ends before."""
    end = np.repeat(first[1:], np.diff(first))
    return np.where(np.arange(len(values)) + depth <= end, tops(suffix_tree(values, first), depth), -1)


def passage_report(docs: DataFrame, rule: Passage = Passage(), id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, n_spans, kept_sha256.

    A word is removed if a window of ``rule.words`` consecutive words covers it whose word sequence also starts in a
    document with a smaller id. Words are compared unchanged; windows are judged on the input and may overlap. The
    digest is of the kept words joined by one space. Null and empty texts have no words. A null id is the smallest;
    rows of one id are not earlier than each other. An empty table gives no rows, other columns are not read.
    """
    return _judged(docs, rule, id_column, text_column).drop("removed")


def repeated_passages(docs: DataFrame, rule: Passage = Passage(), id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """One row per longest stretch of words that :func:`passage_report` removes: doc_id, start, size, in words from 0.

    Documents without any have no row.
    """
    return _judged(docs, rule, id_column, text_column).select("doc_id", F.inline("removed"))


def _judged(docs: DataFrame, rule: Passage, id_column: str, text_column: str) -> DataFrame:
    texts = given(docs, id_column, text_column)
    for_workers(docs.sparkSession)
    plan = Plan(rule.words, rule.anchor, True, _words, partial(deep_nodes, rule.words), np.uint64,
                most=rule.most)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.schema.get_field_index("spans"))
            for lo, hi, raw, offsets in pieces(batch, "text"):
                starts, ends, first = words(raw, offsets)
                gone, runs = covered(spans, lo, hi, first, len(starts))
                removed = np.concatenate(([0], np.cumsum(gone)))
                lead, size = stretches(gone, first)
                bounds = np.concatenate(([0], np.cumsum(runs))).astype(np.int32)
                start = lead - first[np.repeat(np.arange(hi - lo), runs)]
                digests = []
                data = raw.tobytes()
                for d in range(hi - lo):
                    a, b = first[d], first[d + 1]
                    if removed[b] > removed[a]:
                        stay = np.flatnonzero(~gone[a:b]) + a
                        text = b" ".join([data[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)])
                    else:
                        # The white space that counts here is what bytes.split() takes.
                        text = b" ".join(data[offsets[d] : offsets[d + 1]].split())
                    digests.append(hashlib.sha256(text).hexdigest())
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first)), pa.array(removed[first[1:]] - removed[first[:-1]]),
                     pa.array(runs), pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(pa.array(bounds), pa.StructArray.from_arrays(
                         [pa.array(start), pa.array(size)], ["start", "size"]))],
                    ["doc", "n_words", "n_removed", "n_spans", "kept_sha256", "removed"])

    report = with_spans(texts, repeated(texts, plan)).mapInArrow(
        kept, "doc bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
              "removed array<struct<start:bigint,size:bigint>>")
    return named(report)


def stretches(gone: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the maximal stretches of what is gone, which end with their document."""
    at = np.flatnonzero(gone)
    border = np.zeros(len(gone) + 1, bool)
    border[first] = True
    begins = np.append(True, at[1:] != at[:-1] + 1)[: len(at)] | border[at]
    lead = at[begins]
    return lead, np.diff(np.append(np.flatnonzero(begins), len(at)))


def named(report: DataFrame) -> DataFrame:
    """The report with its ids as they were given."""
    doc_id = F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id")
    return report.select(doc_id, *(c for c in report.columns if c != "doc"))
