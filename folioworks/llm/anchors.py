"""Repeated runs of tokens across a corpus, found from a sparse, content-defined choice of suffixes.

The question is which windows of ``length`` tokens occur earlier. Suffixes of all places would be far too many, so only
anchors are kept: the anchor of a window is its run of ``gram`` tokens with the smallest hash, the leftmost of equals.
Equal windows have equal anchors in the same place, so the choice loses nothing. Neighbouring windows mostly share
their anchor; the stretch of text they cover together is a body. Bodies go through three steps:

1. Bodies are sorted by anchor and content, first within a piece of the input, then in the corpus. A body whose whole content occurs earlier is repeated as a whole. An anchor
   with a single content needs no more; what is left are the first bodies of anchors with several contents.
2. Those bodies are cut out of the texts, dealt by anchor, and their suffixes are sorted in memory-sized shards by the
   operator that asks; windows with a common prefix of ``length`` tokens are one node, which knows its earliest place.
3. An anchor with more bodies than fit a shard is split by longer prefixes instead, namely the whole windows: these are
   aggregated to their earliest place before they are shuffled.

Places are (document, start). Rows of one id are told apart by a 64-bit hash of the text, their tag; rows alike in both
are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioworks.llm.common import for_workers, partitions, staged
from folioworks.llm.tokens import Runs, mix, pieces, within

NULL_ID = -(1 << 63)


@dataclass(frozen=True)
class Plan:
    """``tokens`` turns texts into values and the place where each document's begin; ``names`` gives every place of a
    sequence of bodies a number that is equal for equal windows (-1 where none fits). ``by_document``: only smaller
    documents count as earlier, not earlier places of the same one."""

    length: int
    gram: int
    by_document: bool
    tokens: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    names: Callable[[np.ndarray, np.ndarray], np.ndarray]
    dtype: type
    most: int  # bodies of one anchor that may share a shard
    shard: int = 1 << 22  # tokens of the bodies that are sorted together


def bodies(values: np.ndarray, first: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, start, windows, anchor's offset, anchor's hash, content's hash) of each body."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    n = len(values)
    if n < length:
        return none
    grams = Runs(values, 2)
    at = np.arange(n - gram + 1)
    hashes = grams.of(at, at + gram)
    # The place in the low bits makes the leftmost of equal hashes the smallest.
    bits = np.uint64(max(1, int(n).bit_length()))
    keyed = (mix(hashes) >> bits << bits) | at.astype(np.uint64)
    width = length - gram + 1
    rows = -(-len(keyed) // width) + 1
    padded = np.full(rows * width, np.iinfo(np.uint64).max)
    padded[: len(keyed)] = keyed
    table = padded.reshape(rows, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = np.maximum(0, np.diff(first) - length + 1)
    doc, start = within(first[:-1], count)
    if not len(start):
        return none
    anchor = (np.minimum(after[start], before[start + width - 1]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    lead = np.flatnonzero(new)
    windows = np.diff(np.append(lead, len(start)))
    doc, start, anchor = doc[lead], start[lead], anchor[lead]
    content = grams.of(start, start + windows + length - 1)
    return doc, start - first[doc], windows, anchor - start, hashes[anchor], content


def _seen_before(gram: np.ndarray, content: np.ndarray, doc: np.ndarray, start: np.ndarray,
                 by_document: bool) -> np.ndarray:
    """Which bodies of a piece of the input have their whole content earlier in the same piece.

    This takes most of a very common or periodic text out of the groups of its anchors before they are shuffled.
    """
    again = np.zeros(len(gram), bool)
    order = np.lexsort((start, doc, content, gram))
    new = np.ones(len(order), bool)
    new[1:] = (gram[order][1:] != gram[order][:-1]) | (content[order][1:] != content[order][:-1])
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else order
    later = doc[order] > doc[lead]
    if not by_document:
        later |= (doc[order] == doc[lead]) & (start[order] > start[lead])
    again[order] = later
    return again


def packed(start: np.ndarray, windows: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """A place in one number that sorts by start."""
    return (start << 14) | (windows << 7) | offset


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, windows) of a place."""
    return place >> 14, (place >> 7) & 127


def _groups(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Tables of about ``least`` rows or more that never part rows of one key; batches come sorted by it."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        keep = int(np.searchsorted(keys, keys[-1], "left"))
        if keep:
            yield table.slice(0, keep)
            rest = table.slice(keep)
            held, rows = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def given(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc, tag, text) with no nulls; a null id is the smallest."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(NULL_ID)).alias("doc"),
        F.xxhash64(text).alias("tag"),
        text.alias("text"))


def repeated(texts: DataFrame, plan: Plan) -> DataFrame:
    """(doc, tag, spans) from (doc, tag, text): the stretches of tokens covered by windows that occur earlier, as
    array<struct<start, size>>, in no order and overlapping; documents without any are left out."""
    spark = for_workers(texts.sparkSession)
    width = plan.length - plan.gram + 1
    assert 1 <= width < 128

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, _, raw, offsets in pieces(batch, "text", 1 << 19):
                values, first = plan.tokens(raw, offsets)
                doc, start, windows, offset, gram, content = bodies(values, first, plan.length, plan.gram)
                who = ids[lo + doc]
                again = _seen_before(gram, content, who, start, plan.by_document)
                # What is settled here keeps its way through the shuffle, but under names of its own.
                gram = np.where(again, mix(content + start.astype(np.uint64)), gram)
                yield _batch(["gram", "content", "doc", "tag", "place", "whole"], gram.view(np.int64),
                             content.view(np.int64), who, tags[lo + doc], packed(start, windows, offset), again)

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of an anchor that goes on in the next batch only this is kept: its content, the earliest place of that, and
        # the rows that are open should another content follow.
        gram_, content_, doc_, start_, contents_ = 0, 0, 0, 0, 0
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, content, doc, tag, place, known_again = (
                np.asarray(batch.column(batch.schema.get_field_index(c)))
                for c in ("gram", "content", "doc", "tag", "place", "whole"))
            start, _ = unpacked(place)
            goes_on = contents_ > 0 and gram[0] == gram_
            new_gram = np.ones(len(gram), bool)
            new_gram[1:] = gram[1:] != gram[:-1]
            new = new_gram.copy()
            new[1:] |= content[1:] != content[:-1]
            lead = np.flatnonzero(new)
            of = np.cumsum(new) - 1
            first_doc, first_start = doc[lead], start[lead]
            fresh = new.astype(np.int64)
            if goes_on and content[0] == content_:
                first_doc[0], first_start[0], fresh[0] = doc_, start_, 0
            again = (doc > first_doc[of]) | known_again
            if not plan.by_document:
                again |= (doc == first_doc[of]) & (start > first_start[of])
            segment = np.cumsum(new_gram) - 1
            contents = np.add.reduceat(fresh, np.flatnonzero(new_gram))
            if goes_on:
                contents[0] += contents_
            open_ = (contents > 1)[segment] & ~again
            keep = again | open_
            yield _batch(["gram", "doc", "tag", "place", "whole"], np.where(again, 0, gram)[keep], doc[keep], tag[keep],
                         place[keep], again[keep])
            if goes_on and waiting and contents[0] > 1:
                who, tags, where = (np.concatenate(x) for x in zip(*waiting, strict=True))
                yield _batch(["gram", "doc", "tag", "place", "whole"], np.full(len(who), gram_), who, tags, where,
                             np.zeros(len(who), bool))
                waiting = []
            if not goes_on or len(contents) > 1 or contents[0] > 1:
                waiting = []
            if contents[-1] == 1:
                tail = (segment == segment[-1]) & ~again
                waiting.append((doc[tail], tag[tail], place[tail]))
            gram_, content_, contents_ = gram[-1], content[-1], int(contents[-1])
            doc_, start_ = first_doc[-1], first_start[-1]

    sorting = ["gram", "content", "doc", "place"]
    known = staged(
        texts.mapInArrow(anchored, "gram bigint, content bigint, doc bigint, tag bigint, place bigint, whole boolean")
        .repartition(partitions(spark), "gram").sortWithinPartitions(*sorting)
        .mapInArrow(settled, "gram bigint, doc bigint, tag bigint, place bigint, whole boolean")
    )
    lo = F.shiftright("place", 14)
    n = F.shiftright("place", 7).bitwiseAND(F.lit(127).cast("bigint"))
    span = F.struct(lo.alias("start"), (n + plan.length - 1).alias("size"))
    whole = known.filter("whole").select("doc", "tag", span.alias("span"))
    asked = known.filter("not whole").select("gram", "doc", "tag", "place")
    crowded = staged(asked.groupBy("gram").count().filter(F.col("count") > plan.most).select("gram"))
    has_crowds = not crowded.isEmpty()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies_ = batch.column(batch.schema.get_field_index("bodies"))
            where = np.asarray(bodies_.offsets)
            flat = bodies_.flatten()
            gram, place, apart = (np.asarray(flat.field(c)) for c in range(3))
            docs_, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, end, raw, offsets in pieces(batch, "text"):
                values, first = plan.tokens(raw, offsets)
                a, b = where[row] - where[0], where[end] - where[0]
                of = np.repeat(np.arange(end - row), np.diff(where[row : end + 1]))
                start, windows = unpacked(place[a:b])
                start = start + first[of]
                size = windows + plan.length - 1
                one = ~apart[a:b]
                body, at = within(start[one], size[one])
                item = np.dtype(plan.dtype).itemsize
                data = np.ascontiguousarray(values[at], dtype=np.uint64).astype(plan.dtype) if item == 8 else raw[at]
                bounds = np.concatenate(([0], np.cumsum(size[one] * item))).astype(np.int32)
                split, at = within(start[~one], windows[~one])
                runs = [Runs(values, base).of(at, at + plan.length).view(np.int64) for base in (3, 4)] if len(at) else [at, at]
                rows = int(one.sum()) + len(at)
                none = pa.nulls(len(at), pa.int64())
                binary = pa.Array.from_buffers(
                    pa.binary(), int(one.sum()), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([
                    pa.concat_arrays([pa.array(gram[a:b][one]), none]),
                    pa.array(np.concatenate((docs_[row + of[one]], docs_[row + of[~one][split]]))),
                    pa.array(np.concatenate((tags[row + of[one]], tags[row + of[~one][split]]))),
                    pa.array(np.concatenate((
                        place[a:b][one],
                        packed(at - first[of[~one][split]], np.ones(len(at), np.int64), np.zeros(len(at), np.int64))))),
                    pa.concat_arrays([binary, pa.nulls(len(at), pa.binary())]),
                    pa.concat_arrays([pa.nulls(rows - len(at), pa.int64()), pa.array(runs[0])]),
                    pa.concat_arrays([pa.nulls(rows - len(at), pa.int64()), pa.array(runs[1])]),
                ], ["gram", "doc", "tag", "place", "body", "run_a", "run_b"])

    if has_crowds:
        asked = asked.join(crowded.withColumn("apart", F.lit(True)), "gram", "left")
    else:
        asked = asked.withColumn("apart", F.lit(False))
    asked = asked.withColumn("apart", F.coalesce("apart", F.lit(False)))
    per_document = asked.groupBy("doc", "tag").agg(
        F.collect_set(F.struct("gram", "place", "apart")).alias("bodies"))
    pieces_cut = (
        texts.join(per_document, ["doc", "tag"]).select("doc", "tag", "text", "bodies")
        .mapInArrow(cut, "gram bigint, doc bigint, tag bigint, place bigint, body binary, run_a bigint, run_b bigint")
    )
    if has_crowds:
        pieces_cut = staged(pieces_cut)

    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "gram", max(1, plan.shard // (plan.length + width))):
            doc, tag, place = (table.column(c).to_numpy() for c in ("doc", "tag", "place"))
            body = table.column("body").combine_chunks()
            if isinstance(body, pa.ChunkedArray):
                body = pa.concat_arrays(body.chunks)
            wide = pa.types.is_large_binary(body.type)
            item = np.dtype(plan.dtype).itemsize
            bounds = np.frombuffer(body.buffers()[1], np.int64 if wide else np.int32)[body.offset : body.offset + len(body) + 1]
            values = np.frombuffer(body.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
            values = values if item == 1 else np.frombuffer(values.tobytes(), plan.dtype)
            first = (bounds.astype(np.int64) - bounds[0]) // item
            names = plan.names(values, first)
            start, windows = unpacked(place)
            of, at = within(first[:-1], windows)
            inner = at - first[of]
            name, who, where = names[at], doc[of], start[of] + inner
            order = np.lexsort((where, who, name))
            new = np.ones(len(order), bool)
            new[1:] = name[order][1:] != name[order][:-1]
            lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
            again = np.zeros(len(order), bool)
            later = who[order] > who[lead]
            if not plan.by_document:
                later |= (who[order] == who[lead]) & (where[order] > where[lead])
            again[order] = later
            hit = np.flatnonzero(again)
            if not len(hit):
                continue
            gap = np.ones(len(hit), bool)
            gap[1:] = (hit[1:] != hit[:-1] + 1) | (of[hit][1:] != of[hit][:-1])
            lead = hit[gap]
            runs = np.diff(np.append(np.flatnonzero(gap), len(hit)))
            yield _batch(["doc", "tag", "start", "size"], who[lead], tag[of[lead]], where[lead], runs + plan.length - 1)

    dealt = pieces_cut.filter("body is not null") if has_crowds else pieces_cut
    found = (
        dealt.select("gram", "doc", "tag", "place", "body").repartition(partitions(spark), "gram").sortWithinPartitions("gram")
        .mapInArrow(resolved, "doc bigint, tag bigint, start bigint, size bigint")
        .select("doc", "tag", F.struct("start", "size").alias("span"))
    )
    spans = whole.union(found)
    if has_crowds:
        single = pieces_cut.filter("body is null").select("run_a", "run_b", "doc", "tag", lo.alias("start"))
        earliest = single.groupBy("run_a", "run_b").agg(F.min(F.struct("doc", "start")).alias("e"))
        later = F.col("doc") > F.col("e.doc")
        if not plan.by_document:
            later = later | ((F.col("doc") == F.col("e.doc")) & (F.col("start") > F.col("e.start")))
        spans = spans.union(
            single.join(earliest, ["run_a", "run_b"]).filter(later)
            .select("doc", "tag", F.struct("start", F.lit(plan.length).cast("bigint").alias("size")).alias("span")))
    return spans.groupBy("doc", "tag").agg(F.collect_set("span").alias("spans"))


def covered(spans: pa.Array, row: int, end: int, first: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows of a list column of spans: which of their tokens are covered, and how many maximal runs each row has."""
    where = np.asarray(spans.offsets)
    flat = spans.flatten()
    a, b = where[row] - where[0], where[end] - where[0]
    start, size = (np.asarray(flat.field(c))[a:b] for c in range(2))
    of = np.repeat(np.arange(end - row), np.diff(where[row : end + 1]))
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, first[of] + start, 1)
    np.add.at(change, first[of] + start + size, -1)
    gone = np.cumsum(change)[:-1] > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    cuts = first[1:-1]
    cuts = cuts[cuts < total]
    begins[cuts] = gone[cuts]
    runs = np.concatenate(([0], np.cumsum(begins)))
    return gone, runs[first[1:]] - runs[first[:-1]]


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc, text, spans) with an empty list where there is none."""
    none = F.array().cast("array<struct<start:bigint,size:bigint>>")
    return texts.join(spans, ["doc", "tag"], "left").select("doc", "text", F.coalesce("spans", none).alias("spans"))


