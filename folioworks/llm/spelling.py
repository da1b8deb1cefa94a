"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits.

Every word generates its edits, but only those half of them by which each pair is met once: deletions, and replacements
by a character that comes earlier. Words of one length have a filter of their own, cut into blocks; blocks are
broadcast, as many at a time as a fixed number of bytes allows, and an edit is looked up in the filter of its length.
Only edits that are found are shuffled, to an exact join with the vocabulary that clears what the filter wrongly let
through. Hashes of edits follow from the hash of the word by one addition each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from folioworks.llm.bloom import BLOCK_BYTES, block_of, collected, holds, marked
from folioworks.llm.common import for_workers, partitions, staged
from folioworks.llm.tokens import within

RUN = r"[A-Za-zÀ-ÿ]+"
# Runs are made of these characters once A-Z are lower-cased, in order.
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint8)
_VALUES = np.random.default_rng(1957).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Spelling:
    """Words have ``length`` characters and occur ``least`` times at least; a form occurs ``ratio`` times as often as
    the word. Filters take ``bits`` bits a word; ``filter_bytes`` of them are broadcast at a time."""

    length: int = 5
    least: int = 3
    ratio: int = 2
    bits: int = 16
    filter_bytes: int = 1 << 24
    chunk: int = 1 << 16
    damage: int | None = 97


def _chunks(text: Column, size: int) -> Column:
    """A long text in pieces that end with a run; nothing is lost but what stands between runs."""
    cut = F.regexp_extract_all(text, F.lit(r"(?s).{0,%d}%s+" % (size, RUN[:-1])), F.lit(0))
    return F.when(F.length(text) > size, cut).otherwise(F.array(text))


def vocabulary(docs: DataFrame, how: Spelling = Spelling(), id_column: str = "doc_id",
               text_column: str = "text") -> DataFrame:
    """(word, n): the words of all texts that are long and frequent enough.

    A run of letters is lower-cased in A-Z only. If ``how.damage`` divides the CRC-32 of ``<id>:<run>``, the run loses
    the character at that number modulo its length; a null id is written as nothing. Counts are aggregated before they
    are shuffled.
    """
    text = F.translate(F.col(text_column), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = (
        docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), text.alias("text"))
        .select("id", F.explode(_chunks(F.col("text"), how.chunk)).alias("chunk"))
        .select("id", F.explode(F.regexp_extract_all("chunk", F.lit(RUN), F.lit(0))).alias("run"))
    )
    word = F.col("run")
    if how.damage:
        runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(
            F.col("h") % how.damage == 0,
            F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))),
        ).otherwise(word)
    return (
        runs.select(word.alias("word")).filter(F.length("word") >= how.length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= how.least)
    )


def _powers(n: int) -> np.ndarray:
    p = np.full(n + 1, _BASE, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, characters) of all words of one length, a character in a byte."""
    texts = [w.encode("latin-1") for w in words.to_pylist()]
    sizes = np.array([len(t) for t in texts], np.int64)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        data = np.frombuffer(b"".join([texts[r] for r in rows]), np.uint8)
        yield rows, data.reshape(len(rows), int(size))


def _gathered(batches: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Batches of at least ``least`` rows, but for the last."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= least:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if any(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _hashes(letters: np.ndarray) -> np.ndarray:
    return (_VALUES[letters] * _powers(letters.shape[1])[:-1]).sum(1, dtype=np.uint64)


def _edits(letters: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(place, word, character, hash) of the edits of words of one length, first the deletions, with -1 as character,
    then the replacements, a place at a time."""
    size = letters.shape[1]
    powers = _powers(size)
    values = _VALUES[letters]
    terms = values * powers[:-1]
    whole = terms.sum(1, dtype=np.uint64)
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    # What stands behind a place, moved one place to the front.
    moved = np.zeros((len(letters), size + 1), np.uint64)
    moved[:, 1:-1] = values[:, 1:] * powers[:-2]
    behind = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1][:, 1:]
    earlier = np.searchsorted(ALPHABET, letters)
    for place in range(size):
        # Of equal characters side by side only the first is deleted: the others give the same word.
        rows = np.arange(len(letters)) if place == 0 else np.flatnonzero(letters[:, place] != letters[:, place - 1])
        yield place, rows, np.full(len(rows), -1), before[rows, place] + behind[rows, place]
    for place in range(size):
        rows, letter = within(np.zeros(len(letters), np.int64), earlier[:, place])
        letter = ALPHABET[letter].astype(np.int64)
        yield place, rows, letter, (whole - terms[:, place])[rows] + _VALUES[letter] * powers[place]


def _probed(words: DataFrame, starts: dict[int, tuple[int, int]], bits: Broadcast, first: int, blocks: int) -> DataFrame:
    """(word, n, other): edits of ``words`` that the broadcast blocks may hold. ``starts`` has the filter of each
    length: its first block and the number of its blocks."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            names, counts = table.column(0), table.column(1)
            for rows, letters in _by_length(names):
                size = letters.shape[1]
                for place, row, letter, hashes in _edits(letters):
                    base, count = starts.get(size - int(len(letter) > 0 and letter[0] < 0), (0, 0))
                    if not count or base >= first + blocks or base + count <= first:
                        continue
                    block = base + block_of(hashes, count) - first
                    here = np.flatnonzero((block >= 0) & (block < blocks))
                    here = here[holds(bits.value, block[here], hashes[here])]
                    if not len(here):
                        continue
                    other = []
                    for r, c in zip(row[here].tolist(), letter[here].tolist(), strict=True):
                        word = letters[r].tobytes()
                        other.append((word[:place] + (bytes([c]) if c >= 0 else b"") + word[place + 1:]).decode("latin-1"))
                    at = pa.array(rows[row[here]])
                    yield pa.RecordBatch.from_arrays(
                        [names.take(at), counts.take(at), pa.array(other, pa.string())], ["word", "n", "other"])

    return words.select("word", "n").mapInArrow(probe, "word string, n bigint, other string")


def near_words(words: DataFrame, how: Spelling = Spelling()) -> DataFrame:
    """(word, n, other, other_n) for all ordered pairs of words one insertion, deletion or replacement apart.

    ``words`` are (word, n), each word once, of the characters of ``ALPHABET``. Each round of probes takes at most
    ``how.filter_bytes`` of filters; there are more rounds for more words, never fuller filters.
    """
    spark = for_workers(words.sparkSession)
    sizes = words.groupBy(F.length("word").alias("size")).count().orderBy("size").collect()
    starts, total = {}, 0
    for size, count in sizes:
        blocks = -(-count * how.bits // (8 * BLOCK_BYTES))
        starts[size] = (total, blocks)
        total += blocks

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _by_length(batch.column(0)):
                base, count = starts[letters.shape[1]]
                hashes = _hashes(letters)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + block_of(hashes, count)), pa.array(hashes.view(np.int64))], ["block", "hash"])

    filters = staged(marked(words.select("word").mapInArrow(placed, "block bigint, hash bigint")))
    dealt = words.repartition(partitions(spark), "word")
    found = words.select("word", "n", F.col("word").alias("other")).limit(0)
    step = max(1, how.filter_bytes // BLOCK_BYTES)
    for first in range(0, total, step):
        blocks = min(step, total - first)
        bits = spark.sparkContext.broadcast(collected(filters, first, blocks))
        found = found.union(staged(_probed(dealt, starts, bits, first, blocks)))
        bits.unpersist()
    pairs = staged(found.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
                   .select("word", "n", "other", "other_n"))
    return pairs.union(pairs.select("other", "other_n", "word", "n"))


def spelling_variants(docs: DataFrame, how: Spelling = Spelling(), id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of the vocabulary of ``docs``.

    The form of a word is its near word that occurs most (of equals the smallest by code points), if that is at least
    ``how.ratio`` times as often as the word; the root is where following forms ends, the word itself without a form.
    Forms occur more often step by step, so there are no circles; roots are found by doubling the steps. Null and
    empty texts have no words, a null id counts as an empty one, repeated rows count each, an empty table gives no
    rows, other columns are not read.
    """
    words = staged(vocabulary(docs, how, id_column, text_column))
    best = (
        near_words(words, how).groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("top"))
        .select("word", "n_near", F.col("top.other").alias("other"), (-F.col("top.less")).alias("other_n"))
    )
    often = F.col("other_n") >= F.col("n") * how.ratio
    formed = staged(
        words.join(best, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                F.when(often, F.col("other")).alias("form"), F.when(often, F.col("other_n")).alias("form_n"))
    )
    steps = staged(formed.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = staged(
            steps.join(ahead, "root", "left")
            .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if steps.filter("moved").isEmpty():
            break
        steps = steps.drop("moved")
    return (
        formed.join(steps.select("word", "root"), "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    )
