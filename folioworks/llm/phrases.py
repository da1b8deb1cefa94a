"""Phrase collocation mining by partitioning (SON): shards are mined completely, then candidates are counted exactly.

A shard is a few megabytes of text in a task. It counts all its phrases and reports those that reach the global
support lowered in proportion to its share of the words. What a shard may hide is known, the lowered support less one,
so the reports bound the count of every phrase from above; those whose bound reaches the support are the candidates.
What all shards hide together is worked out from their sizes first and held against what they did hide afterwards.
A second reading counts the candidates exactly. The first reading sends hashes only, for an equal hash can but make a
phrase a candidate; the second sends the words and decides. Candidates reach the tasks as a Bloom filter of bounded
size: beyond that size it lets more phrases through, which costs shuffle and no results.

With many shards the lowered support is one: every phrase is reported, and the bound is the count itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from folioworks.llm.bloom import BLOCK_BYTES, block_of, collected, holds, marked
from folioworks.llm.common import for_workers, partitions, staged
from folioworks.llm.tokens import mix, pieces, strong_hashes

UNKNOWN = "und"
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTER = _BREAK.copy()
_OUTER[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SALT = 8  # parts into which the phrases that share a word are dealt


@dataclass(frozen=True)
class Phrases:
    """Phrases of 2 to 3 words that occur ``support`` times; the first ``top`` of each language. A shorter phrase goes
    if a longer one around it has ``inside`` percent of its occurrences. Shards have about ``shard`` bytes; supports
    are lowered for the ``languages`` with most words and are one for others; ``filter_bytes`` bounds the broadcast."""

    support: int = 10
    top: int = 2000
    inside: int = 50
    shard: int = 1 << 21
    languages: int = 10_000
    bits: int = 16
    filter_bytes: int = 1 << 25


@dataclass
class Shard:
    """Distinct phrases of each length in a part of the corpus: languages, word numbers, counts."""

    languages: list[str]
    words: pa.Array
    hashes: np.ndarray
    language_hashes: np.ndarray
    sizes: np.ndarray  # words of each language
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # (language, (phrases, words), count) by length

    def phrase_hashes(self, length: int) -> np.ndarray:
        language, numbers, _ = self.found[length - 1]
        h = self.language_hashes[language] + np.uint64(length)
        for j in range(length):
            h = mix(h * np.uint64(0xD1342543DE82EF95) + self.hashes[numbers[:, j]])
        return h


def _word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts and ends of words, number of the piece of each)."""
    inner = ~_OUTER[raw]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    begins[cuts] = inner[cuts]
    stops = inner.copy()
    stops[:-1] &= ~inner[1:]
    stops[cuts - 1] = inner[cuts - 1]
    start = np.flatnonzero(begins)
    # Words of a piece have as many breaks and ends of documents before them.
    apart = _BREAK[raw]
    apart[cuts] = True
    return start, np.flatnonzero(stops) + 1, np.searchsorted(np.flatnonzero(apart), start, "right")


def _mined(raw: np.ndarray, offsets: np.ndarray, language: np.ndarray, languages: list[str]) -> Shard:
    start, end, piece = _word_bounds(raw, offsets)
    bounds = np.concatenate(([0], np.cumsum(end - start))).astype(np.int64)
    letters = _LOWER[raw[~_OUTER[raw]]]
    said = pa.Array.from_buffers(
        pa.large_string(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode()
    words, number = said.dictionary, np.asarray(said.indices).astype(np.int64)
    width = max(1, len(words))
    doc = np.searchsorted(offsets, start, "right") - 1
    of = language[doc]

    found = []
    code = of * width + number
    distinct, count = np.unique(code, return_counts=True)
    found.append((distinct // width, (distinct % width)[:, None], count))
    together = piece[1:] == piece[:-1] if len(start) else np.zeros(0, bool)
    at = np.flatnonzero(together)
    pair, which, count = np.unique(code[at] * width + number[at + 1], return_inverse=True, return_counts=True)
    found.append((pair // (width * width), np.stack((pair // width % width, pair % width), 1), count))
    of_pair = np.full(len(start), -1, np.int64)
    of_pair[at] = which
    at = np.flatnonzero(together[:-1] & together[1:]) if len(start) > 2 else np.zeros(0, np.int64)
    triple, count = np.unique(of_pair[at] * width + number[at + 2], return_counts=True)
    first = pair[triple // width]
    found.append((first // (width * width), np.stack((first // width % width, first % width, triple % width), 1), count))
    return Shard(
        languages, words, strong_hashes([w.encode() for w in words.to_pylist()]), strong_hashes([x.encode() for x in languages]),
        np.bincount(of, minlength=len(languages)), found)


def _cut(raw: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Parts of at most ``size`` bytes, as (from, to, offsets): whole documents, or a long one cut at breaks, which no
    phrase crosses. Only a piece without a break may be longer."""
    if offsets[-1] - offsets[0] <= size or len(offsets) > 2:
        yield 0, len(raw), offsets
        return
    breaks = np.flatnonzero(_BREAK[raw]) + 1
    at = 0
    while at < len(raw):
        k = int(np.searchsorted(breaks, at + size, "right"))
        end = len(raw)
        if len(raw) - at > size and len(breaks):
            end = int(breaks[k - 1]) if k and breaks[k - 1] > at else int(breaks[k]) if k < len(breaks) else len(raw)
        yield at, end, np.array([0, end - at])
        at = end


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]]:
    """(bytes, offsets, language of each text, languages) of the shards of (lang, text) rows."""
    for batch in batches:
        codes = batch.column(0).dictionary_encode()
        languages, of = codes.dictionary.to_pylist(), np.asarray(codes.indices).astype(np.int64)
        for lo, hi, raw, offsets in pieces(batch, "text", size):
            for a, b, where in _cut(raw, offsets, size):
                if b > a:
                    yield raw[a:b], where, of[lo:hi], languages


def _sizes(texts: DataFrame, how: Phrases) -> DataFrame:
    """(lang, words): one row per shard and language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw, offsets, of, languages in _shards(batches, how.shard):
            start, _, _ = _word_bounds(raw, offsets)
            words = np.bincount(of[np.searchsorted(offsets, start, "right") - 1], minlength=len(languages))
            yield pa.RecordBatch.from_arrays([pa.array(languages, pa.string()), pa.array(words)], ["lang", "words"])

    return texts.mapInArrow(count, "lang string, words bigint")


def _in_parts(batch: pa.RecordBatch, rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in batches that are small also where they are read."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _lowered(support: int, words: int, n: int) -> int:
    """The support in proportion to a share of ``words`` in ``n``, rounded up; one where ``n`` is not known."""
    return max(1, -(-support * words // n)) if n else 1


def _reported(texts: DataFrame, totals: Broadcast, how: Phrases) -> DataFrame:
    """(language, hash, excess): what shards find frequent by their lowered support, and how far beyond what they may
    hide; the hash 0 stands for what a shard may hide of any phrase of the language."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _shards(batches, how.shard):
            shard = _mined(*part)
            known = [totals.value.get(name, (-1, 0)) for name in shard.languages]
            number = np.array([i for i, _ in known], np.int32)
            support = np.array([
                _lowered(how.support, size, n) for size, (_, n) in zip(shard.sizes.tolist(), known, strict=True)])
            hidden = np.flatnonzero(support > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[hidden]), pa.array(np.zeros(len(hidden), np.int64)), pa.array(support[hidden] - 1)],
                ["language", "hash", "excess"])
            for length in (1, 2, 3):
                language, _, count = shard.found[length - 1]
                hashes = shard.phrase_hashes(length).view(np.int64)
                hashes = np.where(hashes == 0, 1, hashes)
                frequent = count >= support[language]
                yield from _in_parts(pa.RecordBatch.from_arrays(
                    [pa.array(number[language[frequent]]), pa.array(hashes[frequent]),
                     pa.array((count - support[language] + 1)[frequent])], ["language", "hash", "excess"]))

    return texts.mapInArrow(report, "language int, hash bigint, excess bigint")


def _counted(texts: DataFrame, bits: Broadcast, how: Phrases) -> DataFrame:
    """(lang, length, phrase, n): counts, shard by shard, of the phrases that the filter holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _shards(batches, how.shard):
            shard = _mined(*part)
            names = pa.array(shard.languages, pa.string())
            words = shard.words.cast(pa.string())
            for length in (1, 2, 3):
                language, numbers, n = shard.found[length - 1]
                hashes = shard.phrase_hashes(length)
                hashes = np.where(hashes == 0, np.uint64(1), hashes)
                hit = np.flatnonzero(holds(bits.value, block_of(hashes, len(bits.value)), hashes))
                if not len(hit):
                    continue
                said = [words.take(pa.array(numbers[hit, j])) for j in range(length)]
                yield from _in_parts(pa.RecordBatch.from_arrays(
                    [names.take(pa.array(language[hit])), pa.array(np.full(len(hit), length, np.int32)),
                     pc.binary_join_element_wise(*said, " ") if length > 1 else said[0], pa.array(n[hit])],
                    ["lang", "length", "phrase", "n"]))

    return (
        texts.mapInArrow(count, "lang string, length int, phrase string, n bigint")
        .groupBy("lang", "length", "phrase").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= how.support)
    )


def frequent_phrases(docs: DataFrame, how: Phrases = Phrases(), text_column: str = "text",
                     lang_column: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(totals, counts): (lang, n) with all words of each language, and (lang, length, phrase, n) with the phrases of
    one to three words that occur at least ``how.support`` times in it."""
    spark = for_workers(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    sizes = staged(_sizes(texts, how))
    totals = staged(sizes.groupBy("lang").agg(F.sum("words").alias("n")))
    largest = totals.orderBy(F.desc("n"), "lang").limit(how.languages).withColumnRenamed("lang", "name")
    lowered = F.greatest(F.ceil(F.lit(how.support) * F.col("words") / F.col("n")), F.lit(1))
    hides = (
        sizes.join(F.broadcast(largest), F.col("lang") == F.col("name"))
        .groupBy("lang", "n").agg(F.sum(lowered - 1).cast("bigint").alias("hidden")).collect()
    )
    numbers = {r["lang"]: (i, r["n"]) for i, r in enumerate(hides)}
    hidden = {i: r["hidden"] for i, r in enumerate(hides)}
    known = spark.sparkContext.broadcast(numbers)
    # Shards have counted already, so nothing is gained by counting again before the shuffle; every task gets about a
    # million words' reports.
    words = totals.agg(F.sum("n")).first()[0] or 0
    tasks = max(partitions(spark), words // 1_000_000 + 1)
    reports = (
        _reported(texts, known, how).repartition(tasks, "language", "hash")
        .groupBy("language", "hash").agg(F.sum("excess").alias("excess"))
    )
    while True:
        most = spark.createDataFrame(list(hidden.items()), "language int, hidden bigint")
        found = staged(
            reports.join(F.broadcast(most), "language", "left")
            .filter((F.col("hash") == 0) | (F.col("excess") + F.coalesce("hidden", F.lit(0)) >= how.support)))
        more = {r["language"]: r["excess"] for r in found.filter("hash = 0").collect()}
        if all(more[i] <= hidden[i] for i in more):
            break
        # Rows came in another order than before and fell into other shards.
        hidden = {i: max(n, more.get(i, 0)) for i, n in hidden.items()}
    candidates = found.filter("hash != 0").select("hash")
    wanted = -(-candidates.count() * how.bits // (8 * BLOCK_BYTES))
    blocks = max(1, min(wanted, how.filter_bytes // BLOCK_BYTES))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(block_of(hashes.view(np.uint64), blocks)), batch.column(0)], ["block", "hash"])

    filter_blocks = marked(candidates.mapInArrow(placed, "block bigint, hash bigint"))
    bits = spark.sparkContext.broadcast(collected(filter_blocks, 0, blocks))
    counts = staged(_counted(texts, bits, how))
    known.unpersist()
    bits.unpersist()
    return totals, counts


def collocations(docs: DataFrame, how: Phrases = Phrases(), text_column: str = "text",
                 lang_column: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two or three words of each language.

    Texts are lower-cased in A-Z and cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and
    tabs. a, l and r are the occurrences, overlaps included, of the phrase and of its two parts at the cut with the
    lowest score, floor(1000000 a a / (l r)), the earlier of equal cuts; n are all words of the language. Ranks go by
    score and a, highest first, then phrase by bytes. Null texts are empty, a null language is ``und``, repeated rows
    count each; a language without phrases has no rows. Other columns are not read.
    """
    totals, counts = frequent_phrases(docs, how, text_column, lang_column)
    words = F.split("phrase", " ")
    joined = lambda first, n: F.array_join(F.slice(words, first, n), " ")
    longer = (
        counts.filter("length = 3")
        .select("lang", F.explode(F.array(joined(1, 2), joined(2, 2))).alias("phrase"), F.col("n").alias("around"))
        .groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    )
    left = (
        counts.filter("length > 1").join(longer, ["lang", "phrase"], "left")
        .filter((F.col("length") == 3) | F.col("around").isNull()
                | (F.col("around").cast("decimal(20,0)") * 100 < F.col("n").cast("decimal(20,0)") * how.inside))
        .select("lang", "phrase", F.col("n").alias("a"), "length")
    )
    cuts = left.select(
        "lang", "phrase", "a", F.pmod(F.hash("phrase"), F.lit(_SALT)).alias("salt"),
        F.explode(F.transform(F.sequence(F.lit(1), F.col("length") - 1), lambda k: F.struct(
            k.alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
            F.array_join(F.slice(words, k + 1, F.col("length") - k), " ").alias("right")))).alias("cut"),
    ).select("lang", "phrase", "a", "salt", "cut.*")
    # A word may begin or end very many phrases, so its count goes to each part of them.
    parts = counts.filter("length < 3").select(
        "lang", F.col("phrase").alias("part"), "n", F.explode(F.array(*map(F.lit, range(_SALT)))).alias("salt"))

    def with_count(rows: DataFrame, part: str, name: str) -> DataFrame:
        return rows.join(parts.withColumnsRenamed({"part": part, "n": name}), ["lang", part, "salt"])

    big = "cast(%s as decimal(19,0))"
    score = F.expr(f"cast(1000000 as decimal(7,0)) * {big % 'a'} * {big % 'a'} div ({big % 'l'} * {big % 'r'})")
    best = (
        with_count(with_count(cuts, "left", "l"), "right", "r")
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.cast("bigint").alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= how.top)
        .join(F.broadcast(totals) if totals.limit(how.languages + 1).count() <= how.languages else totals, "lang")
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
