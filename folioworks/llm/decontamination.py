"""Benchmark decontamination by SimHash over item-sized windows, in DataFrame functions only.

Every benchmark item has a fingerprint of its word shingles, and so has every window of an item's length in a document
that can hold it. Fingerprints are found by a multi-index: they are cut into blocks, and since two within the radius
differ in at most one bit in one block at least, a lookup of each block with all its one-bit neighbours finds every
fingerprint within the radius. What is found is verified by the exact similarity of the weighted shingles.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from folioworks.functions.binding import free_names, let
from folioworks.llm.common import no_null, small, staged


@dataclass(frozen=True)
class Leak:
    """Shingles have ``words`` words, or all of a shorter item. Weights are how often a shingle occurs.

    At a similarity of 0.8 fingerprints differ in about 10 of 64 bits, with a deviation of 3: one pair in a thousand
    lies beyond the radius. The radius is below twice the number of blocks, so one differing bit a block is enough.
    """

    similarity: float = 0.8
    words: int = 5
    radius: int = 19
    blocks: int = 10


def spoken(text: Column) -> Column:
    """Lower-case words of letters and digits; none for null."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")


def _shingles(hashes: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, from the hashes of the words."""
    return F.when(
        F.size(hashes) >= width,
        F.transform(
            F.slice(hashes, 1, F.size(hashes) - (width - 1)),
            lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, width)))),
    ).otherwise(F.array().cast("array<bigint>"))


def fingerprint(shingles: Column) -> Column:
    """64-bit SimHash: a bit is set if most shingles, counted as often as they occur, have it set."""
    def most(bit: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0).cast("bigint"),
                           lambda n, h: n + F.call_function("bit_get", h, bit.cast("int")).cast("bigint"))
        return F.when(ones * 2 > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.cast("int")))

    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: F.coalesce(most(b), F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(b))


def _blocks(value: Column, rule: Leak, neighbours: bool) -> Column:
    """(block, value) of every block of a fingerprint, with all values one bit away if asked for."""
    cuts = [64 * b // rule.blocks for b in range(rule.blocks + 1)]
    out = []
    for b, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        block = F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("bigint"))
        flips = [0, *(1 << k for k in range(high - low))] if neighbours else [0]
        out += [F.struct(F.lit(b).alias("block"), block.bitwiseXOR(F.lit(f).cast("bigint")).alias("value"))
                for f in flips]
    return F.array(*out)


def _tagged(shingles: Column) -> Column:
    """Each occurrence of a shingle as a number of its own, so that a multiset can be handled as a set."""
    return let(F.array_sort(shingles), lambda s: F.transform(
        s, lambda h, i: F.xxhash64(h, i - F.array_position(s, h).cast("int"))))


def _starts(at: Column, m: Column, similarity: float) -> Column:
    """Starts of all windows of ``m`` shingles with at least the share ``similarity`` of ``m`` among the sorted places.

    Each start is found once, at the first place that its window holds.
    """
    least = F.greatest(F.ceil(m * similarity - 1e-9), F.lit(1)).cast("int")

    def from_place(first: Column, i: Column) -> Column:
        low = F.greatest(F.get(at, i + least - 1) - m + 1, F.coalesce(F.get(at, i - 1) + 1, first - m + 1))
        return F.when(low <= first, F.sequence(low, first)).otherwise(F.array().cast("array<int>"))

    return F.flatten(F.transform(F.slice(at, 1, F.greatest(F.size(at) - least + 1, F.lit(0))), from_place))


def leaks(docs: DataFrame, benchmark: DataFrame, rule: Leak = Leak(), id_column: str = "doc_id",
          text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """(key, text_key, item_id, similarity) for every document and every item it holds.

    A document holds an item if a window of the item's length, cut off at the document's ends, has a weighted shingle
    similarity of at least ``rule.similarity``. The shingles they have in common are then at least that share of the
    item's; so windows are laid at every start from which so many places hold a shingle of the item, in any order, and
    all of them are fingerprinted and looked up among the items of their length. No other window is similar enough.
    Items without words, null or empty texts hold nothing and match nothing; equal items are all reported. Texts are
    read whole. Rows alike in id and text are one document. Other columns are not read.
    """
    items = staged(
        benchmark.select(F.col(item_column).alias("item_id"), spoken(F.col(item_text_column)).alias("_words"))
        .withColumn("long", F.size("_words"))
        .filter("long > 0")
        .withColumn("width", F.least("long", F.lit(rule.words)))
        .withColumn("shingles", let(F.transform("_words", lambda w: F.xxhash64(w)), lambda hashes: F.coalesce(*(
            F.when(F.col("width") == w, _shingles(hashes, w)) for w in range(1, rule.words + 1)))))
        .select("item_id", "long", "width", "shingles")
    )
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most rule.words values
    if not widths:
        widths = [rule.words]
    text = F.col(text_column)
    # Bound to a name, word hashes are computed once per text and not once per shingle.
    every_width = let(
        F.transform(spoken(text), lambda w: F.xxhash64(w)),
        lambda hashes: F.struct(*(_shingles(hashes, w).alias(f"_{w}") for w in widths)))
    hashed = docs.select(
        no_null(F.col(id_column)).alias("key"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"),
        F.explode_outer(F.array(every_width)).alias("_shingles"))
    shingled = hashed.select("key", "text_key", "_shingles.*")
    wanted = small(staged(
        items.select("item_id", "long", "width", F.size("shingles").alias("_m"), F.explode("shingles").alias("shingle"))
        .distinct()))
    windows = None
    for w in widths:
        met = (
            shingled.select("key", "text_key", F.posexplode(f"_{w}").alias("at", "shingle"))
            .join(wanted.filter(F.col("width") == w).drop("width"), "shingle")
            .groupBy("key", "text_key", "item_id", "long", "_m").agg(F.collect_set("at").alias("at"))
            .select("key", "text_key", F.lit(w).alias("width"), "long",
                    F.explode(_starts(F.array_sort("at"), F.col("_m"), rule.similarity)).alias("start"))
        )
        windows = met if windows is None else windows.union(met)
    windows = staged(windows.distinct())
    by_document = windows.groupBy("key", "text_key").agg(F.collect_list(F.struct("width", "long", "start")).alias("windows"))
    # As many rows at most as there are windows, which are narrow and counted before any of this is broadcast.
    if windows.limit(400_001).count() <= 400_000:
        by_document = F.broadcast(by_document)

    def laid(window: Column) -> Column:
        first = F.greatest(window["start"], F.lit(0))
        body = F.coalesce(*(
            F.when(window["width"] == w, F.slice(
                F.col(f"_{w}"), first + 1,
                F.greatest(F.lit(0), window["start"] + window["long"] - (w - 1) - first)))
            for w in widths))
        return F.struct(window["long"].alias("long"), body.alias("shingles"))

    filled = (
        shingled.join(by_document, ["key", "text_key"])
        .select("key", "text_key", F.inline(F.transform("windows", laid)))
        .filter(F.size("shingles") > 0)
    )
    # Windows with equal shingles are one, however many documents hold them.
    printed = staged(filled.withColumn("window", F.xxhash64("shingles")).withColumn("_n", F.size("shingles")))
    bodies = staged(
        printed.groupBy("long", "window", "_n").agg(F.first("shingles").alias("shingles"))
        .withColumn("print", fingerprint(F.col("shingles")))
    )
    targets = items.withColumn("item_print", fingerprint(F.col("shingles")))
    index = small(staged(
        targets.select("item_id", "long", "item_print", F.inline(_blocks(F.col("item_print"), rule, neighbours=True)))))
    near = (
        bodies.select("long", "window", "_n", "print", F.inline(_blocks(F.col("print"), rule, neighbours=False)))
        .join(index, ["long", "block", "value"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= rule.radius)
        .select("long", "window", "_n", "item_id").distinct()
    )
    both = F.size(F.array_intersect(_tagged(F.col("shingles")), _tagged(F.col("item_shingles"))))
    verified = staged(
        near.join(bodies.drop("print"), ["long", "window", "_n"])
        .join(items.select("item_id", "long", F.col("shingles").alias("item_shingles")).distinct(),
              ["item_id", "long"])
        .withColumn("_both", both)
        .withColumn("similarity", F.col("_both") / (F.size("shingles") + F.size("item_shingles") - F.col("_both")))
        .filter(F.col("similarity") >= rule.similarity)
        .select("long", "window", "_n", "item_id", "similarity")
    )
    return (
        printed.select("key", "text_key", "long", "window", "_n").join(small(verified), ["long", "window", "_n"])
        .groupBy("key", "text_key", "item_id").agg(F.max("similarity").alias("similarity"))
    )


def leak_report(docs: DataFrame, benchmark: DataFrame, rule: Leak = Leak(), id_column: str = "doc_id",
                text_column: str = "text", **columns: str) -> DataFrame:
    """``docs`` with item_ids (sorted, empty if none), similarity (the best, 0 if none) and contaminated added."""
    found = leaks(docs, benchmark, rule, id_column, text_column, **columns)
    by_document = staged(found.groupBy("key", "text_key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("similarity")))
    columns_kept = [c for c in docs.columns if c not in ("item_ids", "similarity", "contaminated")]
    names = free_names(docs.columns, "key_of_leak", "text_key_of_leak", "items_of_leak", "similarity_of_leak")
    key, text_key, items, similarity = (F.col(name) for name in names)
    marked = small(by_document.select("key", "text_key", "item_ids", "similarity").toDF(*names))
    own_text = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    same = (no_null(F.col(id_column)) == key) & (own_text == text_key)
    none = F.array().cast(by_document.schema["item_ids"].dataType)
    return docs.select(*columns_kept).join(marked, same, "left").select(
        *columns_kept,
        F.coalesce(items, none).alias("item_ids"),
        F.coalesce(similarity, F.lit(0.0)).alias("similarity"),
        items.isNotNull().alias("contaminated"))
