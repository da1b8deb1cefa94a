"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and grouping."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from folioworks.llm.blocks import intersections, lists, local_roots, sorted_groups
from folioworks.llm.common import for_workers, no_null, partitions, small, staged
from folioworks.llm.components import components
from folioworks.llm.tokens import mix, pieces, shingles, word_hashes, words

_LEVEL = np.uint64(56)  # bits of the random part below a level
_EMPTY = np.iinfo(np.uint64).max


@dataclass(frozen=True)
class Near:
    """Linked are sets with 100 * intersection >= ``percent`` * union. ``bands`` of ``rows`` slots each: at 85 a pair
    shares no band once in two million, at 80 once in twenty thousand. Blocks hold about ``block`` sets."""

    percent: int = 85
    words: int = 5
    bands: int = 25
    rows: int = 5
    block: int = 160


def signatures(hashes: np.ndarray, first: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signatures, (documents, slots), of sets given as runs of distinct hashes.

    Each element deals its values over the slots in the order of a random permutation, level by level: at level j it
    offers j and a random fraction to its j-th slot, so later levels only matter where a slot is still empty. A
    document stops once all its slots are filled. Values hold the level in the top byte.
    """
    n = len(first) - 1
    out = np.full((n, slots), _EMPTY, np.uint64)
    flat = out.ravel()
    doc = np.repeat(np.arange(n), np.diff(first))
    h = hashes
    # Where a permutation's first two swaps went, then whole permutations for the elements still at work.
    drawn: list[np.ndarray] = []
    perm: np.ndarray | None = None
    for level in range(slots):
        if not len(h):
            break
        r = mix(h + np.uint64((2 * level + 1) * 0xD1342543DE82EF95 % 2**64))
        k = level + ((r >> np.uint64(32)) % np.uint64(slots - level)).astype(np.int64)
        if level < 2:
            slot = np.where(k == drawn[0], 0, k) if level else k
            drawn.append(k)
        else:
            row = np.arange(len(h))
            if perm is None:
                perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(h), 1))
                for at, to in enumerate(drawn):
                    perm[row, at], perm[row, to] = perm[row, to], perm[row, at]
            slot = perm[row, k].astype(np.int64)
            perm[row, k] = perm[row, level]
        value = (np.uint64(level) << _LEVEL) | (mix(r) >> np.uint64(64) - _LEVEL)
        np.minimum.at(flat, doc * slots + slot, value)
        going = (out == _EMPTY).any(1)[doc]
        if not going.all():
            h, doc = h[going], doc[going]
            drawn = [d[going] for d in drawn] if perm is None else []
            perm = perm[going] if perm is not None else None
    return out


def band_keys(signature: np.ndarray, how: Near) -> np.ndarray:
    """One 64-bit key per band."""
    bands = signature.reshape(len(signature), how.bands, how.rows)
    key = np.arange(1, how.bands + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    key = np.broadcast_to(key, bands.shape[:2])
    for r in range(how.rows):
        key = mix(key + bands[:, :, r])
    return key


def _sets(batch: pa.RecordBatch, how: Near) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for lo, hi, raw, offsets in pieces(batch, "text"):
        starts, ends, first = words(raw, offsets)
        yield lo, hi, *shingles(word_hashes(raw, starts, ends, lower=True), first, how.words)


def sketched(docs: DataFrame, how: Near) -> DataFrame:
    """(key, text_key, doc_id, n_shingles, set_a, set_b, bands) per row; a set is known by its size and two sums."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, h, first in _sets(batch, how):
                size = np.diff(first)
                sums = [np.concatenate(([0], np.cumsum(mix(h ^ np.uint64(s)))))
                        for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
                keys = np.zeros((hi - lo, how.bands), np.uint64)
                full = np.flatnonzero(size)
                packed = np.concatenate(([0], np.cumsum(size[full])))
                keys[full] = band_keys(signatures(h, packed, how.bands * how.rows), how)
                part = batch.slice(lo, hi - lo)
                offsets = np.concatenate(([0], np.cumsum(np.where(size > 0, how.bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(size.astype(np.int64)),
                     *(pa.array((s[first[1:]] - s[first[:-1]]).view(np.int64)) for s in sums),
                     pa.ListArray.from_arrays(offsets, keys[full].ravel().view(np.int64))],
                    ["key", "text_key", "doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return docs.select("key", "text_key", "doc_id", "text").mapInArrow(
        sketch, "key string, text_key bigint, doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, "
                "bands array<bigint>")


def set_hashes(docs: DataFrame, how: Near) -> DataFrame:
    """(class, hashes): the whole shingle set of each text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, h, first in _sets(batch, how):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(first.astype(np.int32), h.view(np.int64))],
                    ["class", "hashes"])

    return docs.select("class", "text").mapInArrow(hashed, "class bigint, hashes array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """(a, b, both, either, linked) for pairs of classes, from their full sets."""
    one = lambda c: sets.select(F.col("class").alias(c), F.col("hashes").alias(f"_{c}"))
    both = F.size(F.array_intersect("_a", "_b"))
    return staged(
        pairs.join(one("b"), "b").join(one("a"), "a")
        .select("a", "b", both.alias("both"), (F.size("_a") + F.size("_b")).alias("sizes"))
        .select("a", "b", "both", (F.col("sizes") - F.col("both")).alias("either"))
        .withColumn("linked", F.col("both").cast("bigint") * 100 >= F.col("either").cast("bigint") * how.percent)
    )


def near_documents(docs: DataFrame, how: Near = Near(), id_column: str = "doc_id",
                   text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept; see :func:`near_rows`."""
    return near_rows(docs, how, id_column, text_column).drop("key", "text_key")


def row_key(id_column: str = "doc_id", text_column: str = "text") -> tuple[Column, Column]:
    """(key, text_key): the null-safe id and a hash of the text, by which a row is known. Rows alike in both are copies
    under one id and share their fate."""
    return (no_null(F.col(id_column)).alias("key"),
            F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("text_key"))


def near_rows(docs: DataFrame, how: Near = Near(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: key, text_key (as in :func:`row_key`), doc_id, n_shingles, component_id, kept.

    Words are lower-cased in A-Z only. Equal sets are one class, known by their size and two sums of 64 bits. Sets hold 64-bit hashes of shingles. Classes that
    share a band are candidates. In each band bucket all members are held against a pivot, the one of the smallest id; the
    links found are grouped, and buckets whose members are still apart are compared in blocks. Similarities
    are always those of the full sets.

    Null and empty texts have no shingles and link with nothing; so does a text without words. Rows with a null id
    give their component no name; they are kept if it has none. Repeated ids are rows of their own. Other columns are not read.
    """
    spark = for_workers(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    given = docs.select(
        *row_key(id_column, text_column), F.col(id_column).cast("bigint").alias("doc_id"), text.alias("text"))
    rows = staged(sketched(given, how))
    sets = ["n_shingles", "set_a", "set_b"]
    classes = staged(
        rows.filter("n_shingles > 0").groupBy(*sets)
        .agg(F.min("doc_id").alias("least"), F.min(F.struct("key", "text_key")).alias("first"))
        .select("*", "first.key", "first.text_key").drop("first")
        .withColumn("class", F.monotonically_increasing_id())
    )
    banded = (
        rows.join(classes.select("class", "least", "key", "text_key"), ["key", "text_key"])
        .select("class", "least", F.posexplode("bands").alias("band", "bucket"))
    )
    # Copies are mostly younger than what they were made from, so the oldest member of a bucket is a good pivot.
    shared = small(staged(
        banded.groupBy("band", "bucket")
        .agg(F.min(F.struct("least", "class")).alias("oldest"), F.min("class").alias("low"), F.max("class").alias("high"))
        .filter("low < high").select("band", "bucket", F.col("oldest.class").alias("pivot"))
    ))
    members = staged(banded.drop("least").join(shared, ["band", "bucket"]).distinct())
    stars = staged(members.filter("class != pivot").select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct())
    wanted = stars.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    names = staged(classes.join(wanted, "class", "left_semi").select("class", "key", "text_key"))
    # A representative that is repeated as a row is read once.
    texts = given.join(small(names), ["key", "text_key"]).select("class", "text").dropDuplicates(["class"])
    whole = staged(set_hashes(texts, how))
    tested = _verified(stars, whole, how)
    links = tested.filter("linked").select("a", "b")
    roots = components(links)
    more = staged(_links_apart(members, roots, tested, whole, how))
    if not more.isEmpty():
        roots = components(links.union(more))
    grouped = (
        classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    named = grouped.join(grouped.groupBy("root").agg(F.min("least").alias("component")), "root")
    return (
        rows.join(named.select(*sets, "component"), sets, "left")
        .select(
            "key", "text_key", "doc_id", "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _links_apart(members: DataFrame, roots: DataFrame, tested: DataFrame, sets: DataFrame, how: Near) -> DataFrame:
    """Links that join components within buckets whose members are still apart.

    Members of a bucket are put into bins by their distance from the pivot, as wide as a link reaches: by the triangle
    inequality links join members of one bin or of neighbouring bins. Bins are cut into blocks, and each pair of blocks
    is a small group whose sets are held against each other; only links that a block needs to hang together come out.
    """
    reach = 1 - how.percent / 100 + 1e-9
    placed = (
        members.join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    split = (
        placed.groupBy("band", "bucket").agg(F.min("root").alias("r"), F.max("root").alias("s"))
        .filter("r < s").select("band", "bucket")
    )
    away = tested.select(F.col("a").alias("pivot"), F.col("b").alias("class"),
                         F.floor((1 - F.col("both") / F.col("either")) / reach).cast("int").alias("bin"))
    rest = staged(
        placed.filter("class != pivot").join(split, ["band", "bucket"], "left_semi").join(away, ["pivot", "class"])
        .select("band", "bucket", "bin", "class", "root")
    )
    bins = rest.groupBy("band", "bucket", "bin").agg(
        F.ceil(F.count(F.lit(1)) / how.block).cast("int").alias("blocks"))
    near = bins.select("band", "bucket", F.col("bin").alias("bin2"), F.col("blocks").alias("blocks2"))
    reached = (
        bins.withColumn("bin2", F.explode(F.sequence(F.col("bin") - 1, F.col("bin") + 1)))
        .join(near, ["band", "bucket", "bin2"])
    )
    code = lambda b, n: b.cast("bigint") * (1 << 32) + n
    own = code(F.col("bin"), F.pmod(F.xxhash64("class", "band"), F.col("blocks")))
    dealt = (
        rest.join(reached, ["band", "bucket", "bin"])
        .withColumn("block", own)
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.col("blocks2") - 1)))
        .withColumn("other", code(F.col("bin2"), F.col("number")))
        .select("band", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                "block", "class", "root")
    )
    group = ["band", "bucket", "low", "high"]
    # Groups that have nothing to compare are not given any sets.
    busy = dealt.groupBy(*group).agg(F.min("root").alias("r"), F.max("root").alias("s")).filter("r < s").select(*group)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in sorted_groups(batches, group):
            hashes, where = lists(table, "hashes")
            ids, roots_, block, low, high = (table.column(c).to_numpy() for c in ("class", "root", "block", "low", "high"))
            for a, b in zip(bounds, np.append(bounds[1:], len(ids)), strict=True):
                if b - a < 2:
                    continue
                at = where[a : b + 1]
                both = intersections(hashes[at[0] : at[-1]], at - at[0])
                size = np.diff(at)
                either = size[:, None] + size[None, :] - both
                linked = np.triu(both * 100 >= either * how.percent, 1) & (roots_[a:b, None] != roots_[None, a:b])
                if low[a] != high[a]:
                    linked &= block[a:b, None] != block[None, a:b]
                i, j = np.nonzero(linked)
                if len(i):
                    root = local_roots(ids[a:b], i, j)
                    hit = np.flatnonzero(root != ids[a:b])
                    yield pa.RecordBatch.from_arrays([pa.array(root[hit]), pa.array(ids[a:b][hit])], ["a", "b"])

    return (
        dealt.join(busy, group, "left_semi").join(sets, "class")
        .repartition(partitions(members.sparkSession), *group).sortWithinPartitions(*group)
        .select(*group, "block", "class", "root", "hashes")
        .mapInArrow(compare, "a bigint, b bigint")
        .distinct()
    )
