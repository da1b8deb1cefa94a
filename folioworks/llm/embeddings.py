"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioworks.llm.blocks import lists, local_roots, sorted_groups
from folioworks.llm.common import for_workers, partitions, staged
from folioworks.llm.components import components


@dataclass(frozen=True)
class Polytopes:
    """``tables`` tables of two polytopes each; a vector is probed in its bucket and in those that replace one of the
    two corners by the next nearest. Buckets are compared in blocks of about ``block`` classes."""

    cosine: float = 0.98
    tables: int = 8
    block: int = 192
    seed: int = 17


def _rotated(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of random signs and a Hadamard transform; the width is a power of two."""
    n = x.shape[1]
    for s in signs:
        x = x * s
        half = 1
        while half < n:
            x = x.reshape(-1, n // (2 * half), 2, half)
            x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
            half *= 2
        x = x.reshape(-1, n)
    return x


def _corners(x: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the next nearest corner of the rotated polytope."""
    y = _rotated(x, signs)
    size = np.abs(y)
    row = np.arange(len(y))
    out = []
    for _ in range(2):
        best = size.argmax(1)
        out.append(best * 2 + (y[row, best] < 0))
        size[row, best] = -1
    return out[0], out[1]


def bucket_keys(unit: np.ndarray, how: Polytopes) -> np.ndarray:
    """Keys of each vector, (rows, tables, 3): its own bucket, then the two it is probed in."""
    width = 1 << max(1, (unit.shape[1] - 1).bit_length())
    x = np.zeros((len(unit), width))
    x[:, : unit.shape[1]] = unit
    keys = np.empty((len(unit), how.tables, 3), np.int64)
    for t in range(how.tables):
        signs = np.random.default_rng((how.seed, t, width)).choice((-1.0, 1.0), (2, 3, width))
        (a, a2), (b, b2) = _corners(x, signs[0]), _corners(x, signs[1])
        m = 2 * width
        for k, key in enumerate((a * m + b, a2 * m + b, a * m + b2)):
            keys[:, t, k] = t * m * m + key
    return keys


def _linked(x: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j whose cosine reaches the threshold."""
    i, j = np.nonzero(np.triu(x @ x.T >= threshold - 1e-9, 1))
    exact = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
    return i[exact], j[exact]


def compared(keys: np.ndarray, unit: np.ndarray, ids: np.ndarray, rows: np.ndarray, side: np.ndarray, across: bool,
             bucket: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links within one block of one bucket: (members, links counted here, smallest member of the local component).

    ``side`` is the half of the block a member stands in; only pairs ``across`` halves are compared where there are
    two. A pair that also meets in a bucket of a smaller number is counted there.
    """
    i, j = _linked(unit, threshold)
    if across:
        other = side[i] != side[j]
        i, j = i[other], j[other]
    # Two probes that meet, with neither at home, are no candidate pair.
    own = (keys[:, :, 0] == bucket).any(1)
    home = own[i] | own[j]
    i, j = i[home], j[home]
    counted = np.zeros(len(ids), np.int64)
    for lo in range(0, len(i), 20_000):
        a, b = i[lo : lo + 20_000], j[lo : lo + 20_000]
        same = keys[a][:, :, :, None] == keys[b][:, :, None, :]
        same[:, :, 1:, 1:] = False
        first = np.where(same, keys[a][:, :, :, None], np.iinfo(np.int64).max).reshape(len(a), -1).min(1)
        here = first == bucket
        np.add.at(counted, a[here], rows[b[here]])
        np.add.at(counted, b[here], rows[a[here]])
    root = local_roots(ids, i, j)
    return np.unique(np.concatenate((i, j))), counted, root


def near_embeddings(vectors: DataFrame, how: Polytopes = Polytopes(), id_column: str = "vec_id",
                    vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Linked are vectors of one label, one length and a cosine of at least ``how.cosine``, computed in double precision
    for every candidate pair; candidates share a bucket in some table, at least one of them as its own bucket. A
    vector without label, null, empty, zero or with null or non-finite components links with nothing. Equal vectors of
    a label are one class that knows its size, so copies are never compared; ``n_links`` counts rows. The component is
    named by its smallest id. Null ids are kept as they are. Other columns are not read.

    Large buckets are cut into blocks by class, and every pair of blocks is one small group: no bucket meets in one
    task and no pair becomes a row.
    """
    spark = for_workers(vectors.sparkSession)
    numbers = F.col("_vector")
    good = (
        F.col("_label").isNotNull() & F.coalesce(F.size(numbers) > 0, F.lit(False))
        & ~F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(numbers, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(id_column).alias("vec_id"), F.col(label_column).cast("string").alias("_label"),
        F.transform(F.col(vector_column), lambda x: x.cast("double") + 0.0).alias("_vector"),
    )
    usable = rows.filter(good).withColumn("_hash", F.xxhash64("_vector"))
    classes = staged(
        usable.groupBy("_label", "_hash", "_vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
        .withColumn("class", F.monotonically_increasing_id())
    )
    tables = how.tables

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                lists = part.column(1)
                sizes = np.diff(np.asarray(lists.offsets))
                for size in np.unique(sizes):
                    at = np.flatnonzero(sizes == size)
                    these = part.take(pa.array(at))
                    x = np.asarray(these.column(1).flatten()).reshape(len(at), size)
                    # Scaled first, so that squares neither overflow nor vanish.
                    x = x / np.abs(x).max(1, keepdims=True)
                    x /= np.sqrt((x * x).sum(1, keepdims=True))
                    keys = bucket_keys(x, how)
                    yield pa.RecordBatch.from_arrays(
                        [these.column(0), these.column(2), these.column(3), pa.array(np.full(len(at), size, np.int32)),
                         pa.ListArray.from_arrays(np.arange(0, x.size + 1, size, dtype=np.int32), x.ravel()),
                         pa.ListArray.from_arrays(
                             np.arange(0, keys.size + 1, 3 * tables, dtype=np.int32), keys.ravel())],
                        ["class", "copies", "label", "width", "unit", "keys"],
                    )

    indexed = staged(
        classes.select("class", "_vector", "copies", "_label").mapInArrow(
            hashed, "class bigint, copies bigint, label string, width int, unit array<double>, keys array<bigint>")
    )
    # Own buckets are every third key; a bucket that nobody calls its own gives no candidates.
    placed = indexed.select("label", "width", "class", F.explode(F.array_distinct("keys")).alias("bucket"), "keys")
    own = F.array_contains(F.filter("keys", lambda k, i: i % 3 == 0), F.col("bucket"))
    full = (
        placed.groupBy("label", "width", "bucket")
        .agg(F.count(F.lit(1)).alias("members"), F.count_if(own).alias("own"))
        .filter("members > 1 and own > 0")
        .withColumn("blocks", F.ceil(F.col("members") / how.block).cast("int"))
    )
    block = F.pmod(F.xxhash64("class", "bucket"), F.col("blocks")).cast("int")
    dealt = (
        placed.drop("keys").join(full.select("label", "width", "bucket", "blocks"), ["label", "width", "bucket"])
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("class", "bucket", "block", F.least("block", "other").alias("low"),
                F.greatest("block", "other").alias("high"))
        .join(indexed, "class")
    )
    group = ["label", "width", "bucket", "low", "high"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in sorted_groups(batches, group):
            (unit, at), (keys, _) = lists(table, "unit"), lists(table, "keys")
            ids, rows_, side, bucket, low, high, width = (
                table.column(c).to_numpy() for c in ("class", "copies", "block", "bucket", "low", "high", "width"))
            for a, b in zip(bounds, np.append(bounds[1:], len(ids)), strict=True):
                if b - a < 2:
                    continue
                x = unit[at[a] : at[b]].reshape(b - a, width[a])
                k = keys[a * 3 * tables : b * 3 * tables].reshape(b - a, tables, 3)
                who, counted, root = compared(k, x, ids[a:b], rows_[a:b], side[a:b], bool(low[a] != high[a]),
                                              int(bucket[a]), how.cosine)
                if len(who):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[a:b][who]), pa.array(counted[who]), pa.array(root[who])],
                        ["class", "links", "root"])

    found = staged(
        dealt.repartition(partitions(spark), *group).sortWithinPartitions(*group)
        .select(*group, "class", "copies", "block", "unit", "keys")
        .mapInArrow(compare, "class bigint, links bigint, root bigint")
    )
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
        .join(links, "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    answer = named.join(least, "root").select(
        F.col("_label").alias("l"), F.col("_hash").alias("h"), F.col("_vector").alias("v"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "component")
    keyed = rows.withColumn("_good", good).withColumn("_hash", F.when(F.col("_good"), F.xxhash64("_vector")))
    same = (F.col("_hash") == F.col("h")) & (F.col("_label") == F.col("l")) & (F.col("_vector") == F.col("v"))
    return (
        keyed.join(answer, same, "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).alias("n_links"),
            F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component")).cast("bigint").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
