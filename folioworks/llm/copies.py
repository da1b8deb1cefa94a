"""Exact dedup by an exchange of Golomb-coded fingerprints.

Texts are normalised and written once, dealt by the partition that read them. Each partition sorts the fingerprints of
its rows and sends them to their owners, gaps in a Golomb code (with a power of two as divisor). An owner holds one range of fingerprints; it answers
every partition with a bitmap that tells which of those sent were sent by others too. Only rows with a marked
fingerprint, the suspects, are shuffled with their texts and held against each other byte by byte.

Fingerprints are cut to a few bits more than the number of rows needs, so that a message costs about two bytes a row;
what the cut makes suspect is cleared by the bytes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from folioworks.llm.blocks import sorted_groups
from folioworks.llm.common import for_workers, partitions, staged
from folioworks.llm.tokens import pieces
from folioworks.session import work_folder

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@dataclass(frozen=True)
class Exchange:
    """Fingerprints have ``spare_bits`` more than the count of rows: of 2^spare_bits rows without a copy, about one is
    a suspect. An owner gets about ``owner_rows`` fingerprints."""

    spare_bits: int = 10
    owner_rows: int = 1 << 20


def golomb(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Sorted distinct numbers as gaps: (shift, quotients in unary, remainders of ``shift`` bits each)."""
    gaps = np.diff(values.astype(np.int64), prepend=0)
    mean = int(values[-1]) // len(values) if len(values) else 0
    shift = max(0, (mean * 69 // 100).bit_length() - 1) if mean else 0
    quotients = gaps >> shift
    unary = np.ones(int(quotients.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    rest = ((gaps[:, None] >> np.arange(shift)) & 1).astype(np.uint8)
    return shift, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def golomb_read(n: int, shift: int, unary: bytes, rest: bytes) -> np.ndarray:
    """The numbers that were coded."""
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    quotients = np.diff(stops, prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(rest, np.uint8), count=n * shift).reshape(n, shift).astype(np.int64)
    return np.cumsum((quotients << shift) + (low << np.arange(shift)).sum(1))


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, at, doc_id, text_sha256, text) of (doc_id, text): A-Z lower-cased, rows numbered."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        for lo, hi, raw, offsets in pieces(batch, "text", 1 << 22):
            data = raw.tobytes().translate(_LOWER)
            view, n = memoryview(data), hi - lo
            ends = offsets.tolist()
            digests = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)]
            texts = pa.Array.from_buffers(
                pa.large_string(), n, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n)),
                 batch.column(0).slice(lo, n), pa.array(digests, pa.string()), texts.cast(pa.string())],
                ["part", "at", "doc_id", "text_sha256", "text"])
            at += n


def _fingerprints(sha: pa.Array | pa.ChunkedArray, bits: int) -> np.ndarray:
    """The first ``bits`` bits of each digest."""
    high = [int(x, 16) for x in pc.utf8_slice_codeunits(sha, 0, 16).to_pylist()]
    return np.array(high, np.uint64) >> np.uint64(64 - bits)


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` written in buckets by part, so that joins by part move none of them."""
    spark = rows.sparkSession
    name, folder = f"rows_{uuid.uuid4().hex}", work_folder(spark)
    rows.write.option("path", folder).bucketBy(partitions(spark), "part").saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved to the files while the name stands
    spark.sql(f"DROP TABLE {name}")  # the files stay, since the folder was given
    return table


def _marks(rows: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """(part, marks): for each partition with suspects, one bit per row in words of 64."""
    spark: SparkSession = rows.sparkSession
    low = np.uint64((1 << (bits - owner_bits)) - 1)
    up = np.uint64(bits - owner_bits)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.asarray(b.column(0)), _fingerprints(b.column(1), bits)) for b in batches if b.num_rows]
        if not held:
            return
        parts, prints = (np.concatenate(x) for x in zip(*held, strict=True))
        for part in np.unique(parts):
            distinct = np.unique(prints[parts == part])
            owner = (distinct >> up).astype(np.int64)
            lead = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            messages = [golomb(m & low) for m in np.split(distinct, lead[1:])]
            count = np.diff(np.append(lead, len(distinct)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner[lead]), pa.array(np.full(len(lead), part, np.int32)), pa.array(count),
                 *(pa.array(list(m)) for m in zip(*messages, strict=True))],
                ["owner", "part", "count", "shift", "unary", "rest"])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in sorted_groups(batches, ["owner"]):
            for a, b in zip(bounds, np.append(bounds[1:], table.num_rows), strict=True):
                group = table.slice(a, b - a)
                read = [golomb_read(*m) for m in zip(*(
                    group.column(c).to_pylist() for c in ("count", "shift", "unary", "rest")), strict=True)]
                value, times = np.unique(np.concatenate(read), return_counts=True)
                shared = value[times > 1]
                if not len(shared):
                    continue
                bitmaps = [np.packbits(np.isin(r, shared, assume_unique=True)).tobytes() for r in read]
                yield pa.RecordBatch.from_arrays(
                    [group.column(c).combine_chunks() for c in ("part", "owner")] + [pa.array(bitmaps, pa.binary())],
                    ["part", "owner", "bitmap"])

    def applied(mine: pa.Table, answers: pa.Table) -> pa.Table:
        if not mine.num_rows:
            return pa.table({"part": pa.array([], pa.int32()), "marks": pa.array([], pa.list_(pa.int64()))})
        at, prints = mine.column("at").to_numpy(), _fingerprints(mine.column("text_sha256"), bits)
        distinct, number, times = np.unique(prints, return_inverse=True, return_counts=True)
        shared = times > 1
        first = np.searchsorted(distinct >> up, np.arange((1 << owner_bits) + 1))
        for owner, bitmap in zip(answers.column("owner").to_pylist(), answers.column("bitmap").to_pylist(), strict=True):
            a, b = first[owner], first[owner + 1]
            shared[a:b] |= np.unpackbits(np.frombuffer(bitmap, np.uint8), count=b - a).astype(bool)
        words = np.zeros((int(at.max()) >> 6) + 1, np.uint64)
        hit = at[shared[number]]
        np.bitwise_or.at(words, hit >> 6, np.uint64(1) << (hit & 63).astype(np.uint64))
        return pa.table({"part": mine.column("part").slice(0, 1), "marks": pa.array([words.view(np.int64)])}
                        if len(hit) else {"part": pa.array([], pa.int32()), "marks": pa.array([], pa.list_(pa.int64()))})

    answers = (
        rows.select("part", "text_sha256")
        .mapInArrow(sent, "owner bigint, part int, count bigint, shift bigint, unary binary, rest binary")
        .repartition(partitions(spark), "owner").sortWithinPartitions("owner")
        .mapInArrow(answered, "part int, owner bigint, bitmap binary")
    )
    return staged(
        rows.select("part", "at", "text_sha256").groupBy("part").cogroup(answers.groupBy("part"))
        .applyInArrow(applied, "part int, marks array<bigint>")
    )


def exact_copies(docs: DataFrame, how: Exchange = Exchange(), id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty, so rows without text are copies
    of each other. Of equal texts one row stays, that of the largest id (a null id is the smallest; of rows with one
    id any one). Nothing is compared but bytes in the end. An empty table gives no rows, other columns are not read.

    A very large group of copies costs a message and a text per partition, and its size and id go to the rows by way
    of partitions too, so no task holds a group.
    """
    spark = for_workers(docs.sparkSession)
    given = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    rows = _dealt(given.mapInArrow(
        _normalised, "part int, at bigint, doc_id bigint, text_sha256 string, text string"))
    count = rows.count()
    owner_bits = max(0, (max(partitions(spark), count // how.owner_rows) - 1).bit_length())
    bits = min(62, max(owner_bits, count.bit_length()) + how.spare_bits)
    marks = _marks(rows, bits, owner_bits).hint("shuffle_hash")

    def suspects(*columns: str) -> DataFrame:
        word = F.get("marks", F.shiftright("at", 6).cast("int"))
        bit = F.getbit(word, F.col("at").bitwiseAND(F.lit(63).cast("bigint")).cast("int"))
        return rows.select("part", "at", *columns).join(marks, "part").filter(bit == 1).drop("marks")

    equal = (
        suspects("doc_id", "text_sha256", "text").groupBy("text_sha256", "text")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "part", "at")).alias("keep"))
        .filter("group_size > 1").drop("text")
    )
    # To the partitions that hold a copy first, then to their rows.
    told = suspects("text_sha256").select("part", "text_sha256").distinct().join(equal, "text_sha256")
    one = F.col("group_size").isNull()
    return (
        rows.select("part", "at", "doc_id", "text_sha256").join(told, ["part", "text_sha256"], "left")
        .select(
            "doc_id",
            F.when(one, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
            (one | ((F.col("keep.part") == F.col("part")) & (F.col("keep.at") == F.col("at")))).alias("kept"),
            "text_sha256",
        )
    )
