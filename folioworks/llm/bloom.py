"""Blocked Bloom filters over 64-bit hashes, built by Spark and small enough to broadcast.

A hash chooses one block of 512 bits and sets a bit in each of its eight words, so a lookup touches one block. The
number of blocks is the caller's, and with it the bytes that are broadcast; a fuller filter lets more through, never
less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from folioworks.llm.common import for_workers
from folioworks.llm.tokens import mix

LANES = 8
BLOCK_BYTES = 64
_LANES = [f"lane{j}" for j in range(LANES)]


def block_of(hashes: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The block of each hash among ``blocks``, a number or one for each hash, below 2^31."""
    return (((mix(hashes) >> np.uint64(32)) * np.asarray(blocks, np.uint64)) >> np.uint64(32)).astype(np.int64)


def masks_of(hashes: np.ndarray) -> np.ndarray:
    """(hashes, lanes): the bit that a hash has in each word of its block."""
    spread = mix(hashes ^ np.uint64(0x6A09E667F3BCC909))
    shift = np.arange(LANES, dtype=np.uint64) * np.uint64(6)
    return np.uint64(1) << ((spread[:, None] >> shift) & np.uint64(63))


def marked(hashes: DataFrame) -> DataFrame:
    """(block, lane0..7) of a filter from (block, hash), each block once."""
    for_workers(hashes.sparkSession)

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            block, value = (np.asarray(batch.column(c)) for c in range(2))
            order = np.argsort(block, kind="stable")
            block, masks = block[order], masks_of(value.view(np.uint64))[order]
            lead = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            masks = np.bitwise_or.reduceat(masks, lead, axis=0).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[lead]), *(pa.array(np.ascontiguousarray(masks[:, j])) for j in range(LANES))],
                ["block", *_LANES])

    return (
        hashes.select("block", "hash")
        .mapInArrow(set_bits, "block bigint, " + ", ".join(f"{lane} bigint" for lane in _LANES))
        .groupBy("block").agg(*(F.bit_or(lane).alias(lane) for lane in _LANES))
    )


def collected(filter_blocks: DataFrame, first: int, blocks: int) -> np.ndarray:
    """Blocks first to first + blocks of a filter as an array, (blocks, lanes): 64 bytes for each, whatever was put in."""
    rows = filter_blocks.filter(F.col("block").between(first, first + blocks - 1)).toArrow()
    out = np.zeros((blocks, LANES), np.uint64)
    where = rows.column("block").to_numpy() - first
    for j, lane in enumerate(_LANES):
        out[where, j] = rows.column(lane).to_numpy().view(np.uint64)
    return out


def holds(bits: np.ndarray, block: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter, given each one's block."""
    found = np.ones(len(hashes), bool)
    left = np.arange(len(hashes))
    spread = mix(hashes ^ np.uint64(0x6A09E667F3BCC909))
    for j in range(LANES):
        bit = (spread[left] >> np.uint64(6 * j)) & np.uint64(63)
        hit = (bits[block[left], j] >> bit) & np.uint64(1) == 1
        found[left[~hit]] = False
        left = left[hit]
    return found
