"""Whole texts as numpy arrays: bytes, words, and hashes of runs of them, many documents at a time.

The functions work on one Arrow column cut into small pieces, so memory is bounded by the piece or, where
it is larger, by the longest document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# What fills words of 0 to 8 bytes up to 8.
_FILL = np.array([(0xFFFFFFFFFFFFFFFF << 8 * n) & 0xFFFFFFFFFFFFFFFF for n in range(9)], np.uint64)
# Random odd numbers: a value for each byte, and the bases of the polynomials.
_RANDOM = np.random.default_rng(20240229).integers(1, 2**63, 264, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUES = _RANDOM[:256]
_BASES = _RANDOM[256:]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, in place on a fresh array."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        b = int(_BASES[base])
        size = max(n, PIECE + 1)
        both = []
        for x in (b, pow(b, -1, 1 << 64)):
            p = np.full(size, x, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _powers[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


class Runs:
    """Hashes of any runs of a sequence of 64-bit values, by differences of one running sum.

    Only for runs of a few hundred values: two runs of more than a thousand, made of two values in a certain order, have
    equal hashes whatever the base.
    """

    def __init__(self, values: np.ndarray, base: int) -> None:
        up, self.down = _power(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows with about ``limit`` bytes of text; null is empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, where, data = texts.buffers()
    if len(texts) == 0:
        return
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and where the words of each document begin (one more entry than documents)."""
    inner = ~_SPACE[raw]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    begins[cuts] = inner[cuts]
    stops = inner.copy()
    stops[:-1] &= ~inner[1:]
    stops[cuts - 1] = inner[cuts - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A hash of each word, with A-Z lower-cased first if asked for.

    Words of up to eight bytes are numbers as they are, filled up with a byte that text cannot hold, so no two of them
    share a hash. Longer ones have 64 bits of BLAKE2b, taken once per distinct word.
    """
    if lower:
        raw = _LOWER[raw]
    size = ends - starts
    padded = np.concatenate((raw, np.full(8, 0xFF, np.uint8)))
    eight = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))[starts]
    out = mix(eight | _FILL[np.minimum(size, 8)])
    long = np.flatnonzero(size > 8)
    if len(long):
        _, at = within(starts[long], size[long])
        bounds = np.concatenate(([0], np.cumsum(size[long]))).astype(np.int64)
        said = pa.Array.from_buffers(
            pa.large_binary(), len(long), [None, pa.py_buffer(bounds), pa.py_buffer(raw[at])]).dictionary_encode()
        out[long] = strong_hashes(said.dictionary.to_pylist())[np.asarray(said.indices)]
    return out


def strong_hashes(texts: list[bytes]) -> np.ndarray:
    """64-bit hashes without any structure, for texts that are distinct."""
    return np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=8).digest() for t in texts), np.uint64)


def byte_values(raw: np.ndarray) -> np.ndarray:
    return _VALUES[raw]


def within(first: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups that begin at ``first`` and hold ``width`` members: the group and the position of every member."""
    group = np.repeat(np.arange(len(width)), width)
    start = np.cumsum(width) - width
    return group, np.arange(len(group)) - start[group] + first[group]


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each document: sorted hashes, and where each document's begin.

    ``hashes`` are those of words, ``first`` where each document's words begin. A document with fewer words than
    ``width`` has the whole sequence as one shingle, one without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    doc, at = within(first[:-1], count)
    h = Runs(hashes, 1).of(at, at + np.minimum(width, n[doc]))
    order = np.lexsort((h, doc)) if len(doc) else np.zeros(0, np.int64)
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(n) + 1))
