"""Vectorised word work on Arrow string columns.

A word is a run of bytes other than space and 0x09-0x0D. Hashes are 64 bits and equal on every
machine; equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)
SLICE_BYTES = 1 << 20
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the SplitMix64 finaliser)."""
    x = x + STEP
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_codes = np.arange(256)
BREAK = (_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D))
LOWER = np.where((_codes >= 65) & (_codes <= 90), _codes + 32, _codes).astype(np.uint8)
_marks = np.array([c < 128 and not (chr(c).isalnum() or c < 0x20) for c in range(256)])
#: A-Z in lower case and a space for every ASCII punctuation mark.
PLAIN = np.where(_marks, 0x20, LOWER).astype(np.uint8)
BYTE_VALUES = mix(_codes.astype(U64))
PLACES = mix(np.arange(1000, 1000 + SHINGLE, dtype=U64)) | U64(1)
BASE = 0x5851F42D4C957F2D


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


class PlaceValues:
    """Powers of an odd base modulo 2**64 and of its inverse, made as far as a worker needs them."""

    def __init__(self):
        self.up = self.down = np.zeros(0, dtype=U64)

    def __reduce__(self):
        return PlaceValues, ()  # functions sent to workers leave the values behind

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * SLICE_BYTES)
            self.up, self.down = powers(BASE, size), powers(pow(BASE, -1, 1 << 64), size)
        return self.up, self.down


PLACE_VALUES = PlaceValues()


class Words:
    """Words of a slice of texts: ``starts``/``ends`` in ``data``; text i has words bounds[i]:bounds[i+1]."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = ~BREAK[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = offsets[:-1][offsets[:-1] < offsets[1:]]
            first[edges] = inside[edges]
            edges = offsets[1:][offsets[:-1] < offsets[1:]] - 1
            last[edges] = inside[edges]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of every word; ``lower`` folds A-Z first."""
        data = LOWER[self.data] if lower else self.data
        up, down = PLACE_VALUES.upto(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=U64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + (self.ends - self.starts).astype(U64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` (at most five) words, whichever text they belong to."""
    n = max(0, len(hashes) - size + 1)
    total = np.full(n, size, dtype=U64)
    for k in range(size if n else 0):
        total += hashes[k : k + n] * PLACES[k]
    return mix(total)


def shingles_of(hashes: np.ndarray) -> np.ndarray:
    """Hashes of one text's five-word shingles, repeats included; of the whole text if it is shorter."""
    return windows(hashes, min(len(hashes), SHINGLE)) if len(hashes) else hashes


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, offsets) of runs of texts of about ``most`` bytes; NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


#: The eight bits of a byte, one in each byte of a 64-bit value.
_spread = ((np.arange(256, dtype=U64)[:, None] >> np.arange(8, dtype=U64)) & U64(1)) << (np.arange(8, dtype=U64) * U64(8))
LANES = np.bitwise_or.reduce(_spread, axis=1)
TOP_BITS = U64(0x8080808080808080)
ONES = U64(0x0101010101010101)
MOST_WORDS = 255


def bit_lanes(hashes: np.ndarray) -> list[np.ndarray]:
    """Eight arrays whose bytes hold the 64 bits of every hash: sums of up to 255 hashes fit in them."""
    return [LANES[(hashes >> U64(8 * k)).astype(np.uint8)] for k in range(8)]


def majority(sums: list[np.ndarray], n: np.ndarray | int) -> np.ndarray:
    """SimHash of ``n`` (at most 255) hashes from the sums of their lanes: a bit is set if most have it."""
    half = (U64(127) - (np.asarray(n, dtype=U64) >> U64(1))) * ONES
    out = np.zeros(len(sums[0]), dtype=U64)
    for k, lane in enumerate(sums):
        out |= ((lane + half) & TOP_BITS) >> U64(k)
    return out


#: The four bits of half a byte, one in each 16 bits of a 64-bit value.
_spread = ((np.arange(16, dtype=U64)[:, None] >> np.arange(4, dtype=U64)) & U64(1)) << (np.arange(4, dtype=U64) * U64(16))
WIDE_LANES = np.bitwise_or.reduce(_spread, axis=1)
WIDE_TOP_BITS = U64(0x8000800080008000)
WIDE_ONES = U64(0x0001000100010001)
MOST_WORDS_WIDE = 65_535


def wide_lanes(hashes: np.ndarray) -> list[np.ndarray]:
    """Sixteen arrays whose 16-bit parts hold the 64 bits of every hash: sums of up to 65,535 fit in them."""
    return [WIDE_LANES[((hashes >> U64(4 * k)) & U64(15)).astype(np.uint8)] for k in range(16)]


def wide_majority(sums: list[np.ndarray], n: int) -> np.ndarray:
    """As ``majority``, of up to 65,535 hashes from the sums of their wide lanes."""
    half = (U64(32_767) - (U64(n) >> U64(1))) * WIDE_ONES
    out = np.zeros(len(sums[0]), dtype=U64)
    for k, lane in enumerate(sums):
        out |= ((lane + half) & WIDE_TOP_BITS) >> U64(k)
    return out


def as_long(values: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return np.ascontiguousarray(values).view(np.int64)
