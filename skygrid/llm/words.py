"""Words of many texts at once as 64-bit numbers, with numpy inside a task.

A batch of texts is one buffer of bytes with offsets, as Arrow holds it. Word limits and hashes are whole-
array operations on slices of a few megabytes, so memory stays bounded by a slice or by one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls have no bytes."""
    texts = pa.array(texts, pa.string()) if not isinstance(texts, pa.Array) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, off


def slices(off: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``most`` bytes, or a single longer text."""
    at = 0
    while at < len(off) - 1:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield at, to
        at = to


def runs(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that no cut (position) crosses."""
    left = np.empty(len(inside), bool)
    left[0:1] = False
    left[1:] = inside[:-1]
    left[cuts[cuts < len(inside)]] = False
    starts = np.flatnonzero(inside & ~left)
    right = np.empty(len(inside), bool)
    right[-1:] = False
    right[:-1] = inside[1:]
    last = cuts - 1
    right[last[(last >= 0) & (last < len(inside))]] = False
    return starts, np.flatnonzero(inside & ~right) + 1


def hashes(bytes_: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number per span of the bytes."""
    n = len(bytes_)
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers = np.full(n, _STEP, np.uint64)
    powers[0:1] = 1
    powers = np.multiply.accumulate(powers)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[bytes_] * powers, out=total[1:])
    back = np.full(n, _BACK, np.uint64)
    back[0:1] = 1
    back = np.multiply.accumulate(back)
    return mixed((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def words(texts: pa.Array, fold: np.ndarray = LOWER) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of the words, their offsets per row) of successive slices of the texts."""
    data, off = buffers(texts)
    for a, b in slices(off):
        part = fold[data[off[a]:off[b]]]
        cuts = off[a:b + 1] - off[a]
        starts, ends = runs(~BLANK[part], cuts)
        yield a, hashes(part, starts, ends), np.searchsorted(starts, cuts)


def shingles(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every ``size`` successive words; of the whole sequence when there are fewer."""
    n = len(w)
    if n == 0:
        return w
    size = min(size, n)
    out = np.full(n - size + 1, np.uint64(size), np.uint64)
    for j in range(size):
        out = out * _STEP + w[j:n - size + 1 + j]
    return mixed(out)
