"""Numpy helpers over the bytes of a text column: words, span hashes, ragged ranges.

All of them work on one flat byte buffer with document offsets, in segments of
bounded size, so memory follows the batch and not the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 18
_U = np.uint64
_M = 0x9E3779B97F4A7C15  # odd multiplier of the rolling hash
_INV = pow(_M, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits (one to one)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_M, SEGMENT)
_IPOW = _powers(_INV, SEGMENT)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_M))
_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(buffer, offsets) of a string or binary column; null counts as empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
    arr = arr.cast(pa.large_string() if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else pa.large_binary())
    if arr.null_count:
        arr = pc.fill_null(arr, "" if pa.types.is_large_string(arr.type) else b"")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def ragged(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each count c, concatenated."""
    counts = np.asarray(counts, dtype=np.int64)
    total = int(counts.sum())
    return np.arange(total, dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts)


def words(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray = _WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that ``inside`` marks; by
    default ``[^\\x20\\x09-\\x0D]+``) and the words per document."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets) - 1, np.int64)
    inside = inside[buf]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(buf)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = before
    after[-1] = False
    after[:-1] = inside[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    per = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, per


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; ``starts`` and ``ends`` ascend."""
    n = len(starts)
    ps, pe = np.empty(n, np.uint64), np.empty(n, np.uint64)
    inv = np.empty(n, np.uint64)
    if not n:
        return ps
    lo, stop = int(starts[0]), int(ends[-1])
    carry, power, ipower = 0, 1, 1
    i = j = 0
    with np.errstate(over="ignore"):
        while True:
            hi = min(lo + SEGMENT, stop)
            c = np.empty(hi - lo + 1, np.uint64)
            c[0] = 0
            np.cumsum(_BYTE[buf[lo:hi]] * _POW[:hi - lo], out=c[1:])
            final = hi == stop
            i2 = int(np.searchsorted(starts, hi, "right" if final else "left"))
            j2 = int(np.searchsorted(ends, hi, "right" if final else "left"))
            a, b = starts[i:i2] - lo, ends[j:j2] - lo
            ps[i:i2] = c[a] * _U(power) + _U(carry)
            pe[j:j2] = c[b] * _U(power) + _U(carry)
            inv[i:i2] = _IPOW[np.minimum(a, SEGMENT - 1)] * _U(ipower)
            if final:
                break
            carry = (carry + int(c[-1]) * power) & 0xFFFFFFFFFFFFFFFF
            power = power * pow(_M, hi - lo, 1 << 64) & 0xFFFFFFFFFFFFFFFF
            ipower = ipower * pow(_INV, hi - lo, 1 << 64) & 0xFFFFFFFFFFFFFFFF
            lo, i, j = hi, i2, j2
        return mix((pe - ps) * inv + (ends - starts).astype(np.uint64))


def window_hashes(buf: np.ndarray, starts: np.ndarray, width: int, step: int = 1 << 20) -> np.ndarray:
    """Hashes of ``buf[s:s + width]`` for ascending starts, a bounded slice at a time."""
    out = np.empty(len(starts), np.uint64)
    for k in range(0, len(starts), step):
        s = starts[k:k + step]
        out[k:k + step] = span_hashes(buf, s, s + width)
    return out


def shingles(hashes: np.ndarray, per: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words and the runs per document; a
    document with fewer words (but one at least) has its whole sequence as one run."""
    first = np.cumsum(per) - per
    runs = np.where(per >= size, per - size + 1, (per > 0).astype(np.int64))
    at = np.repeat(first, runs) + ragged(runs)
    short = np.repeat(per < size, runs)
    left = np.repeat(per, runs)
    out = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            use = ~short | (left > k)
            nxt = out * _U(_M) + hashes[np.where(use, at + k, 0)] if len(hashes) else out
            out = np.where(use, mix(nxt + _U(k + 1)), out)
    return out, runs


def sorted_unique(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order and how often each occurs."""
    s = np.sort(x)
    if not len(s):
        return s, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    return s[first], np.diff(np.append(first, len(s)))


def member(sorted_set: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each x is in the ascending set."""
    if not len(sorted_set):
        return np.zeros(len(x), bool)
    k = np.searchsorted(sorted_set, x)
    k[k == len(sorted_set)] = 0
    return sorted_set[k] == x


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct values, the first place of each, and the number (int32)
    of each element's value; leaner than numpy's unique with both options."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    inverse = np.empty(len(x), np.int32)
    inverse[order] = np.cumsum(new, dtype=np.int32) - 1
    return s[new], order[new], inverse
