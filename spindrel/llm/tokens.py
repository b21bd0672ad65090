"""Vectorised words and hashes over Arrow text columns.

A word is a maximal run of bytes outside space and \\x09-\\x0D; on UTF-8 this is the
same as the code-point rule. Everything here works on whole buffers in numpy, a few
megabytes at a time, so that a batch with very long texts needs bounded memory.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; a longer document is handled alone, in slices.
CHUNK = 1 << 19

WS = np.zeros(256, dtype=bool)
WS[[9, 10, 11, 12, 13, 32]] = True
_U = np.uint64
_MULT = 0x9E3779B97F4A7C55  # odd, so that it has an inverse modulo 2**64
_OTHER = 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (splitmix finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.cache
def _byte_values(lower: bool) -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=np.uint64) * _U(_MULT))
    if lower:
        t[65:91] = t[97:123]
    return t


#: Powers of either multiplier are kept up to this many.
_KEPT = 1 << 20
_powers: dict[tuple[int, bool], np.ndarray] = {}


def powers(n: int, inverse: bool = False, base: int = _MULT) -> np.ndarray:
    """base**i (or its inverse's) modulo 2**64 for i < n."""

    def table(size):
        out = np.full(size, pow(base, -1, 1 << 64) if inverse else base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    if n > _KEPT:
        return table(n)
    have = _powers.get((base, inverse))
    if have is None:
        have = _powers[base, inverse] = table(_KEPT)
    return have[:n]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty texts."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32, count=len(col) + 1 + col.offset)
    offs = offs[col.offset :].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs


def chunks(col: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows with about `size` bytes."""
    if not len(col):
        return
    raw, offs = text_buffers(col)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def _slices(buf: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Parts of a buffer of at most 2 * size bytes, cut after white space where there is some."""
    at, n = 0, len(buf)
    while at < n:
        end = min(n, at + size)
        if end < n:
            hit = np.flatnonzero(WS[buf[end : end + size]])
            if len(hit):
                end += int(hit[0]) + 1
        yield at, end
        at = end


def words(buf: np.ndarray, offs: np.ndarray, lower: bool = False, hashes: bool = True):
    """(document, start, end, hash) of every word, in order; offsets in bytes of `buf`."""
    starts, ends, hs = [], [], []
    table = _byte_values(lower)
    held = None  # start and sum of a word that goes on in the next slice
    for lo, hi in _slices(buf, CHUNK):
        part = buf[lo:hi]
        word = ~WS[part]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        cut = offs[(offs > lo) & (offs < hi)] - lo  # words end where documents do
        first[cut] |= word[cut]
        last[cut - 1] |= word[cut - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        h = np.zeros(len(s), dtype=np.uint64)
        if hashes:
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(table[part] * powers(len(part)), out=sums[1:])
            h = (sums[e] - sums[s]) * powers(len(part), True)[s]
        s, e = s + lo, e + lo
        if held is not None:  # the first word of this slice is the rest of it
            h[:1] = h[:1] * _U(pow(_MULT, lo - held[0], 1 << 64)) + held[1]
            s[0], held = held[0], None
        if hi < len(buf) and word[-1] and not WS[buf[hi]] and offs[np.searchsorted(offs, hi)] != hi:
            held = int(s[-1]), h[-1:].copy()
            s, e, h = s[:-1], e[:-1], h[:-1]
        starts.append(s)
        ends.append(e)
        hs.append(mix(h))
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    e = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
    return np.searchsorted(offs, s, "right") - 1, s, e, h


def windows(doc: np.ndarray, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of first word, Rabin-Karp hash) of every run of k words of one document."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(h * powers(n), out=sums[1:])
    at = np.flatnonzero(doc[: n - k + 1] == doc[k - 1 :])
    return at, mix((sums[at + k] - sums[at]) * powers(n, True)[at] + _U(k))


def more_bits(h: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """32 more bits of the windows at `at`: a second Rabin-Karp hash, of other word values
    and another multiplier."""
    n = len(h)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(h + _U(_OTHER)) * powers(n, base=_OTHER), out=sums[1:])
    return (mix((sums[at + k] - sums[at]) * powers(n, True, _OTHER)[at]) >> _U(32)).astype(np.uint32)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int, lower: bool = True) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its k-word shingles; a document with
    fewer words has one, of its whole sequence; one without words has none."""
    n = len(offs) - 1
    doc, _, _, h = words(buf, offs, lower)
    at, wh = windows(doc, h, k)
    count = np.bincount(doc, minlength=n)
    begin = np.concatenate([[0], np.cumsum(count)])
    wbegin = np.concatenate([[0], np.cumsum(np.maximum(count - k + 1, 0))])
    out = []
    for i in range(n):
        if count[i] >= k:
            out.append(np.unique(wh[wbegin[i] : wbegin[i + 1]]))
        elif count[i]:
            w = h[begin[i] : begin[i + 1]]
            v = (w * powers(len(w))).sum(dtype=np.uint64) + _U(count[i])
            out.append(mix(np.array([v], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
