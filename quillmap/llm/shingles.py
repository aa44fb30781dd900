"""Sets of hashed word shingles, for whole batches of texts."""

from __future__ import annotations

import numpy as np

from ._common import mix64

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_VALUE_LOWER, _INK = _VALUE[_LOWER], bytes((~_SPACE).view(np.uint8))
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_ODD = mix64(np.arange(1000, 1064, dtype=np.uint64)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        _POWERS[base] = _powers(base, max(n, 1 << 16))
    return _POWERS[base][:n]


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """A 64-bit hash of each word of A-Z lower-cased bytes between white space, at which word each text starts (n + 1), and the words' starts and ends."""
    n = len(raw)
    if not n:
        none = np.empty(0, np.int64)
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    ink = np.frombuffer(raw.tobytes().translate(_INK), bool)
    edge = np.zeros(n, bool)  # first bytes of texts end a word before them
    inner = offsets[1:-1]
    edge[inner[inner < n]] = True
    start = ink.copy()
    start[1:] &= ~ink[:-1] | edge[1:]
    end = ink.copy()
    end[:-1] &= ~ink[1:] | edge[1:]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    total = np.zeros(n + 1, np.uint64)
    value = _VALUE_LOWER.take(raw)
    value *= _power(_BASE, n)
    np.cumsum(value, out=total[1:])
    h = (total[e] - total[s]) * _power(_INVERSE, n)[s]
    return mix64(h + (e - s).astype(np.uint64) * _ODD[63]), np.searchsorted(s, offsets), s, e


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_spans(raw, offsets)[:2]


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int, chunk: int = 1 << 20) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's k-word shingles; of fewer words, of the whole sequence; of none, nothing."""
    out: list[np.ndarray] = []
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + chunk, side="right")) - 1)
        w, at = word_hashes(raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        rolled = np.zeros(max(0, len(w) - k + 1), np.uint64)
        for j in range(k):
            rolled += w[j : j + len(rolled)] * _ODD[j]
        rolled = mix64(rolled + np.uint64(k))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(rolled[a : b - k + 1]))
            elif b > a:
                out.append(mix64((w[a:b] * _ODD[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
            else:
                out.append(np.empty(0, np.uint64))
        lo = hi
    return out
