"""Distinct word shingles of whole texts as 64-bit hashes, by numpy in tasks.

Words are runs of other bytes than space, tab and line breaks, with A-Z lower-cased.
A text with fewer words than the shingle length has its whole sequence as one
shingle; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20          # bytes hashed at once; segments end at white space
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list = [None, None]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor shifts and odd multiplications)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(n: int):
    if _POWERS[0] is None or len(_POWERS[0]) < n:
        size = max(n, SEGMENT + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def _segment_words(b: np.ndarray, first: np.ndarray):
    """(hash, start) of the words of a byte segment; ``first`` marks text starts
    (one entry more than bytes)."""
    b = np.where((b >= 65) & (b <= 90), b + 32, b).astype(np.uint8)
    word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:len(b)]
    end = word.copy()
    end[:-1] &= ~word[1:] | first[1:len(b)]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _powers(len(b) + 1)
    run = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:-1], out=run[1:])
    return mix((run[e] - run[s]) * down[s] + (e - s).astype(np.uint64)), s


def words(buf: np.ndarray, offsets: np.ndarray):
    """(hash per word, words before each text and in all) for concatenated texts."""
    n = len(buf)
    first = np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    hashes, starts, at = [], [], 0
    while at < n:
        end = min(n, at + SEGMENT)
        if end < n:
            cut = np.flatnonzero((buf[at:end] == 32) | ((buf[at:end] >= 9) & (buf[at:end] <= 13)))
            if len(cut):
                end = at + int(cut[-1]) + 1
            else:                                        # one very long word
                rest = buf[end:]
                cut = np.flatnonzero((rest == 32) | ((rest >= 9) & (rest <= 13)))
                end = end + int(cut[0]) + 1 if len(cut) else n
        h, s = _segment_words(buf[at:end], first[at:end + 1])
        hashes.append(h)
        starts.append(s + at)
        at = end
    h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    s = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return h, np.searchsorted(s, offsets)


def shingle_sets(col, length: int = 5):
    """A list of sorted distinct shingle hashes (uint64), one per text of a slice
    of an Arrow string column; null is the empty text."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None else np.empty(0, np.uint8)
    w, at = words(buf, off - off[0])
    odd = mix(np.arange(1, length + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    if len(w) >= length:
        run = w[:len(w) - length + 1] * odd[0]
        for k in range(1, length):
            run = run + w[k:len(w) - length + 1 + k] * odd[k]
        run = mix(run + np.uint64(length))
    out = []
    for k in range(len(col)):
        a, b = int(at[k]), int(at[k + 1])
        if b - a >= length:
            h = np.sort(run[a:b - length + 1])
            if len(h) > 1:
                fresh = np.empty(len(h), dtype=bool)
                fresh[0] = True
                np.not_equal(h[1:], h[:-1], out=fresh[1:])
                h = h[fresh]
            out.append(h)
        elif b > a:
            out.append(mix((w[a:b] * odd[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def set_id(h: np.ndarray) -> int:
    """A signed 64-bit identity of a set of hashes."""
    s = mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True)
    return int(mix(s + np.uint64(len(h))).view(np.int64)[0])
