"""Vectorised words of Arrow text columns.

A text column is one byte buffer with row offsets; words, their hashes and
their shingles come out of a few numpy passes over that buffer, with no
Python object per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2^64
_CHUNK = 1 << 20
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _table(keep) -> np.ndarray:
    return np.array([(b + 32 if 65 <= b <= 90 else b) if keep(b) else 0 for b in range(256)], np.uint8)


#: Lower-cased byte of a word, 0 for a separator: letters, digits and every byte beyond ASCII.
ALNUM = _table(lambda b: b >= 128 or 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    arr = column.fill_null("").cast(pa.large_string())
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    if not len(offs):
        return data[:0], np.zeros(1, np.int64)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, limit: int = 2 << 20):
    """Consecutive row ranges of at most ``limit`` bytes (or one row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over all 64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _grow(n: int):
    if len(_powers["up"]) < n:
        m = max(n, _CHUNK + 1)
        for k, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(m, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def word_spans(data: np.ndarray, cuts: np.ndarray, table: np.ndarray = ALNUM):
    """(low, starts, ends): lower-cased bytes and the word spans; no word
    crosses a position in ``cuts``."""
    n = len(data)
    low = table[data]
    if not n:
        z = np.zeros(0, np.int64)
        return low, z, z
    isw = low != 0
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first = isw.copy()
    first[1:] &= ~isw[:-1]
    first[cuts] = isw[cuts]
    last = isw.copy()
    last[:-1] &= ~isw[1:]
    last[cuts - 1] = isw[cuts - 1]
    return low, np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefixes: tuple = ()):
    """64-bit polynomial hashes of the words, equal for equal words wherever
    they stand.  With ``prefixes`` also, per length, the hashes of the words'
    first bytes (0 where the word is not longer)."""
    out = np.zeros(len(starts), np.uint64)
    pre = [np.zeros(len(starts), np.uint64) for _ in prefixes]
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _CHUNK, "right")))
        seg = low[base:ends[j - 1]].astype(np.uint64)
        up, down = _grow(len(seg))
        sums = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(seg * up[:len(seg)], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s]
        for k, size in enumerate(prefixes):
            ok = e - s > size
            pre[k][i:j][ok] = mix((sums[s[ok] + size] - sums[s[ok]]) * down[s[ok]] + np.uint64(size))
        i = j
    return (mix(out), pre) if prefixes else mix(out)


def shingle_hashes(hashes: np.ndarray, owner: np.ndarray, size: int):
    """(hashes, starts) of every run of ``size`` words inside one owner."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    for j in range(size):
        acc = acc * np.uint64(_BASE) + hashes[j:j + n]
    at = np.flatnonzero(owner[:n] == owner[size - 1:size - 1 + n])
    return mix(acc[at] + np.uint64(size)), at
