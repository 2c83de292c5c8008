"""Word spans and 64-bit word hashes of many texts at once, straight from Arrow's UTF-8 buffers.

A batch of texts is one byte buffer with offsets. Words are runs of bytes outside a delimiter
table; a word's hash is a polynomial over random per-byte values, taken from prefix sums, so no
Python loop runs per word or per byte. Work proceeds in blocks of about ``CHUNK`` bytes; only the
word-level arrays of one text are held whole, however long the text is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_U = np.uint64
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)
_MASK = (1 << 64) - 1

_BYTES = np.arange(256)
#: Bytes of words ``[^\x20\x09-\x0D]+``.
SPACE_WORDS = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased: letters, digits, non-ASCII.
ALNUM_WORDS = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
#: First bytes of code points.
LEAD = (_BYTES & 0xC0) != 0x80


def mix(h: np.ndarray) -> np.ndarray:
    """Final scrambling of 64-bit values (splitmix64)."""
    h = h.astype(_U, copy=True)
    h ^= h >> _U(30)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_LOWER_VALUES = _VALUES.copy()
_LOWER_VALUES[65:91] = _VALUES[97:123]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, _U)
        self.down = np.ones(1, _U)

    def to(self, n: int) -> None:
        while len(self.up) < n:
            m = len(self.up)
            self.up = np.concatenate([self.up, self.up * _U(pow(_R, m, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * _U(pow(_RINV, m, 1 << 64))])


_POWERS = _Powers()


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every other byte as it is."""
    return _LOWER[buf]


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(column, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of texts with about ``limit`` bytes each; a
    text is never cut."""
    buf, off = utf8(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, buf[off[i] : off[j]], off[i : j + 1] - off[i]
        i = j


def spans(buf: np.ndarray, off: np.ndarray, table: np.ndarray = SPACE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word; a word never crosses the end of a text."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = table[buf]
    s = m.copy()
    s[1:] &= ~m[:-1]
    e = m.copy()
    e[:-1] &= ~m[1:]
    first = off[:-1][off[:-1] < off[1:]]
    last = off[1:][off[:-1] < off[1:]] - 1
    s[first] = m[first]
    e[last] = m[last]
    return np.flatnonzero(s), np.flatnonzero(e) + 1


def hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
    """64-bit hash of each span (``fold``: with A-Z lower-cased). Spans are in order."""
    out = np.empty(len(starts), _U)
    values = _LOWER_VALUES if fold else _VALUES
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
        seg = buf[base : int(ends[j - 1])]
        _POWERS.to(len(seg) + 1)
        sums = np.zeros(len(seg) + 1, _U)
        np.cumsum(values[seg] * _POWERS.up[: len(seg)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[b] - sums[a]) * _POWERS.down[a] + (b - a).astype(_U)
        i = j
    return mix(out)


def owners(starts: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Index of the text that each position lies in."""
    return np.searchsorted(off, starts, "right") - 1


def grams(h: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of its first word) of every run of ``n`` words within one text."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[: m] == doc[n - 1 :])
    out = h[at]
    for k in range(1, n):
        out = out * _U(0xD6E8FEB86659FD93) + h[at + k]
    return mix(out), at


def sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Sum of whole numbers by text."""
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64)


def counts(doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, minlength=n).astype(np.int64)


def repeated(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(in a text more than once, not the first in its text) for each key."""
    k = len(key)
    both = np.zeros(k, bool)
    later = np.zeros(k, bool)
    if k < 2:
        return both, later
    order = np.argsort(mix(key + doc.astype(_U) * _U(0xA0761D6478BD642F)), kind="stable")
    a, b = order[:-1], order[1:]
    same = (key[a] == key[b]) & (doc[a] == doc[b])
    both[a[same]] = True
    both[b[same]] = True
    later[b[same]] = True
    return both, later


def crc_mod(ids: pa.Array, m: int) -> np.ndarray:
    """crc32 of each id's decimal text modulo ``m`` (a null id: of the empty text)."""
    return np.fromiter((zlib.crc32(b"" if x is None else str(x).encode()) % m for x in ids.to_pylist()), np.int64, len(ids))
