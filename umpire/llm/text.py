"""Vectorised word, line and byte hashing over Arrow batches of texts.

A batch's texts lie end to end in one byte buffer.  Prefix sums of
``table[byte] * B^position`` (mod 2^64) give the hash of any byte span as a
difference of two prefix values times ``B^-start``; the sums are taken a
segment at a time, so memory follows the number of spans, not of bytes.
Words are runs of bytes outside space and tab to carriage return; those are
ASCII, so byte runs and character runs are the same in UTF-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SEG = 1 << 18
_MASK = (1 << 64) - 1
GROUP_BYTES = 2 << 20

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_words(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words for ``seed``."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed * 0x632BE59BD9B4E019 & _MASK))


class SpanHasher:
    """64-bit hashes of byte spans; ``fold`` reads A-Z as a-z."""

    def __init__(self, seed: int, fold: bool = False):
        self.table = random_words(seed, 256)
        if fold:
            self.table[65:91] = self.table[97:123]
        self.base = int(random_words(seed + 1, 1)[0]) | 5
        inverse = pow(self.base, -1, 1 << 64)
        self.up = self._powers(self.base, _SEG)
        self.down = self._powers(inverse, _SEG)
        self.down_seg = pow(inverse, _SEG, 1 << 64)

    @staticmethod
    def _powers(b: int, n: int) -> np.ndarray:
        out = np.full(n, b, dtype=U64)
        out[0] = 1
        with np.errstate(over="ignore"):
            return np.cumprod(out, dtype=U64)

    def _prefix_at(self, data: np.ndarray, at: list[np.ndarray]) -> list[np.ndarray]:
        """Prefix sums at sorted positions (each array sorted, up to len)."""
        out = [np.empty(len(p), dtype=U64) for p in at]
        total, n = 0, len(data)
        with np.errstate(over="ignore"):
            for lo in range(0, max(n, 1), _SEG):
                part = self.table[data[lo:lo + _SEG]]
                part *= self.up[:len(part)]
                sums = np.empty(len(part) + 1, dtype=U64)
                sums[0] = 0
                np.cumsum(part, out=sums[1:])
                scale = pow(self.base, lo, 1 << 64)
                last = lo + _SEG >= n
                for p, o in zip(at, out):
                    a = np.searchsorted(p, lo)
                    b = len(p) if last else np.searchsorted(p, lo + _SEG)
                    if b > a:
                        o[a:b] = sums[p[a:b] - lo] * U64(scale) + U64(total)
                total = (total + scale * int(sums[-1])) & _MASK
        return out

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of ``data[s:e]`` per span; starts and ends are each sorted."""
        if len(starts) == 0:
            return np.zeros(0, dtype=U64)
        a, b = self._prefix_at(data, [starts, ends])
        high = np.array([pow(self.down_seg, k, 1 << 64) for k in range(int(starts[-1]) // _SEG + 1)], dtype=U64)
        with np.errstate(over="ignore"):
            h = (b - a) * self.down[starts % _SEG] * high[starts // _SEG]
            return mix(h + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, vals = column.buffers()
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(offs, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(vals, dtype=np.uint8) if vals is not None else np.zeros(0, dtype=np.uint8)
    return data, off


def groups(column: pa.Array, limit: int = GROUP_BYTES):
    """Cut a batch into runs of whole texts of about ``limit`` bytes.

    Yields (first row, end row, bytes, offsets from 0); one text longer than
    the limit is a run of its own.
    """
    data, off = binary(column)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; a text's edge also ends a word."""
    if len(data) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    word = ~IS_SPACE[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = ~word[:-1]
    edge[off] = True
    starts = np.flatnonzero(word & edge[:-1])
    edge[1:-1] = ~word[1:]
    edge[off] = True
    ends = np.flatnonzero(word & edge[1:]) + 1
    return starts, ends


def per_text(starts: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Offsets into the spans for each text: spans ``[k[i], k[i+1])`` are in text i."""
    return np.searchsorted(starts, off)


def runs_of(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbouring hashes (len - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, k):
            out = out * U64(0xD6E8FEB86659FD93) + h[j:j + n]
        return mix(out + U64(k))
