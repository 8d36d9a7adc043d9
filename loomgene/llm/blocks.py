"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Every separator used here is ASCII, so a byte >= 0x80 always belongs to a word and
UTF-8 need not be decoded. A block is a few rows whose texts hold about BLOCK_BYTES
together; one longer text is a block of its own, and is hashed in parts of PART bytes or
words, so that a text of 100 MB takes about five bytes a byte (12 a word, and its bytes twice).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
#: Bytes (or words) whose hashes are computed at once.
PART = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_GRAM = 0xD1342543DE82EF95


def _table(word: bool, ranges: list[tuple[int, int]]) -> np.ndarray:
    t = np.full(256, not word)
    for a, b in ranges:
        t[a : b + 1] = word
    return t


#: True for the bytes of words: runs of anything but space and \x09-\x0D.
SPACED = _table(False, [(0x20, 0x20), (0x09, 0x0D)])
#: True for the bytes of words of ASCII letters, digits and all non-ASCII characters.
ALNUM = _table(False, [(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(batches: Iterator[pa.RecordBatch], col: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(offsets_of(batch.column(batch.schema.get_field_index(col))))
        at, total = 0, 0
        for i, n in enumerate(sizes.tolist()):
            if total and total + n > limit:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += n
        yield batch.slice(at)


def offsets_of(arr: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    return np.frombuffer(arr.buffers()[1], dtype=kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64) if len(arr) else np.zeros(1, np.int64)


def bytes_of(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings (null: empty) and where each begins, one more at the end."""
    if arr.null_count:
        arr = arr.fill_null("")
    offs = offsets_of(arr)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


@lru_cache(maxsize=4)
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64, for i below n."""
    one, inv = np.full(n, base, _U), np.full(n, pow(base, -1, 1 << 64), _U)
    one[:1] = inv[:1] = 1
    return np.multiply.accumulate(one), np.multiply.accumulate(inv)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


def _run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Sums of values[j] * base**(j - start) over each [start, end), from one prefix sum modulo 2**64; at most PART values and 2**16 more."""
    pw, inv = powers(base, PART + (1 << 16))
    sums = np.zeros(len(values) + 1, _U)
    np.cumsum(values * pw[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * inv[starts]


def rolling(values: np.ndarray, k: int, base: int = _GRAM) -> np.ndarray:
    """Rabin-Karp hashes of all runs of k values."""
    n = len(values) - k + 1
    out = np.zeros(max(n, 0), _U)
    for a in range(0, n, PART):
        m = min(PART, n - a)
        at = np.arange(m)
        out[a : a + m] = mix(_run_hashes(values[a : a + m + k - 1], at, at + k, base))
    return out


class Words:
    """starts, ends: byte positions; doc: each word's row; first: each row's first word, one more at the end; hashes: 64 bits a word."""

    def __init__(self, arr: pa.Array, table: np.ndarray, lower: bool):
        raw, self.offsets = bytes_of(arr)
        self.buf = LOWER[raw] if lower else raw
        n = len(raw)
        cuts = self.offsets[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < n)])  # texts follow one another without a gap
        starts, ends = [], []
        for a in range(0, n, PART):
            z = min(a + PART, n)
            inside = np.zeros(z - a + 2, bool)
            inside[max(0, 1 - a) : z - a + 2 - (z == n)] = table[raw[max(a - 1, 0) : z + (z < n)]]
            begin, end = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
            own = cuts[slice(*np.searchsorted(cuts, [a, z]))] - a
            begin[own] = inside[1:-1][own]
            own = cuts[slice(*np.searchsorted(cuts, [a + 1, z + 1]))] - a - 1
            end[own] = inside[1:-1][own]
            starts.append(np.flatnonzero(begin) + a)
            ends.append(np.flatnonzero(end) + a + 1)
        kind = np.int32 if n < 1 << 31 else np.int64
        self.starts, self.ends = (np.concatenate([np.zeros(0, kind), *(y.astype(kind) for y in x)]) for x in (starts, ends))
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(arr), dtype=np.int32), self.counts)
        self.hashes = np.zeros(len(self.starts), _U)
        at = 0
        while at < len(self.starts):
            a = int(self.starts[at])
            to = int(np.searchsorted(self.ends, a + PART, side="right"))
            if to <= at:  # one word longer than a part
                self.hashes[at] = self._long(a, int(self.ends[at]))
                at += 1
                continue
            s, e = self.starts[at:to] - a, self.ends[at:to] - a
            self.hashes[at:to] = mix(_run_hashes(self.buf[a : a + int(e[-1])].astype(_U) + _U(1), s, e, _BASE) + (e - s).astype(_U))
            at = to

    def _long(self, a: int, z: int) -> int:
        total = 0
        for x in range(a, z, PART):
            part = self.buf[x : min(x + PART, z)].astype(_U) + _U(1)
            total += int(_run_hashes(part, np.zeros(1, int), np.array([len(part)]), _BASE)[0]) * pow(_BASE, x - a, 1 << 64)
        return mix(np.array([(total + z - a) % (1 << 64)], _U))[0]

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of k words within one row, and their hashes."""
        h = rolling(self.hashes, k)
        if len(self.counts) == 1 or not len(h):
            return np.arange(len(h)), h
        at = np.flatnonzero(self.doc[: len(h)] == self.doc[k - 1 :])
        return at, h[at]


def covered(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Which of n positions lie in [start, start + length) of any of the spans."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.subtract.at(edge, starts + lengths, 1)
    return np.cumsum(edge[:-1]) > 0


def sums_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values over [first[i], first[i + 1])."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype != bool else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
