"""Words and shingles of whole texts as numpy arrays, straight from Arrow buffers.

Words are the runs of bytes other than space and ``\\t\\n\\v\\f\\r``.  A word's hash is a
polynomial over a random 64-bit value per byte, taken from prefix sums, so that no word is
ever a Python object.  Equal words have equal hashes in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**64, 256, dtype=U)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = U(pow(int(_BASE), -1, 2**64))
_powers = [np.ones(1, U), np.ones(1, U)]


def _grown(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            x = np.full(n, base, U)
            x[0] = 1
            _powers[i] = np.cumprod(x, dtype=U)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@dataclass
class Texts:
    """Some whole texts: ``data`` holds their UTF-8 bytes, text i from offsets[i] to [i+1]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts(column: pa.Array, most: int = 1 << 20) -> Iterator[Texts]:
    """Cut an Arrow string column into runs of whole texts of about ``most`` bytes together
    (a longer text comes alone).  A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + most, "right")) - 1)
        b = min(b, n)
        yield Texts(a, data[off[a] : off[b]], off[a : b + 1] - off[a])
        a = b


@dataclass
class Words:
    doc: np.ndarray  # the text's number within the run
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray


def words(t: Texts, lower: bool = False) -> Words:
    """All words of some texts in order; no word crosses the border of two texts."""
    data, n = t.data, len(t.data)
    if not n:
        z = np.zeros(0, np.int64)
        return Words(z, np.zeros(0, U), z, z)
    is_word = ~_SEPARATOR[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = is_word[:-1]
    heads = t.offsets[:-1]
    before[heads[heads < n]] = False
    start = np.flatnonzero(is_word & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = is_word[1:]
    tails = t.offsets[1:]
    after[tails[tails > 0] - 1] = False
    end = np.flatnonzero(is_word & ~after) + 1
    power, inverse = _grown(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * power[:n], out=sums[1:])
    h = (sums[end] - sums[start]) * inverse[start]
    doc = np.searchsorted(t.offsets, start, "right") - 1
    return Words(doc, mix(h + (end - start).astype(U)), start, end)


def span_hashes(t: Texts, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of the bytes from ``start`` to ``end`` of each span, as of words."""
    n = len(t.data)
    power, inverse = _grown(n + 1)
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[t.data] * power[:n], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U))


def shingles(t: Texts, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash), sorted and without repeats: the distinct ``k``-word shingles of each
    text, A-Z lower-cased; the whole sequence as one where there are fewer words."""
    w = words(t, lower=True)
    n = len(w.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, U)
    count = np.bincount(w.doc, minlength=len(t))
    first = np.cumsum(count) - count
    doc, total = [], []
    if n >= k:
        ok = np.flatnonzero(w.doc[k - 1 :] == w.doc[: n - k + 1])
        s = np.zeros(len(ok), U)
        for i in range(k):
            s = s * _BASE + w.hash[ok + i]
        doc.append(w.doc[ok])
        total.append(mix(s))
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        s = count[short].astype(U)
        for i in range(k - 1):
            on = count[short] > i
            s[on] = s[on] * _INVERSE + w.hash[first[short[on]] + i]
        doc.append(short)
        total.append(mix(s))
    doc, total = np.concatenate(doc), np.concatenate(total)
    order = np.lexsort((total, doc))
    doc, total = doc[order], total[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (total[1:] != total[:-1])
    return doc[new], total[new]
