"""Byte-level BPE token ids of whole texts, by pre-token.

The public byte-level pattern is applied to all code points of a run of texts at once with
numpy; each distinct pre-token is then encoded once and kept in a table of bounded size, since
most pre-tokens of a corpus repeat.  The ids equal those that the tokenizers library gives for
the whole text.
"""

from __future__ import annotations

import base64
import sys
import unicodedata

import numpy as np

U = np.uint64
# Classes of code points in the pattern 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
#: Code points with the property White_Space (fixed values of Unicode).
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_QUOTED = ("s", "t", "m", "d", "re", "ve", "ll")
_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    global _classes
    if _classes is None:
        first = {"L": _LETTER, "N": _NUMBER}
        _classes = np.fromiter((first.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        _classes[_WHITE] = _SPACE
    return _classes


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of some texts and where each text starts (and the last ends)."""
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return data, np.concatenate([[0], np.cumsum(n)])


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, in order.  A pre-token ends where the next one, or its text, does."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[data]
    head = np.zeros(n + 1, bool)
    head[offsets] = True
    cut = head[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(cut)
    end = np.append(start[1:], n)
    white = kind[start] == _SPACE
    ends_text = head[end]
    # a run of white space before a word leaves its last character; a blank joins the word
    lead = white & ~ends_text
    last = end[lead] - 1
    blank = data[last] == 32
    keep = np.ones(len(start), bool)
    keep[np.flatnonzero(lead)[(end[lead] - start[lead] == 1)]] = False
    joins = np.flatnonzero(lead) + 1
    keep[joins[blank]] = False  # the word starts at the blank instead
    out = np.concatenate([start[keep], last])
    # contractions: an apostrophe that starts a pre-token, and letters of the next run
    quote = start[(data[start] == 39) & (kind[start] == _OTHER) & (end - start == 1)]
    quote = quote[(quote + 1 < n)]
    if len(quote):
        blank_before = (quote > 0) & (data[quote - 1] == 32) & ~head[quote]
        quote = quote[~blank_before & ~head[quote + 1]]
        drop, add = [], []
        for q in quote.tolist():
            tail = data[q + 1 : q + 3].tolist()
            limit = int(offsets[np.searchsorted(offsets, q, "right")])
            for c in _QUOTED:
                if tail[: len(c)] == [ord(x) for x in c] and q + 1 + len(c) <= limit:
                    drop.append(q + 1)
                    after = q + 1 + len(c)
                    if after < limit and kind[after] == _LETTER:
                        add.append(after)
                    break
        if drop:
            out = np.concatenate([np.setdiff1d(out, drop), add])
    return np.unique(out.astype(np.int64))


class Encoder:
    """Ids of texts.  ``path``: ranks of a byte-level BPE vocabulary (tiktoken's format)."""

    def __init__(self, path: str | None = None, pattern: str | None = None, slots: int = 1 << 20):
        import tiktoken

        if path is None:
            import public_tokenizers

            path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.slots = slots
        self._clear()
        self._power = np.ones(1, U)

    def _clear(self):
        self.tag = np.zeros(self.slots, U)
        self.at = np.zeros(self.slots, np.int64)
        self.n = np.zeros(self.slots, np.int32)
        self.ids = np.zeros(1 << 20, np.int32)
        self.used = 0

    def _hash(self, data, start, end):
        n = len(data) + 1
        if len(self._power) < n:
            base = np.full(n, U(0xD6E8FEB86659FD93), U)
            base[0] = 1
            self._power = np.cumprod(base, dtype=U)
            inv = np.full(n, U(pow(0xD6E8FEB86659FD93, -1, 2**64)), U)
            inv[0] = 1
            self._inverse = np.cumprod(inv, dtype=U)
        x = (data.astype(U) + U(1)) * U(0x9E3779B97F4A7C15)
        x ^= x >> U(29)
        x *= self._power[: len(data)]
        sums = np.zeros(n, U)
        np.cumsum(x, out=sums[1:])
        h = (sums[end] - sums[start]) * self._inverse[start] + (end - start).astype(U)
        h ^= h >> U(32)
        h *= U(0xBF58476D1CE4E5B9)
        h ^= h >> U(29)
        return h | U(1)

    def _learn(self, data, h, start, end):
        """Encodes pre-tokens and gives their place in the table of ids."""
        lengths = (end - start).tolist()
        one = self.bpe._core_bpe.encode_single_piece
        raw = data.tobytes()
        found = [one(raw[4 * a : 4 * b].decode("utf-32-le", "surrogatepass").encode("utf-8", "replace")) for a, b in zip(start.tolist(), end.tolist())]
        n = np.fromiter(map(len, found), np.int32, len(found))
        total = int(n.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.int32)])
        at = self.used + np.cumsum(n) - n
        self.ids[self.used : self.used + total] = np.fromiter((i for x in found for i in x), np.int32, total)
        self.used += total
        slot = (h >> U(20)) & U(self.slots - 1)
        self.tag[slot], self.at[slot], self.n[slot] = h, at, n
        return at, n

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code point offsets of the texts, pre-token starts, ends, id counts, ids)."""
        data, offsets = code_points(texts)
        start = boundaries(data, offsets)
        if not len(start):
            z = np.zeros(0, np.int64)
            return offsets, z, z, z, np.zeros(0, np.int32)
        end = np.append(start[1:], len(data))
        return offsets, start, end, *self.found(data, start, end)

    def found(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id counts, ids) of the pre-tokens of some code points."""
        if self.used > 1 << 23:
            self._clear()
        h = self._hash(data, start, end)
        slot = (h >> U(20)) & U(self.slots - 1)
        at, n = self.at[slot], self.n[slot]
        miss = np.flatnonzero(self.tag[slot] != h)
        if len(miss):
            _, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
            first = miss[one]
            a, k = self._learn(data, h[first], start[first], end[first])
            at[miss], n[miss] = a[back], k[back]
        n = n.astype(np.int64)
        total = int(n.sum())
        where = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(total)
        return n, self.ids[where]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text's ids start and the last end)."""
        offsets, start, _, n, ids = self.pieces(texts)
        upto = np.concatenate([[0], np.cumsum(n)])
        return ids, upto[np.searchsorted(start, offsets)]


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None = None, pattern: str | None = None) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, pattern)
    return _encoders[path]


def release() -> None:
    """Forgets the encoders of this Python worker."""
    _encoders.clear()
