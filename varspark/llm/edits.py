"""Token counts that follow edits.

A document's pre-tokens are grouped into leaves of a segment tree that holds characters and
token ids by subtree.  An edit re-encodes only the leaves it touches, from a pre-token that
ended safely before it to the first old leaf border that is a border again; then the sums on the
path to the root are updated.  Pre-tokens are found from left to right without looking back, so
from such a border on nothing can differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pretokens import Encoder, boundaries, code_points, encoder
from .textvec import texts

#: Pre-tokens of a leaf at first, and characters beyond which a leaf makes the tree be laid out anew.
LEAF, _LONG = 16, 1024
#: Characters after an edit or a cut that a pre-token's end may depend on.
_CONTEXT = 2


class Tree:
    """A segment tree in heap order: ``chars`` and ``ids`` of node i are those of 2i and 2i + 1."""

    def __init__(self, chars: np.ndarray, ids: np.ndarray):
        self.size = 1
        while self.size < len(chars):
            self.size *= 2
        self.chars, self.ids = np.zeros((2, 2 * self.size), np.int64)
        for a, x in ((self.chars, chars), (self.ids, ids)):
            a[self.size : self.size + len(x)] = x
            lo = self.size
            while lo > 1:
                a[lo // 2 : lo] = a[lo : 2 * lo : 2] + a[lo + 1 : 2 * lo : 2]
                lo //= 2

    @property
    def total(self) -> int:
        return int(self.ids[1])

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one with characters, beyond the end) and where it starts."""
        at = min(at, max(0, int(self.chars[1]) - 1))
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.size, start

    def put(self, leaf: int, chars: int, ids: int) -> None:
        node = leaf + self.size
        chars, ids = chars - int(self.chars[node]), ids - int(self.ids[node])
        while node:
            self.chars[node] += chars
            self.ids[node] += ids
            node //= 2

    def leaf_chars(self, leaf: int) -> int:
        return int(self.chars[self.size + leaf])

    def to_bytes(self) -> bytes:
        return np.stack([self.chars[self.size :], self.ids[self.size :]]).tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tree:
        return cls(*np.frombuffer(raw, np.int64).reshape(2, -1))


def trees(enc: Encoder, docs: list[str]) -> list[Tree]:
    """The tree of each text."""
    offsets, start, end, n, _ = enc.pieces(docs)
    edge = np.searchsorted(start, offsets)
    out = []
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if a == b:
            out.append(Tree(np.zeros(1, np.int64), np.zeros(1, np.int64)))
            continue
        first = np.arange(a, b, LEAF)
        out.append(Tree(np.add.reduceat(end[a:b] - start[a:b], first - a), np.add.reduceat(n[a:b], first - a)))
    return out


class Counter:
    """Counts ids of short stretches of text, remembering pre-tokens."""

    def __init__(self, enc: Encoder):
        self.one = enc.bpe._core_bpe.encode_single_piece
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> list[int]:
        data, offsets = code_points([text])
        return boundaries(data, offsets).tolist() + [len(text)]

    def count(self, text: str, borders: list[int]) -> int:
        total = 0
        for a, b in zip(borders[:-1], borders[1:]):
            piece = text[a:b]
            n = self.known.get(piece)
            if n is None:
                if len(self.known) > 200_000:
                    self.known.clear()
                n = self.known[piece] = len(self.one(piece.encode("utf-8", "replace")))
            total += n
        return total


def edit(text: str, tree: Tree, at: int, delete: int, insert: str, counter: Counter) -> tuple[str, Tree, int]:
    """The text after one edit, its tree, and how many characters were encoded again."""
    at = min(max(0, at), len(text))
    delete = min(max(0, delete), len(text) - at)
    new = text[:at] + insert + text[at + delete :]
    first, start = tree.find(max(0, at - _CONTEXT))
    if start and start > at - _CONTEXT - 1:  # the pre-token before ends too near
        first, start = tree.find(start - 1)
    last, last_start = tree.find(at + delete + _CONTEXT)
    end = last_start + tree.leaf_chars(last)
    shift = len(insert) - delete
    while True:
        if end >= len(text):
            stop = len(new)
            stretch = new[start:]
            borders = counter.pieces(stretch)
            break
        stop = end + shift
        stretch = new[start : stop + 64]
        borders = counter.pieces(stretch)
        if stop - start in borders and end >= at + delete + _CONTEXT:
            borders = [b for b in borders if b <= stop - start]
            break
        last, last_start = tree.find(end)
        end = last_start + tree.leaf_chars(last)
    ids = counter.count(stretch, borders)
    for leaf in range(first + 1, last + 1):
        if tree.leaf_chars(leaf):
            tree.put(leaf, 0, 0)
    tree.put(first, stop - start, ids)
    if stop - start > _LONG:  # the leaf has grown: lay the tree out anew from its leaves and these pieces
        chars, n = tree.chars[tree.size :], tree.ids[tree.size :]
        cut = borders[::LEAF] + ([borders[-1]] if (len(borders) - 1) % LEAF else [])
        own = [counter.count(stretch, borders[i : i + LEAF + 1]) for i in range(0, len(borders) - 1, LEAF)]
        keep = chars > 0
        keep[first] = False
        a, b = keep[:first], keep[first + 1 :]
        tree = Tree(
            np.concatenate([chars[:first][a], np.diff(cut), chars[first + 1 :][b]]), np.concatenate([n[:first][a], own, n[first + 1 :][b]])
        )
    return new, tree, stop - start


def token_trees(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` with n_tokens and token_tree (the sums of the leaves).  Null and empty texts have no
    tokens; rows are kept one to one, and columns of these names are replaced."""
    docs = docs.drop("n_tokens", "token_tree")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = encoder(vocabulary, pattern), names.index(text_col)
        for b in batches:
            for t in texts(b.column(at), 1 << 21):
                part = b.slice(t.first, len(t))
                found = trees(enc, [x or "" for x in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x.total for x in found], pa.int64()), pa.array([x.to_bytes() for x in found], pa.binary())], [*names, "n_tokens", "token_tree"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n_tokens long, token_tree binary")


def apply_edits(docs: DataFrame, edits_col: str = "edits", text_col: str = "text", vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """``docs`` (with n_tokens and token_tree) after their edits.

    ``edits_col``: array of (at, delete, insert), applied in order: ``delete`` characters from ``at`` on give
    way to ``insert``.  Positions and lengths beyond the text are cut to it; null arrays, entries and
    fields change nothing.  The text, n_tokens and token_tree are new; n_edits and reencoded_chars are
    added.  A null text is an empty one once something is inserted.
    """
    docs = docs.drop("n_edits", "reencoded_chars")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(encoder(vocabulary, pattern))
        where = {c: names.index(c) for c in (text_col, edits_col, "n_tokens", "token_tree")}
        for b in batches:
            for i in range(0, b.num_rows, 500):
                part = b.slice(i, 500)
                new = {c: [] for c in (text_col, "n_tokens", "token_tree", "n_edits", "reencoded_chars")}
                for text, edits, raw in zip(*(part.column(where[c]).to_pylist() for c in (text_col, edits_col, "token_tree"))):
                    tree, chars, n = Tree.from_bytes(raw), 0, 0
                    for e in edits or ():
                        if e is None or e["at"] is None:
                            continue
                        text, tree, k = edit(text or "", tree, e["at"], e["delete"] or 0, e["insert"] or "", counter)
                        chars, n = chars + k, n + 1
                    for c, v in zip(new, (text, tree.total, tree.to_bytes() if n else raw, n, chars)):
                        new[c].append(v)
                columns = [pa.array(new[c], part.schema.field(c).type) if c in new else part.column(j) for j, c in enumerate(names)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(new["n_edits"], pa.int64()), pa.array(new["reencoded_chars"], pa.int64())], [*names, "n_edits", "reencoded_chars"])

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n_edits long, reencoded_chars long")
