"""Harmonic packing of tokenised documents into sequences.

A piece of length x belongs to the reciprocal class k = capacity // x, and a sequence of class k
holds exactly k pieces.  Since documents may be cut anywhere, a piece that would leave much of
its class unused is cut to the exact length of the next class.  Every task fills its own
sequences; the few pieces of sequences that it could not complete go on to fewer tasks.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, tidy
from .pretokens import encoder, release
from .textvec import texts

#: Pieces that one task takes over from others.
_OVER = 15_000
#: Bytes of a run of texts that are encoded together, and rows of an Arrow batch of texts.
_RUN, _BATCH = 1 << 19, 1000
_FIXED = ["start", "length", "ids_crc32", "doc_tokens"]


def cuts(n: np.ndarray, capacity: int, least_fill: float = 0.95) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, start, length) of the pieces of documents with ``n`` ids each."""
    doc, start, length = [], [], []
    full = n // capacity
    d = np.repeat(np.arange(len(n)), full)
    doc.append(d)
    start.append((np.arange(len(d)) - np.repeat(np.cumsum(full) - full, full)) * capacity)
    length.append(np.full(len(d), capacity, np.int64))
    d, at, rest = np.arange(len(n)), full * capacity, n - full * capacity
    while len(d := d[rest > 0]):
        at, rest = at[rest > 0], rest[rest > 0]
        k = capacity // rest
        piece = np.where(k * rest >= least_fill * capacity, rest, capacity // (k + 1))
        doc.append(d)
        start.append(at)
        length.append(piece)
        at, rest = at + piece, rest - piece
    return np.concatenate(doc), np.concatenate(start), np.concatenate(length)


class _Filler:
    """Completes sequences of each class; what is left stays pending, under k pieces a class.  Ids are numbered by round (5
    bits: each has at most half the tasks of the one before, so there are at most 23), task (22) and sequence."""

    def __init__(self, capacity: int, level: int):
        self.capacity, self.pending = capacity, {}
        self.next = ((level << 22) + TaskContext.get().partitionId()) << 36

    def _placed(self, t: pa.Table, k: int) -> pa.Table:
        length = t["length"].to_numpy()
        upto = np.cumsum(length) - length
        offset = upto - np.repeat(upto[::k], k)[: len(upto)]
        ids = self.next + np.arange(len(length)) // k
        self.next = int(ids[-1]) + 1
        return t.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    def add(self, t: pa.Table) -> Iterator[pa.RecordBatch]:
        k = self.capacity // t["length"].to_numpy()
        for c in np.unique(k).tolist():
            x = t.filter(pa.array(k == c))
            if c in self.pending:
                x = pa.concat_tables([self.pending.pop(c), x])
            n = len(x) // c * c
            if n < len(x):
                self.pending[c] = x.slice(n).combine_chunks()
            if n:
                yield from self._placed(x.slice(0, n), c).to_batches()

    def rest(self) -> Iterator[pa.RecordBatch]:
        for x in self.pending.values():
            none = pa.nulls(len(x), pa.int64())
            yield from x.append_column("sequence_id", none).append_column("offset", none).to_batches()

    def rest_together(self) -> Iterator[pa.RecordBatch]:
        """The last pieces of all classes, longest first, each where it fits best."""
        if not self.pending:
            return
        t = pa.concat_tables(self.pending.values()).sort_by([("length", "descending")])
        bins: list[list[int]] = [[] for _ in range(self.capacity + 1)]  # by room left
        ids, offset = [], []
        for x in t["length"].to_pylist():
            room = next((r for r in range(x, self.capacity + 1) if bins[r]), None)
            if room is None:
                room, b = self.capacity, self.next
                self.next += 1
            else:
                b = heapq.heappop(bins[room])
            ids.append(b)
            offset.append(self.capacity - room)
            heapq.heappush(bins[room - x], b)
        yield from t.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset)).to_batches()


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    vocabulary: str | None = None,
    pattern: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``capacity`` ids.

    ``vocabulary``: path of a byte-level BPE vocabulary (default: the public 50k one); each
    document's ids are followed by ``end_id``.  Result, one row for each piece: ``id_col``, start,
    length, ids_crc32 (of the little-endian unsigned 32-bit ids), doc_tokens, sequence_id, offset,
    and ids (array) if ``with_ids``.

    Null and empty texts are ``end_id`` alone; rows without an id are packed too; repeated rows
    are packed each.  A text of any length is cut, never shortened.  An empty table gives none.
    """
    names = [id_col, *_FIXED] + ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids + ", sequence_id long, offset long"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill, enc = _Filler(capacity, 0), encoder(vocabulary, pattern)
        try:
            for b in batches:
                column = b.column(1)
                for t in texts(column, _RUN):
                    part = column.slice(t.first, len(t)).to_pylist()
                    ids, off = enc.encode([x or "" for x in part])
                    n = np.diff(off) + 1
                    upto = np.cumsum(n) - n
                    all_ids = np.full(len(ids) + len(n), end_id, "<i4")
                    all_ids[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n - 1)] = ids
                    doc, start, length = cuts(n, capacity)
                    raw, a = memoryview(all_ids).cast("B"), (upto[doc] + start) * 4
                    crc = [zlib.crc32(raw[x:y]) for x, y in zip(a.tolist(), (a + 4 * length).tolist())]
                    columns = [b.column(0).slice(t.first, len(t)).take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[doc])]
                    if with_ids:
                        where = np.repeat(upto[doc] + start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
                        columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(all_ids[where])))
                    yield from fill.add(pa.Table.from_arrays(columns, names))
            yield from fill.rest()
        finally:  # workers are kept between tasks, and the table is large
            release()

    def again(level: int, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            fill = _Filler(capacity, level)
            for b in batches:
                if b.num_rows:
                    yield from fill.add(pa.Table.from_batches([b]))
            yield from fill.rest_together() if last else fill.rest()

        return run

    done = stage(docs.select(id_col, text_col).mapInArrow(tidy(first), schema), "pieces-0", _BATCH)
    result, level = done.filter("sequence_id is not null"), 1
    left = done.filter("sequence_id is null").drop("sequence_id", "offset")
    tasks = 1 << 23
    while n := -(-left.count() // _OVER):
        n = tasks = min(n, max(1, tasks // 2))  # fewer each time, whatever could be completed
        done = stage(left.repartition(n).mapInArrow(tidy(again(level, n == 1)), schema), f"pieces-{level}")
        result = result.unionByName(done.filter("sequence_id is not null"))
        left = done.filter("sequence_id is null").drop("sequence_id", "offset")
        level += 1
        if n == 1:
            break
    return result
