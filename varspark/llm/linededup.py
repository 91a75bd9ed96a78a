"""Line deduplication over a whole corpus.

Line keys are hashed and range-partitioned by (hash, document, position), so a frequent line
may fill many partitions: the ranges are cut within a hash as well.  Each partition is streamed
once in that order and reports the repeated lines it can see, besides its first and last hash;
what crosses a border is settled from those reports alone.  The result is a compressed keep
bitmap for each document: texts are not moved to decide.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, tidy, width

#: The white space that is stripped from a line's ends to get its key.
STRIPPED = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ORDER = ["h1", "h2", "doc", "pos"]


def _split(text_col: str):
    return F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int = 10) -> DataFrame:
    """(doc, rid, pos, h1, h2): each line whose key has ``min_chars`` code points or more.

    ``rid`` tells apart rows of one id with different texts; the key's hash has 128 bits.
    """
    lines = docs.filter(F.col(id_col).isNotNull() & (F.length(text_col) >= min_chars)).select(
        F.col(id_col).cast("long").alias("doc"),
        F.xxhash64(text_col).alias("rid"),
        F.posexplode(_split(text_col)).alias("pos", "line"),
    )
    key = F.translate(F.btrim("line", F.lit(STRIPPED)), _UPPER, _UPPER.lower())
    lines = lines.filter(F.length("line") >= min_chars).select("doc", "rid", "pos", key.alias("key"))
    return lines.filter(F.length("key") >= min_chars).select(
        "doc", "rid", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key", F.length("key")).alias("h2")
    )


_SEEN = "kind int, h1 long, h2 long, doc long, rid long, pos int"
_DROP, _BORDER, _HEAD = 0, 1, 2


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads one range in order.  Emits each line of a later document (_DROP), the first and the
    last hash with the first document seen here (_BORDER), and the lines of that document at the
    first hash (_HEAD): an earlier range may hold an earlier document."""

    def out(kind, h1, h2, doc, rid, pos):
        n = len(doc)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), *(pa.array(np.ascontiguousarray(x, t)) for x, t in ((h1, np.int64), (h2, np.int64), (doc, np.int64), (rid, np.int64), (pos, np.int32)))],
            ["kind", "h1", "h2", "doc", "rid", "pos"],
        )

    head = last = None
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, doc, rid, pos = (b.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "doc", "rid", "pos"))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        holder = doc[np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))]
        if last is not None and last[:2] == (h1[0], h2[0]):
            later = np.flatnonzero(new[1:])
            holder[: later[0] + 1 if len(later) else len(new)] = last[2]
        if head is None:
            head = (h1[0], h2[0], holder[0])
            yield out(_BORDER, [head[0]], [head[1]], [head[2]], [0], [0])
        last = (h1[-1], h2[-1], holder[-1])
        drop = doc != holder
        yield out(_DROP, h1[drop], h2[drop], doc[drop], rid[drop], pos[drop])
        at = (h1 == head[0]) & (h2 == head[1]) & (doc == head[2])
        if at.any():
            yield out(_HEAD, h1[at], h2[at], doc[at], rid[at], pos[at])
    if last is not None:
        yield out(_BORDER, [last[0]], [last[1]], [last[2]], [0], [0])


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(doc, rid, pos) of each line whose key a document with a smaller id holds as well."""
    keys = stage(line_keys(docs, id_col, text_col, min_chars), "line-keys")
    ranges = keys.repartitionByRange(width(docs.sparkSession), *_ORDER).sortWithinPartitions(*_ORDER)
    seen = stage(ranges.select(*_ORDER, "rid").mapInArrow(tidy(_stream), _SEEN), "line-ranges")
    first = seen.filter(F.col("kind") == _BORDER).groupBy("h1", "h2").agg(F.min("doc").alias("holder"))
    late = seen.filter(F.col("kind") == _HEAD).join(first, ["h1", "h2"]).filter("doc <> holder")
    return seen.filter(F.col("kind") == _DROP).select("doc", "rid", "pos").unionByName(late.select("doc", "rid", "pos"))


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The compressed bitmap of each row from its number of lines and the positions that go."""
    for b in batches:
        lines, dropped = b.column("n_lines").to_pylist(), b.column("dropped")
        at = dropped.offsets.to_numpy() if len(dropped) else np.zeros(1, np.int32)
        gone = dropped.values.to_numpy(zero_copy_only=False) if len(dropped) else np.zeros(0, np.int32)
        out = []
        for i, n in enumerate(lines):
            bits = np.ones(n, np.uint8)
            bits[gone[at[i] : at[i + 1]]] = 0
            out.append(zlib.compress(np.packbits(bits).tobytes()))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "rid", "n_lines", "n_dropped")), pa.array(out, pa.binary())], ["key", "rid", "n_lines", "n_dropped", "keep_bitmap"])


def _kept_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bitmap which lines stay, as an array of booleans."""
    for b in batches:
        bits = [np.unpackbits(np.frombuffer(zlib.decompress(raw), np.uint8), count=n) for raw, n in zip(b.column("keep_bitmap").to_pylist(), b.column("n_lines").to_pylist())]
        upto = np.cumsum([0, *map(len, bits)]).astype(np.int32)
        flat = pa.array(np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool))
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("key", "rid", "n_dropped")), pa.ListArray.from_arrays(pa.array(upto), flat)], ["key", "rid", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Which lines of each document stay, as a compressed bitmap.

    A line's key is the line without white space at its ends and with A-Z lower-cased.  Keys of
    ``min_chars`` code points or more that several documents hold stay in the one with the
    smallest id only (there in all lines).  Result, one row for each row of ``docs``: ``id_col``,
    ``rid`` (hash of the text), n_lines, n_dropped, keep_bitmap (zlib of packed bits, 1: keep).

    Null and empty texts are one empty line, which stays.  Rows without an id lose nothing and
    take nothing from others.  Repeated rows share their fate; rows of one id with different
    texts count as the same document.  An empty table gives an empty result.
    """
    gone = repeated_lines(docs, id_col, text_col, min_chars)
    gone = gone.groupBy("doc", "rid").agg(F.collect_set("pos").alias("dropped"))
    base = docs.select(F.col(id_col), F.xxhash64(text_col).alias("rid"), F.size(_split(text_col)).cast("long").alias("n_lines"))
    on = (base[id_col] == gone["doc"]) & (base["rid"] == gone["rid"])
    dropped = F.coalesce("dropped", F.array().cast("array<int>"))
    found = base.join(gone, on, "left").select(base[id_col].alias("key"), base["rid"], "n_lines", F.size(dropped).cast("long").alias("n_dropped"), dropped.alias("dropped"))
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    made = found.mapInArrow(tidy(_bitmaps), f"key {kind}, rid long, n_lines long, n_dropped long, keep_bitmap binary")
    return made.withColumnRenamed("key", id_col)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` reduced to the lines its bitmap keeps (joined by a line feed;
    null becomes empty), and with n_lines and n_dropped (columns of these names are replaced)."""
    kind = bitmaps.select(id_col).schema[0].dataType.simpleString()
    some = bitmaps.filter("n_dropped > 0").dropDuplicates([id_col, "rid"]).select(F.col(id_col).alias("key"), "rid", "n_lines", "n_dropped", "keep_bitmap")
    some = some.mapInArrow(tidy(_kept_lines), f"key {kind}, rid long, n_dropped long, keep array<boolean>")
    some = some.withColumnsRenamed({"key": "__id", "rid": "__rid", "keep": "__keep", "n_dropped": "__dropped"})
    kept = docs.join(some, (docs[id_col] == some["__id"]) & (F.xxhash64(docs[text_col]) == some["__rid"]), "left")
    whole = F.coalesce(docs[text_col], F.lit(""))
    reduced = F.array_join(F.filter(F.split(whole, "\n", -1), lambda line, i: F.get("__keep", i)), "\n")
    text = F.when(F.col("__keep").isNull(), whole).otherwise(reduced)
    return kept.select(
        *(text.alias(c) if c == text_col else docs[c] for c in docs.columns if c not in ("n_lines", "n_dropped")),
        F.size(F.split(whole, "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce("__dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )
