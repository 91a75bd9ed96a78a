"""Importance resampling towards a target distribution, with exact ranks from a parallel sort by regular sampling.

Words are hashed into buckets.  What a bucket gains, the logarithm of its share in the target over its share in the
corpus, is an array over the buckets; a document's weight is the mean of that array at its features.  A Gumbel variable drawn from
the document's id is added, so that taking the highest scores draws without replacement in proportion to the weights.

The draw needs exact ranks.  Each task sorts its own rows once and stages the run; regularly spaced rows of all runs give the splitters;
rows are exchanged by segment, each segment is merged within its task, and the counts of the segments before it say at
which rank it starts.  Segments beyond the last rank that is drawn are not exchanged at all.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release, stage, width
from .textvec import Texts, texts

BUCKETS, SEED, PERCENT, LEAST_WORDS = 10_000, 2024, 10, 20
#: Rows that the driver gets to choose splitters from, besides one for each run; a segment holds at most its share of all rows and
#: a run's number times the distance of two of them more.
SAMPLES = 1 << 17
#: Bytes up to which words are hashed together; longer ones are hashed one by one.
_TOGETHER = 64

_LETTER = np.zeros(256, bool)
_LETTER[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC = _crc_table()


def _absorb(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC states (complemented, as they are inside) after the bytes from ``start`` to ``end`` of each span."""
    state, n = state.copy(), end - start
    at = np.flatnonzero(n <= _TOGETHER)
    for k in range(int(n[at].max(initial=0))):
        at = at[n[at] > k]
        state[at] = _CRC[(state[at] ^ data[start[at] + k]) & 255] ^ (state[at] >> 8)
    for i in np.flatnonzero(n > _TOGETHER).tolist():
        state[i] = ~np.uint32(zlib.crc32(data[start[i] : end[i]].tobytes(), int(~state[i])))
    return state


def features(t: Texts, order: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of each run of 1 to ``order`` consecutive words of some whole texts, and the texts' numbers of words.
    A word is a run of digits, letters of ASCII (lower-cased) and bytes beyond it; words of a run are joined by one space."""
    data, off = _LOWER[t.data], t.offsets
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _LETTER[t.data]
    edge = inside[1:] & ~inside[:-1]  # a word starts here
    stop = ~inside[1:] & inside[:-1]  # and ended before here
    cuts = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    both = cuts[inside[cuts] & inside[cuts + 1]]  # no word crosses from a text to the next
    edge[both] = stop[both] = True
    start, end = np.flatnonzero(edge), np.flatnonzero(stop)
    doc = np.searchsorted(off, start, "right") - 1
    n_words = np.bincount(doc, minlength=len(t))
    state = _absorb(np.full(len(start), 0xFFFFFFFF, np.uint32), data, start, end)
    docs, found = [doc], [~state]
    for k in range(1, order):
        here = np.flatnonzero(doc[k:] == doc[:-k]) if len(doc) > k else np.zeros(0, np.int64)
        spaced = _CRC[(state[here] ^ np.uint32(32)) & 255] ^ (state[here] >> 8)
        state[here] = _absorb(spaced, data, start[here + k], end[here + k])  # a run's state stands at its first word
        docs.append(doc[here])
        found.append(~state[here])
    return np.concatenate(docs), np.concatenate(found).astype(np.int64) % buckets, n_words


def _counts(batches: Iterator[pa.RecordBatch], order: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    try:
        for b in batches:
            for t in texts(b.column(0)):
                total += np.bincount(features(t, order, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])
    finally:
        release()


def bucket_counts(docs: DataFrame, text_col: str = "text", order: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all whole texts fall into each bucket.  A task sends its sums only; the driver gets a number for each bucket."""
    one = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(partial(_counts, order=order, buckets=buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in one.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of 1000 times the logarithm of a bucket's smoothed share in the target over that in the corpus."""
    m = len(corpus)
    all_corpus, all_target = float(int(corpus.sum()) + m), float(int(target.sum()) + m)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * all_corpus / ((float(s) + 1) * all_target))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], gain: np.ndarray, order: int) -> Iterator[pa.RecordBatch]:
    try:
        for b in batches:
            n, words, weight = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for t in texts(b.column("__text")):
                doc, bucket, n_words = features(t, order, len(gain))
                rows = slice(t.first, t.first + len(t))
                n[rows] = np.bincount(doc, minlength=len(t))
                words[rows] = n_words
                upto = np.zeros(len(t), np.int64)
                np.add.at(upto, doc, gain[bucket])
                weight[rows] = upto // np.maximum(n[rows], 1)
            yield pa.RecordBatch.from_arrays([b.column("kept"), *map(pa.array, (words, n, weight))], ["kept", "n_words", "n_features", "weight"])
    finally:
        release()


def weights(docs: DataFrame, gain: np.ndarray, text_col: str = "text", keep: list[str] | None = None, order: int = 1) -> DataFrame:
    """(kept, n_words, n_features, weight) of each row: ``kept`` is a struct of the columns ``keep`` (all but the text by default),
    weight the floored mean of the gains of the row's features, 0 without features."""
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    source = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = source.select("kept").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    return source.mapInArrow(partial(_weighed, gain=gain, order=order), schema)


def _segments(batches: Iterator[pa.RecordBatch], splitters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Adds to each row how many splitters are not above it."""
    p = splitters.shape[1]
    for b in batches:
        keys = np.stack([b.column(c).to_numpy() for c in ("__down", "__id", "__at")]) if b.num_rows else np.zeros((3, 0), np.int64)
        both = np.concatenate([splitters, keys], axis=1)
        order = np.lexsort((np.arange(both.shape[1]), both[2], both[1], both[0]))
        upto = np.empty(len(order), np.int64)
        upto[order] = np.cumsum(order < p)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(upto[p:].astype(np.int32))], [*b.schema.names, "__segment"])


def _ranks(batches: Iterator[pa.RecordBatch], before: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Ranks of merged segments: rows come in order, a segment's rows together."""
    last, done = -1, 0
    for b in batches:
        if not b.num_rows:
            continue
        segment = b.column("__segment").to_numpy()
        new = np.concatenate([[segment[0] != last], segment[1:] != segment[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(segment)), 0))
        place = np.arange(len(segment)) - first
        place[segment == last] += done
        last, done = int(segment[-1]), int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before[segment] + place + 1)], [*b.schema.names, "__rank"])


def ranked(rows: DataFrame, score: str, tie: str, drawable: str, share: int = PERCENT) -> DataFrame:
    """``rows`` with ``rank``: of the rows where the boolean ``drawable`` holds, ``share`` percent (rounded down) get 1, 2, 3... by falling
    ``score``, ties by rising ``tie`` (integers, nulls last), rows that agree in both in an arbitrary order that is fixed once; other rows get null.

    Parallel sorting by regular sampling, see the module; equal scores are split by tie and place, so a segment is never longer than
    its share and a run's sample distance says.  An empty table gives an empty result."""
    spark, names = rows.sparkSession, rows.columns
    can = F.coalesce(F.col(drawable), F.lit(False))
    keyed = rows.withColumns({"__down": -F.col(score), "__id": F.coalesce(F.col(tie).cast("long"), F.lit(2**63 - 1)), "__can": can})
    runs = stage(keyed.sortWithinPartitions(F.desc("__can"), "__down", "__id").withColumn("__at", F.monotonically_increasing_id()), "sorted-runs")
    asked = runs.filter("__can")
    n, parts = asked.count(), width(spark)
    most = share * n // 100
    step = max(1, n // SAMPLES)
    sample = asked.filter(F.col("__at").bitwiseAND((1 << 33) - 1) % step == 0).select("__down", "__id", "__at").toArrow()
    found = np.stack([sample.column(c).to_numpy() for c in ("__down", "__id", "__at")]) if sample.num_rows else np.zeros((3, 0), np.int64)
    found = found[:, np.lexsort((found[2], found[1], found[0]))]
    at = np.unique(np.arange(1, parts) * found.shape[1] // parts) if found.shape[1] else np.zeros(0, np.int64)
    splitters = found[:, at]
    schema = T.StructType([*asked.schema, T.StructField("__segment", T.IntegerType())])
    dealt = asked.mapInArrow(partial(_segments, splitters=splitters), schema)
    size = np.zeros(splitters.shape[1] + 1, np.int64)
    for r in dealt.groupBy("__segment").count().collect():  # a row for each segment
        size[r["__segment"]] = r["count"]
    before = np.cumsum(size) - size
    last = int(np.flatnonzero(before < most).max(initial=-1))
    top = dealt.filter(F.col("__segment") <= last).repartitionById(parts, F.col("__segment")).sortWithinPartitions("__segment", "__down", "__id", "__at")
    top = top.mapInArrow(partial(_ranks, before=before), T.StructType([*schema, T.StructField("__rank", T.LongType())]))
    top = top.withColumn("rank", F.when(F.col("__rank") <= most, F.col("__rank")))
    rest = dealt.filter(F.col("__segment") > last).select(*names).unionByName(runs.filter("not __can").select(*names))
    return top.select(*names, "rank").unionByName(rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, order: int = 1, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """(kept, n_features, n_words, weight, score, rank) of every row of ``docs``; ``target`` needs the column ``text_col`` only.

    score is the weight plus the floor of 1000 times a standard Gumbel variable made from ``seed`` and the id.  ``percent`` of the rows with
    ``least_words`` words or more are drawn by falling score, ties to the smaller id; rank is null elsewhere.

    Null and empty texts have no features, weight 0, and are never drawn.  Rows without an id share one random number and come last among equal scores.
    Repeated rows count as often as they are there, in the corpus's counts and in the draw; they have the same score.
    Columns of any names may be in ``keep`` (a struct, all but the text by default).  Empty tables give an empty result; an empty target leaves weights
    that prefer what is rare."""
    gain = gains(bucket_counts(docs, text_col, order, buckets), bucket_counts(target, text_col, order, buckets))
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    inner = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("own"), F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    w = weights(inner, gain, order=order)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("kept.id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    w = w.select("kept.own", "kept.id", "n_words", "n_features", "weight", (F.col("weight") + gumbel).alias("score"), (F.col("n_words") >= least_words).alias("can"))
    out = ranked(w, "score", "id", "can", percent)
    return out.select(F.col("own").alias("kept"), "n_features", "n_words", "weight", "score", "rank")
