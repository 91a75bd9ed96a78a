"""A quality classifier: random-indexing word vectors, pooled per document, under a small network.

Random indexing: each hashed token has a fixed sparse ternary index vector; a token's word
vector adds up the index vectors of its neighbours over the whole corpus.  The tasks count into
matrices of fixed size, which are summed by block.  Documents are means of word vectors; a
two-layer numpy network with a temperature fitted on rows of its own turns them into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import least, release, stage, tidy
from .textvec import U, Texts, mix, texts

BUCKETS = 1 << 15
DIM = 64
_NONZERO = 4
_BLOCK = 512  # buckets in one row of partial sums
#: Labelled rows that the network is fitted on at most.
MOST_LABELS = 20_000
#: Bytes of a run of texts whose tokens are held together.
_RUN = 1 << 19

_CLASS = np.full(256, 1, np.uint8)  # letters, and all bytes of other scripts
_CLASS[[32, 9, 10, 11, 12, 13]] = 0
_CLASS[48:58] = 2
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _CLASS[_a:_b] = 3
_BYTE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**64, 256, dtype=U)
_BASE = U(0xD1342543DE82EF95)
_INVERSE = U(pow(int(_BASE), -1, 2**64))
_PRIOR = 4.0
_UPPER, _REPEAT = 1, 2  # marks with buckets of their own


def _index() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(11))
    return rng.integers(0, DIM, (BUCKETS, _NONZERO)), rng.choice(np.array([-1.0, 1.0]), (BUCKETS, _NONZERO))


_AT, _SIGN = _index()
_powers = [np.ones(1, U), np.ones(1, U)]


def tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of each token: runs of letters, digits or signs, and after them a mark for
    a token all in capitals and for one that equals the one before."""
    data, n = t.data, len(t.data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(_powers[0]) <= n:
        for i, base in enumerate((_BASE, _INVERSE)):
            x = np.full(n + 1, base, U)
            x[0] = 1
            _powers[i] = np.cumprod(x, dtype=U)
    kind = _CLASS[data]
    cut = np.ones(n + 1, bool)
    cut[1:n] = kind[1:] != kind[:-1]
    cut[t.offsets] = True
    edge = np.flatnonzero(cut)
    start, end = edge[:-1], edge[1:]
    on = kind[start] > 0
    start, end = start[on], end[on]
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[data] * _powers[0][:n], out=sums[1:])
    h = mix((sums[end] - sums[start]) * _powers[1][start] + (end - start).astype(U))
    doc = np.searchsorted(t.offsets, start, "right") - 1
    capital = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
    upper = (capital[end] - capital[start] == end - start) & (end - start > 1)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    bucket = (h >> U(64 - 15)).astype(np.int64)
    bucket = np.where(bucket < 8, bucket + 8, bucket)  # the first are kept for marks
    order = np.concatenate([np.arange(len(h)), np.flatnonzero(upper) + 0.3, np.flatnonzero(again) + 0.6])
    bucket = np.concatenate([bucket, np.full(int(upper.sum()), _UPPER), np.full(int(again.sum()), _REPEAT)])
    doc = np.concatenate([doc, doc[upper], doc[again]])
    at = np.argsort(order, kind="stable") if len(order) > len(h) else slice(None)
    return doc[at], bucket[at]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for b in batches:
        for t in texts(b.column(0), _RUN):
            doc, bucket = tokens(t)
            if not len(doc):
                continue
            total = np.zeros(BUCKETS * DIM) if total is None else total
            near = np.flatnonzero(doc[1:] == doc[:-1])
            for a, c in ((near, near + 1), (near + 1, near)):
                at = (bucket[a] * DIM)[:, None] + _AT[bucket[c]]
                total += np.bincount(at.ravel(), _SIGN[bucket[c]].ravel(), BUCKETS * DIM)
    if total is not None:
        rows = total.reshape(-1, _BLOCK * DIM)
        used = np.flatnonzero(rows.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array([rows[i].astype("<i8" if abs(rows[i]).max() >= 2**31 else "<i4").tobytes() for i in used.tolist()], pa.binary())], ["block", "sums"])


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for block, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x = np.frombuffer(raw, "<i8" if len(raw) == 8 * _BLOCK * DIM else "<i4").astype(np.int64)
            total[block] = total[block] + x if block in total else x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["block", "sums"])


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """BUCKETS x DIM word vectors of a whole corpus: 8 MB, whatever the corpus's size."""
    spark = docs.sparkSession
    few = 4 * spark.sparkContext.defaultParallelism  # fewer tasks, fewer partial matrices
    parts = docs.select(text_col).coalesce(few).mapInArrow(tidy(_contexts), "block int, sums binary")
    whole = parts.repartition(BUCKETS // _BLOCK, "block").mapInArrow(tidy(_sum_blocks), "block int, sums binary")
    out = np.zeros((BUCKETS, DIM), np.float32)
    for r in whole.collect():  # block by block: the driver holds one matrix
        c = np.frombuffer(r["sums"], "<i8").reshape(_BLOCK, DIM).astype(np.float64)
        out[r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = c / np.maximum(np.sqrt((c**2).sum(1, keepdims=True)), 1e-9)
    for j in range(_NONZERO):
        np.add.at(out, (np.arange(BUCKETS), _AT[:, j]), 0.5 * _SIGN[:, j])
    release()
    return out


def pooled(t: Texts, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of each text's word vectors, and how many there are."""
    doc, bucket = tokens(t)
    out, count = np.zeros((len(t), vectors.shape[1]), np.float32), np.zeros(len(t), np.int64)
    if len(doc):
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        out[doc[first]] = np.add.reduceat(vectors[bucket], first, axis=0)
        count[doc[first]] = np.diff(np.r_[first, len(doc)])
    return out, count


def means(sums: np.ndarray, count: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """Mean word vectors, as if each text had _PRIOR tokens more of the usual kind: a text of a word
    or two says little."""
    return (sums + _PRIOR * usual) / (count + _PRIOR)[:, None]


@dataclass
class Network:
    """Two layers; ``score`` gives calibrated probabilities of label 1."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0
    usual: np.ndarray | float = 0.0  # the mean word vector of texts

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) * self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 5) -> Network:
    """Adam on the rows outside ``calibrate``; the temperature is fitted on those inside."""
    x, y = x.astype(np.float64), y.astype(np.float64)
    net = Network(x.mean(0) if len(x) else np.zeros(DIM), np.ones(x.shape[1]), np.zeros((x.shape[1], hidden)), np.zeros(hidden), np.zeros(hidden), 0.0)
    share = y.mean() if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        net.b2 = 30.0 * (2 * share - 1)
        return net
    rng = np.random.Generator(np.random.PCG64(seed))
    net.scale = 1 / np.maximum(x.std(0), 1e-3)
    w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.array(np.log(share / (1 - share)))]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    train = np.flatnonzero(~calibrate) if len(set(y[~calibrate])) == 2 else np.arange(len(y))
    z = (x - net.mean) * net.scale
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(train), max(1, len(train) // 128)):
            a = np.tanh(z[rows] @ w[0] + w[1])
            p = 1 / (1 + np.exp(-np.clip(a @ w[2] + w[3], -30, 30)))
            d = (p - y[rows]) / len(rows)
            da = np.outer(d, w[2]) * (1 - a * a)
            grads = [z[rows].T @ da + 1e-4 * w[0], da.sum(0), a.T @ d + 1e-4 * w[2], d.sum()]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = w[0], w[1], w[2], float(w[3])
    if calibrate.any():
        logit, t = net.logit(x[calibrate]), y[calibrate]

        def loss(temperature):
            s = logit / temperature
            return np.mean(np.logaddexp(0, s) - t * s)

        net.temperature = float(min(np.geomspace(0.25, 8, 81), key=loss))
    return net


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(id_col).cast("string")) % 4


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_LABELS) -> Network:
    """Fits the network on at most ``most`` labelled documents whose fold is not 2; fold 3 calibrates.  Of rows of one id with
    different texts or labels the least counts."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != 2))
    known = known.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"), fold(id_col).cast("int").alias("__fold"), F.xxhash64(F.col(id_col)).alias("__h"))
    known = known.groupBy("__id").agg(*(F.min(c).alias(c) for c in ("__label", "__fold", "__h")))
    # labels with a document: one for each id, so that the bound holds for what is fitted
    known = stage(known.join(docs.select(F.col(id_col).alias("__id")), "__id", "left_semi"), "known-labels")
    chosen = F.broadcast(least(known, F.col("__h"), most).drop("__h"))  # at most this many rows
    rows = docs.join(chosen, docs[id_col] == F.col("__id")).select(F.col("__id").cast("long").alias("id"), "__label", "__fold", F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts(b.column(3), _RUN):
                x, n = pooled(t, sent.value)
                yield pa.RecordBatch.from_arrays([*(b.column(i).slice(t.first, len(t)) for i in range(3)), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(n)], ["id", "label", "fold", "x", "n"])

    own = rows.mapInArrow(tidy(run), "id long, label int, fold int, x binary, n long")
    own = own.groupBy("id").agg(F.min(F.struct("label", "fold", "x", "n")).alias("r")).select("id", "r.*")  # repeated rows count once
    got = own.toArrow().to_pydict()
    order = np.lexsort((np.array(got["x"], object), np.array(got["label"], int), np.array(got["id"], int))) if got["id"] else []
    x = np.array([np.frombuffer(got["x"][i], np.float32) for i in order]).reshape(-1, DIM)
    y, f, n = (np.array([got[c][i] for i in order], int) for c in ("label", "fold", "n"))
    usual = (x[n > 0] / n[n > 0, None]).mean(0) if (n > 0).any() else np.zeros(DIM)
    net = fit(means(x, n, usual), y, f == 3)
    net.usual = usual
    return net


def score(docs: DataFrame, vectors: np.ndarray, net: Network, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, by the text alone; a column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast((vectors, net))
    docs = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text_col)
        for b in batches:
            vectors, net = sent.value
            found = [net.score(means(*pooled(t, vectors), net.usual)) for t in texts(b.column(at), _RUN)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.concatenate(found) if found else np.zeros(0))], [*names, "score"])

    names = docs.columns
    return docs.mapInArrow(tidy(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``docs`` with score: the probability of label 1 by the whole text.

    Word vectors are counted over all of ``docs``; the network learns from at most MOST_LABELS labelled rows,
    none of fold 2.  Null and empty texts get the score of a text without tokens; rows without an
    id are scored; repeated rows score alike; labels that are null or have no document are passed
    over.  Without labels of both kinds every score is near their share (0.5 if there are none).
    """
    vectors = word_vectors(docs, text_col)
    net = train(docs, labels, vectors, id_col, text_col, label_col)
    release()
    return score(docs, vectors, net, text_col)
