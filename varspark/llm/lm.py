"""Stupid-backoff scores of documents: n-gram count tables, joined to the documents' n-grams.

Texts are cut into chunks of about 16 MB, which are staged in buckets of their numbers.  A chunk's n-grams are
exploded and counted where they are, so that an n-gram, however frequent, leaves a chunk once.  These (n-gram, n)
rows, packed by the range of the n-gram's hash, meet in the count tables, one range at a time; the tables' totals are
joined back to the chunks by the same rows, and a chunk's words are scored from them and summed by document.

Both joins run within tasks, by numpy over packed rows: Spark deals out and sorts the rows, no n-gram is a row of its own.  ``ngram_counts``
gives the same count tables as plain rows, for other uses; ``backoff_scores`` does not go through it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, release, stage, tidy, width
from .textvec import U, mix, texts, words

#: Bytes of text in a chunk (a longer text is a chunk of its own).
CHUNK = 1 << 24
_BASE = U(0x9E3779B97F4A7C15)
#: Low bytes of the steps between hashes in order, which look random.
_PLAIN = 5
_CHUNKS = "chunk long, tokens long, data binary"
_SUMS = pa.schema([(c, pa.int64()) for c in ("doc", "micro", "words", "backed")])
_ROWS = "chunk long, k int, bucket int, n int, data binary"


def micro(x: np.ndarray) -> np.ndarray:
    """Logarithms in millionths, as integers: sums do not depend on their order."""
    return np.rint(np.log(x) * 1e6).astype(np.int64)


def _squeezed(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), "zstd", asbytes=True)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers as bytes: by planes, which are compressed."""
    parts = []
    for x in arrays:
        wide = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
        planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
        data = _squeezed(np.ascontiguousarray(planes.T))
        parts += [np.array([len(x), wide, len(data)], "<i8").tobytes(), data]
    return b"".join(parts)


def _unpacked(raw: bytes) -> list[np.ndarray]:
    found, at = [], 0
    while at < len(raw):
        n, wide, size = np.frombuffer(raw, "<i8", 3, at).tolist()
        at += 24
        planes = np.frombuffer(pa.decompress(raw[at : at + size], n * wide, "zstd", asbytes=True), np.uint8).reshape(wide, n)
        x = np.zeros((n, 8), np.uint8)
        x[:, :wide] = planes.T
        found.append(x.reshape(-1).view("<u8"))
        at += size
    return found


def _batches(rows: list[tuple], names: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in names.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)], [f for f, _ in fields])


def _chunked(most: int):
    """(id, text) -> chunks: ids, words of each document, the words' hashes and each word's place among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        first = (task.partitionId() if task else 0) << 32
        number, size, held = 0, 0, []

        def closed():
            ids, counts, hashes = (np.concatenate(x) for x in zip(*held))
            known, code, often = np.unique(hashes, return_inverse=True, return_counts=True)
            place = np.empty(len(known), np.int64)
            place[np.argsort(-often, kind="stable")] = np.arange(len(known))  # frequent words have small numbers
            words_ = np.empty(len(known), U)
            words_[place] = known
            return _batches([(first + number, len(hashes), _packed(ids.view(U), counts, words_, place[code]))], _CHUNKS)

        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for t in texts(b.column(1)):
                w = words(t, True)
                held.append((ids[t.first : t.first + len(t)], np.bincount(w.doc, minlength=len(t)), w.hash))
                size += len(t.data)
                if size >= most:
                    yield closed()
                    number, size, held = number + 1, 0, []
        if held:
            yield closed()

    return run


def grams(hashes: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k-grams that end at each word, and whether the document has as many words there (``place``: from 0)."""
    h = hashes
    for _ in range(k - 1):
        h = np.concatenate([hashes[:1], mix(h[:-1] * _BASE + hashes[1:])])
    return h, place >= k - 1


def _opened(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, counts, known, code = _unpacked(raw)
    counts = counts.astype(np.int64)
    place = np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)
    return ids.view(np.int64), counts, known[code.astype(np.int64)], place


def _own(order: int, buckets: int):
    """Chunks -> their own counts: for each order and range of hashes the n-grams in order, and how often each is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, raw in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                _, _, hashes, place = _opened(raw)
                for k in range(1, order + 1):
                    h, there = grams(hashes, place, k)
                    h, n = np.unique(h[there], return_counts=True)
                    if not len(h):
                        continue
                    bucket = ((h >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
                    head = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
                    step = np.diff(h, prepend=h[:1])
                    step[head] = 0
                    step, few, rows = step.astype("<u8").view(np.uint8).reshape(-1, 8), np.minimum(n, 255).astype(np.uint8), []
                    for i, j in zip(head.tolist(), np.append(head[1:], len(h)).tolist()):
                        many = n[i:j][few[i:j] == 255].astype("<i8")
                        # random bytes as they are; what can be made small is
                        high = np.concatenate([few[i:j], np.ascontiguousarray(step[i:j, _PLAIN:].T).ravel(), many.view(np.uint8)])
                        data = h[i : i + 1].tobytes() + np.ascontiguousarray(step[i:j, :_PLAIN]).tobytes() + np.array([len(high)], "<i4").tobytes() + _squeezed(high)
                        rows.append((chunk, k, int(bucket[i]), j - i, data))
                    yield _batches(rows, _ROWS)

    return run


def _counted(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    at = 8 + n * _PLAIN
    high = np.frombuffer(pa.decompress(raw[at + 4 :], int(np.frombuffer(raw, "<i4", 1, at)[0]), "zstd", asbytes=True), np.uint8)
    step = np.empty((n, 8), np.uint8)
    step[:, :_PLAIN] = np.frombuffer(raw, np.uint8, n * _PLAIN, 8).reshape(n, _PLAIN)
    step[:, _PLAIN:] = high[n : n * (9 - _PLAIN)].reshape(8 - _PLAIN, n).T
    h = step.reshape(-1).view("<u8")
    h[0] = np.frombuffer(raw, "<u8", 1, 0)[0]
    count = high[:n].astype(np.int64)
    count[count == 255] = high[n * (9 - _PLAIN) :].copy().view("<i8")
    return np.cumsum(h, dtype=U), count


def _grouped(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows in runs of equal ``by``, of partitions that are sorted by it."""
    last, held = None, []
    for b in batches:
        columns = [b.column(n).to_pylist() for n in b.schema.names]
        keys = zip(*(columns[b.schema.names.index(c)] for c in by))
        for key, row in zip(keys, zip(*columns)):
            if key != last and held:
                yield last, held
                held = []
            last = key
            held.append(row)
    if held:
        yield last, held


def _totals(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The count table of one range: n-grams, their totals, the place in it of each row's n-grams, the rows' edges."""
    got = [_counted(r[4], r[3]) for r in rows]
    known, at = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
    total = np.bincount(at, np.concatenate([g[1] for g in got]), len(known)).astype(np.int64)
    return known, total, at, np.cumsum([0, *(len(g[0]) for g in got)])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count tables, joined to the rows that they were summed from: each chunk gets its n-grams' totals."""
    for (bucket, k), rows in _grouped(batches, ("bucket", "k")):
        _, total, at, edge = _totals(rows)
        yield _batches([(r[0], k, bucket, r[3], _packed(total[at[i:j]])) for r, i, j in zip(rows, edge, edge[1:])], _ROWS)


def _table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (_, k), rows in _grouped(batches, ("bucket", "k")):
        known, total, _, _ = _totals(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(known), k, np.int32)), pa.array(known.view(np.int64)), pa.array(total)], ["k", "gram", "n"])


def _scored(order: int, min_count: int, backoff: float, total: int):
    """A chunk and the totals of its n-grams -> sums by row of its documents."""

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        found = []
        answers = answers.select(["k", "bucket", "data"]).sort_by([("k", "ascending"), ("bucket", "ascending")])
        k_of = answers["k"].to_numpy()
        for raw in chunk["data"].to_pylist():
            ids, counts, hashes, place = _opened(raw)
            seen: list[np.ndarray] = []
            for k in range(1, order + 1):
                h, there = grams(hashes, place, k)
                n = np.zeros(len(h), np.int64)
                own = [_unpacked(x.as_py())[0] for x in answers["data"].filter(pa.array(k_of == k))]
                if own:
                    n[there] = np.concatenate(own)[np.unique(h[there], return_inverse=True)[1]]
                seen.append(n)
            steps, share = np.zeros(len(hashes), np.int8), np.zeros(len(hashes))
            for k in range(order, 1, -1):
                on = (share == 0) & (place >= k - 1)
                hit = np.flatnonzero(on & (seen[k - 1] >= min_count))
                share[hit] = backoff ** steps[hit].astype(float) * (seen[k - 1][hit] / seen[k - 2][hit - 1])
                steps[on] += 1
                steps[hit] -= 1
            rest = share == 0
            share[rest] = backoff ** steps[rest].astype(float) * (seen[0][rest] / max(1, total))
            sums = np.zeros((2, len(ids)), np.int64)
            full = counts > 0
            if full.any():
                head = (np.cumsum(counts) - counts)[full]
                sums[:, full] = [np.add.reduceat(micro(share), head), np.add.reduceat((steps > 0).astype(np.int64), head)]
            found.append(pa.table([ids, sums[0], counts, sums[1]], _SUMS.names))
        release()
        return pa.concat_tables(found) if found else _SUMS.empty_table()

    return run


def _own_counts(chunks: DataFrame, order: int, tokens: int) -> DataFrame:
    """The chunks' own counts, dealt by range of hashes; about a million n-grams of an order are in a range."""
    n = width(chunks.sparkSession)
    own = chunks.mapInArrow(tidy(_own(order, max(2 * n, tokens >> 20))), _ROWS)
    return own.repartition(n, "bucket").sortWithinPartitions("bucket", "k")


def _staged(docs: DataFrame, most: int = CHUNK) -> tuple[DataFrame, int]:
    chunks = bucketed(docs.mapInArrow(tidy(_chunked(most)), _CHUNKS), "lm_chunks", "chunk", batch=1000)
    return chunks, chunks.agg(F.sum("tokens")).first()[0] or 0


def ngram_counts(docs: DataFrame, text_col: str = "text", order: int = 3) -> DataFrame:
    """(k, gram, n): how often each n-gram of 1 to ``order`` words is in all of ``docs``, by its hash."""
    chunks, tokens = _staged(docs.select(F.lit(0).cast("long").alias("id"), F.col(text_col).alias("text")))
    return stage(_own_counts(chunks, order, tokens).mapInArrow(tidy(_table), "k int, gram long, n long"), "lm-counts", batch=8)


def backoff_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = 2, backoff: float = 0.4, order: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Each document's score under the counts of n-grams of up to ``order`` words of all documents.

    Words have A-Z lower-cased.  A word scores c(n-gram) / c(its first n - 1 words) by the longest n-gram that ends
    there within its document and was seen ``min_count`` times, times ``backoff`` for each longer one that was not;
    single words score c(word) / all words.  Result, one row for each id: ``id_col``, n_words, n_backoff (words that
    backed off), log_score (sum of natural logarithms, each rounded to millionths), mean_log_score (null without words).

    Null and empty texts have no words and score 0.  Rows without an id count for the corpus and
    are scored together under a null id.  Rows of one id are scored together.  Texts of any
    length are read whole; an empty table gives an empty result.
    """
    if order < 1:
        raise ValueError("order must be at least 1")
    none = F.lit(-(2**63))  # stands for a null id
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), none).alias("id"), F.col(text_col).alias("text"))
    chunks, tokens = _staged(base, chunk)
    answers = _own_counts(chunks, order, tokens).mapInArrow(tidy(_answers), _ROWS)
    joined = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scored(order, min_count, backoff, tokens), "doc long, micro long, words long, backed long")
    parts = stage(joined, "lm-scores", batch=8)
    sums = parts.groupBy("doc").agg(*(F.sum(x).alias(x) for x in ("micro", "words", "backed")))
    log = F.col("micro") / 1e6
    return sums.select(
        F.when(F.col("doc") != none, F.col("doc")).alias(id_col),
        F.col("words").alias("n_words"),
        F.col("backed").alias("n_backoff"),
        log.alias("log_score"),
        F.when(F.col("words") > 0, log / F.col("words")).alias("mean_log_score"),
    )
