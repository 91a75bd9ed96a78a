"""Approximate nearest neighbours by a few stable projections and kd-trees.

Vectors get one more component so that the largest inner product is the smallest distance, and
are projected by a random Gaussian matrix to a few dimensions.  A squared projected distance,
over the squared true one, has a chi-square distribution.  So projected neighbours are taken
from a kd-tree by increasing distance and verified on the original vectors, until a projected
distance is so large that a nearer vector would have fallen inside it with probability
``confidence``.

A kd-tree over a bounded sample cuts the projected space into cells; rows of a cell are dealt
into blocks of bounded size, and blocks of neighbouring cells make a part.  A query first searches its
own cell; its k-th distance then tells which other cells the test still reaches.  It goes once to
each part with such cells and keeps its best rows there from block to block, so that what is moved is a
vector for each part and not a block for each group of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_small, least, stage

#: Bounds: vectors that the cells are cut from, rows of a block, queries searched together.  There are as many cells as
#: blocks, as long as the sample has 8 vectors for each.
SAMPLE, BLOCK, CHUNK = 65_536, 4096, 512
#: Parts at least (if there are as many blocks), and bytes of a part's vectors, or of the queries that meet them, at most.
PARTS, PART_BYTES = 32, 16 << 20
#: Bytes of the sample at most, and vectors whatever their length.
SAMPLE_BYTES, _FEWEST = 64 << 20, 1024
_LEAF = 64
#: Powers of two above most vectors' largest components from which a vector is huge.
_HUGE = 10


def chi_square_quantile(p: float, df: int) -> float:
    """The chi-square quantile for an even number of degrees of freedom, by bisection."""
    half = df // 2

    def below(x):
        term = total = np.exp(-x / 2)
        for i in range(1, half):
            term *= x / 2 / i
            total += term
        return 1 - total

    lo, hi = 0.0, 40.0 + 8.0 * df
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def split(points: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """A kd-tree of ``leaves`` (a power of two) by medians along the widest axis: for each inner node,
    heap-ordered, its axis and cut; the rows of each leaf; each leaf's box (low, high)."""
    inner = leaves - 1
    axis, cut = np.zeros(inner, np.int64), np.zeros(inner)
    rows: list[np.ndarray] = [np.arange(len(points))] + [np.zeros(0, np.int64)] * (2 * leaves - 2)
    box = np.empty((2 * leaves - 1, 2, points.shape[1]))
    box[:, 0], box[:, 1] = -np.inf, np.inf
    for i in range(inner):
        r = rows[i]
        if len(r):
            x = points[r]
            a = int(np.argmax(x.max(0) - x.min(0)))
            v = x[:, a]
            c = float(np.median(v))
            right = v > c
            axis[i], cut[i] = a, c
            rows[2 * i + 1], rows[2 * i + 2] = r[~right], r[right]
        for child, side in ((2 * i + 1, 1), (2 * i + 2, 0)):
            box[child] = box[i]
            box[child][side][axis[i]] = cut[i]
    return axis, cut, rows[inner:], box[inner:]


def leaf_of(points: np.ndarray, axis: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node = np.zeros(len(points), np.int64)
    for _ in range(int(np.log2(len(axis) + 1))):
        right = points[np.arange(len(points)), axis[node]] > cut[node]
        node = 2 * node + 1 + right
    return node - len(axis)


def box_distance(points: np.ndarray, box: np.ndarray) -> np.ndarray:
    """Squared distances of points to boxes."""
    d = np.zeros((len(points), len(box)))
    for a in range(points.shape[1]):
        x = points[:, a : a + 1]
        d += np.maximum(0, np.maximum(box[None, :, 0, a] - x, x - box[None, :, 1, a])) ** 2
    return d


def exponent(x: np.ndarray) -> np.ndarray:
    """The power of two just above the largest component of each vector: dividing by it is exact and nothing overflows when squared."""
    return np.frexp(np.abs(x).max(axis=-1))[1]


def scaled(x: np.ndarray, exponents: np.ndarray) -> np.ndarray:
    """Vectors divided by 2 to the ``exponents``."""
    return np.ldexp(x, -exponents[:, None])


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The inner products of each row pair by pair, in double precision as they are; what is not a number (infinities that
    cancel) counts as the least."""
    with np.errstate(over="ignore", invalid="ignore"):
        found = (q * x).sum(-1)
    return np.where(np.isnan(found), -np.inf, found)


class Space:
    """Projection and cells, all of bounded size.

    Vectors are seen in units of 2 to ``unit``, in which most of them have components below one.  Those with components above
    2 to ``unit`` + ``_HUGE`` would spoil the common norm that the projection needs: they make a cell of their own, which every query scans."""

    def __init__(self, dim: int, unit: int, top_norm: float, m: int, confidence: float, seed: int = 17):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.matrix, self.unit, self.top, self.m = rng.normal(size=(dim + 1, m)), unit, top_norm, m
        self.reach = chi_square_quantile(confidence, m)

    def huge(self, x: np.ndarray) -> np.ndarray:
        return exponent(x) > self.unit + _HUGE

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Projections of vectors that are not huge."""
        x = np.ldexp(x, -self.unit)
        last = np.sqrt(np.maximum(self.top**2 - (x**2).sum(1), 0))
        return np.c_[x, last] @ self.matrix

    def queries(self, q: np.ndarray) -> np.ndarray:
        q = scaled(q, exponent(q))
        return (q * (self.top / np.sqrt((q**2).sum(1)))[:, None]) @ self.matrix[:-1]

    def distance2(self, q: np.ndarray, inner: np.ndarray) -> np.ndarray:
        """Squared distances, in units, from inner products with the query as it was given."""
        e = exponent(q)
        norm = np.sqrt((scaled(q, e) ** 2).sum(1))[:, None]
        with np.errstate(over="ignore"):
            inner = np.ldexp(inner, -(e[:, None] + self.unit))
        return np.maximum(2 * self.top**2 - 2 * self.top * inner / norm, 0)

    def overflows(self, q: np.ndarray) -> np.ndarray:
        """Queries so large that inner products may be infinite, and so tie: they scan every cell."""
        return exponent(q) + self.unit + _HUGE + int(np.ceil(np.log2(q.shape[1] + 1))) >= 1023

    def scan(self, q: np.ndarray, bound: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``search``, but every row is compared with every query as it is: best inner products first, ties to the smaller id."""
        at, best = np.full((len(q), k), -1, np.int64), np.full((len(q), k), -np.inf)
        for i in range(len(q)):
            inner = products(q[i], x)
            r = np.lexsort((ids, -inner))[:k]
            at[i, : len(r)], best[i, : len(r)] = r, inner[r]
        return at, best

    def cut(self, sample: np.ndarray, cells: int):
        self.cells = cells
        self.axis, self.cuts, _, self.box = split(self.rows(sample), cells)

    def cell_of(self, x: np.ndarray) -> np.ndarray:
        """The cell of each vector; that of the huge ones comes last."""
        out, huge = np.full(len(x), self.cells, np.int64), self.huge(x)
        if not huge.all():
            out[~huge] = leaf_of(self.rows(x[~huge]), self.axis, self.cuts)
        return out

    def tree(self, x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """A block's kd-tree: the rows of its leaves, and their boxes."""
        p = self.rows(x)
        leaves = 1 << max(0, int(np.ceil(np.log2(max(1, len(x) / _LEAF)))))
        if leaves > 1:
            _, _, rows, box = split(p, leaves)
        else:
            rows, box = [np.arange(len(x))], np.full((1, 2, self.m), np.inf) * np.array([-1, 1])[None, :, None]
        for i, r in enumerate(rows):  # tight boxes
            box[i] = (p[r].min(0), p[r].max(0)) if len(r) else (np.full(self.m, np.inf), np.full(self.m, np.inf))
        return rows, box

    def search(self, q: np.ndarray, bound: np.ndarray, tree: tuple[list[np.ndarray], np.ndarray], x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query its best ``k`` rows of a block (row, or -1; and inner product), as far as the
        test asks for them.  ``bound``: an inner product of which k better ones are known (-inf if not)."""
        e, u = exponent(q), self.unit
        small, xs = scaled(q, e), np.ldexp(x, -u)
        rows, box = tree
        far = box_distance(self.queries(q), np.where(np.isfinite(box), box, 1e18))
        order = np.argsort(far, axis=1)
        near = np.take_along_axis(far, order, 1)
        best, at = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, np.int64)
        active = np.arange(len(q))
        for step in range(len(rows)):
            worst = np.maximum(best[active].min(1), bound[active])
            limit = np.where(worst > -np.inf, self.distance2(q[active], np.where(worst > -np.inf, worst, 0.0)[:, None])[:, 0], np.inf)
            active = active[near[active, step] <= self.reach * limit]
            if not len(active):
                break
            leaf = order[active, step]
            by = np.argsort(leaf, kind="stable")
            edge = np.flatnonzero(np.r_[True, np.diff(leaf[by]) != 0, True])
            for a, b in zip(edge[:-1], edge[1:]):
                who, r = active[by[a:b]], rows[leaf[by[a]]]
                if not len(r):
                    continue
                with np.errstate(over="ignore"):
                    inner = np.ldexp(small[who] @ xs[r].T, (e[who] + u)[:, None])
                found = np.concatenate([best[who], inner], 1)
                ids = np.concatenate([at[who], np.broadcast_to(r, (len(who), len(r)))], 1)
                top = np.argpartition(-found, k - 1, axis=1)[:, :k] if found.shape[1] > k else np.broadcast_to(np.arange(found.shape[1]), found.shape)
                best[who], at[who] = np.take_along_axis(found, top, 1), np.take_along_axis(ids, top, 1)
        return at, best


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _least_ids(most: int):
    """Keeps the ``most`` smallest ids of each vector of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            groups: dict[bytes, list[int]] = {}
            for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                groups.setdefault(raw, []).append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(groups), pa.binary()), pa.array([sorted(set(x))[:most] for x in groups.values()], pa.list_(pa.int64()))], ["raw", "ids"])

    return run


def usable(vectors: DataFrame, id_col: str, vector_col: str, dim: int) -> DataFrame:
    """(id, x): vectors of ``dim`` finite components that are not all zero."""
    x = F.col(vector_col).cast("array<double>")
    ok = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(x, lambda e: e != 0)
    return vectors.filter(F.col(id_col).isNotNull() & (F.size(vector_col) == dim)).filter(ok).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))


def nearest(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    m: int = 8,
    confidence: float = 0.96,
) -> DataFrame:
    """The ``k`` vectors with the largest inner products found for each query.

    ``is_query``: a condition on ``id_col``; queries search all vectors but themselves.  Result:
    query_id, rank (from 1), vec_id, score (inner product in double precision), the nearest first, ties to
    the smaller id.  Vectors that are null, zero, of another length than most, or with null or
    non-finite components take no part; rows without an id neither.  Components may be of any finite size: vectors that are a thousand times larger than most
    are compared with every query as they are; an inner product beyond double precision is infinite, one that is not a number counts as the least.  Repeated ids with equal
    vectors are one row; an id with several different vectors is one query and one candidate, with the vector whose
    bytes come first.  Copies of a vector are searched once, for any number of them.  Fewer
    than ``k`` candidates give as many rows; no query or an empty table gives none.
    """
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    sizes = vectors.filter(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return spark.createDataFrame([], out)
    dim = sizes["n"]
    good = usable(vectors, id_col, vector_col, dim)
    kind = np.dtype(np.float32 if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else np.float64)

    def unpacked(raw: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(raw), kind).reshape(-1, dim).astype(np.float64)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = (_matrix(b.column(1), dim) + 0.0).astype(kind)  # no negative zeros
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "raw"])

    rows = stage(good.mapInArrow(packed, "id long, raw binary").groupBy("id").agg(F.min("raw").alias("raw")), "ann-rows")
    # copies: each distinct vector with its smallest ids, gathered in two steps
    ids = rows.mapInArrow(_least_ids(k + 1), "raw binary, ids array<long>")
    merge = lambda c: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), 1, k + 1)
    ids = ids.groupBy("raw", F.pmod(F.xxhash64("ids"), F.lit(64)).alias("salt")).agg(merge("ids").alias("ids")).groupBy("raw").agg(merge("ids").alias("ids"))
    ids = stage(ids.withColumn("uid", F.element_at("ids", 1)), "ann-distinct")

    most = max(_FEWEST, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    sample = least(ids.select("raw", F.xxhash64("raw").alias("h")), F.col("h"), most).select("raw").toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], out)
    sample = unpacked(sample.column(0).to_pylist())
    unit = int(np.median(exponent(sample)))

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = unpacked(b.column(0).to_pylist())
                fit = np.ldexp(x[exponent(x) <= unit + _HUGE], -unit)
                yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt((fit**2).sum(1).max(initial=0)))]), pa.array([len(x)]), pa.array([len(x) - len(fit)])], ["norm", "n", "huge"])

    top, n, n_huge = ids.select("raw").mapInArrow(norms, "norm double, n long, huge long").agg(F.max("norm"), F.sum("n"), F.sum("huge")).first()
    space = Space(dim, unit, max(top, 1e-3), m, confidence)
    cells = 1 << int(max(0, min(np.ceil(np.log2(n / BLOCK)), np.log2(max(1, len(sample) / 8)))))
    space.cut(sample[~space.huge(sample)], cells)
    sent = spark.sparkContext.broadcast(space)
    salts = max(1, -(-2 * n // (cells * BLOCK)))  # blocks of a cell, and those of the huge vectors behind them
    n_blocks = cells * salts + -(-2 * n_huge // BLOCK)
    n_parts = min(n_blocks, max(PARTS, -(-n * dim * kind.itemsize // PART_BYTES)))
    edges = -(-np.arange(n_parts + 1) * n_blocks // n_parts)  # the first block of each part
    from_cell, to_cell = np.minimum(edges[:-1] // salts, cells), np.minimum((edges[1:] - 1) // salts, cells)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            cell = s.cell_of(unpacked(b.column(1).to_pylist()))
            dealt = b.column(0).to_numpy() * 2654435761 >> 7
            block = cell * salts + dealt % np.where(cell < cells, salts, max(1, n_blocks - cells * salts))
            part = block * n_parts // n_blocks
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(cell), pa.array(block), b.column(0), b.column(1)], ["part", "cell", "block", "uid", "raw"])

    places = stage(ids.select("uid", "raw").mapInArrow(placed, "part long, cell long, block long, uid long, raw binary"), "ann-places")
    asked = rows.filter(is_query(F.col("id")))
    asked = stage(join_small(ids.select("raw", "uid"), asked, "raw", "inner").select("id", "uid", "raw"), "ann-queries")
    distinct = stage(asked.dropDuplicates(["uid"]).select("uid", "raw"), "ann-asked")
    n_chunks = max(1, -(-distinct.count() * dim * kind.itemsize // PART_BYTES))
    if n_chunks > 1:
        places = places.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    else:
        places = places.withColumn("chunk", F.lit(0))

    def reached(s: Space, q: np.ndarray, bound: np.ndarray, box: np.ndarray) -> np.ndarray:
        """Which cells of these boxes each query still has to search."""
        limit = np.where(bound > -np.inf, s.distance2(q, np.where(bound > -np.inf, bound, 0.0)[:, None])[:, 0], np.inf)
        return (box_distance(s.queries(q), box) <= s.reach * limit[:, None]) | s.overflows(q)[:, None]

    def to_parts(own: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            s = sent.value
            for whole in batches:
                for at in range(0, whole.num_rows, CHUNK):
                    b = whole.slice(at, CHUNK)
                    q = unpacked(b.column(1).to_pylist())
                    home, each = leaf_of(s.queries(q), s.axis, s.cuts), np.arange(len(q))
                    cell = np.zeros((len(q), cells + 1), bool)
                    if own:
                        cell[each, home] = True
                    else:
                        cell[:, :-1] = reached(s, q, b.column(2).to_numpy(zero_copy_only=False), s.box)
                        cell[:, -1] = True  # huge vectors are scanned by all
                        cell[each, home] = False
                    upto = np.c_[np.zeros(len(q), np.int64), cell.cumsum(1)]
                    i, part = np.nonzero(upto[:, to_cell + 1] > upto[:, from_cell])
                    take = pa.array(i)
                    yield pa.RecordBatch.from_arrays([pa.array(part), *(c.take(take) for c in b.columns)], ["part", "uid", "raw", "bound"])

        return run

    def searched(own: bool):
        none = np.iinfo(np.int64).max

        def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
            s, found = sent.value, []
            if vectors.num_rows and queries.num_rows:
                vectors = vectors.sort_by([("block", "ascending"), ("uid", "ascending")])
                blocks, their, raw = vectors["block"].to_numpy(), vectors["uid"].to_numpy(), vectors["raw"]
                queries = queries.sort_by("uid")
                uid, q, least_known = queries["uid"].to_numpy(), unpacked(queries["raw"].to_pylist()), queries["bound"].to_numpy().copy()
                home, wide = leaf_of(s.queries(q), s.axis, s.cuts), s.overflows(q)
                top, ids_ = np.full((len(q), k + 1), -np.inf), np.full((len(q), k + 1), none)
                edge = np.flatnonzero(np.r_[True, np.diff(blocks) != 0, True])
                for a, z in zip(edge[:-1], edge[1:]):
                    cell, x, other = int(vectors["cell"][a].as_py()), unpacked(raw.slice(a, z - a).to_pylist()), their[a:z]
                    tree = None if cell == cells else s.tree(x)
                    for at in range(0, len(q), CHUNK):
                        who = np.arange(at, min(at + CHUNK, len(q)))
                        who = who[(home[who] == cell) == own]
                        if not own and cell < cells and len(who):
                            who = who[reached(s, q[who], least_known[who], s.box[cell : cell + 1])[:, 0]]
                        for who, plain in ((who[wide[who] | (tree is None)], True), (who[~wide[who] & (tree is not None)], False)):
                            if not len(who):
                                continue
                            bound = least_known[who]
                            row, best = s.scan(q[who], bound, other, x, k + 1) if plain else s.search(q[who], bound, tree, x, k + 1)
                            with np.errstate(over="ignore", invalid="ignore"):
                                slack = 1e-9 * np.abs(bound) + np.ldexp(1e-9, np.minimum(exponent(q[who]) + s.unit, 1000))
                                kept = np.where(np.isfinite(bound), bound - slack, bound)
                            i, j = np.nonzero((row >= 0) & (best >= kept[:, None]))
                            score, new = np.full(row.shape, -np.inf), np.full(row.shape, none)
                            score[i, j] = products(q[who[i]], x[row[i, j]])  # each pair alone, so equal in every block
                            new[i, j] = other[row[i, j]]
                            score, new = np.c_[top[who], score], np.c_[ids_[who], new]
                            first = np.lexsort((new, -score), axis=-1)[:, : k + 1]
                            top[who], ids_[who] = np.take_along_axis(score, first, 1), np.take_along_axis(new, first, 1)
                            full = ids_[who, k] != none
                            least_known[who] = np.where(full, np.maximum(bound, top[who, k]), bound)
                i, j = np.nonzero(ids_ != none)
                found = [uid[i], ids_[i, j], top[i, j]]
            kinds = [pa.int64(), pa.int64(), pa.float64()]
            return pa.table([pa.array(c, t) for c, t in zip(found or [[]] * 3, kinds)], ["uid", "other", "score"])

        return run

    def run(queries: DataFrame, own: bool, name: str) -> DataFrame:
        chunk = F.pmod(F.xxhash64("uid"), F.lit(n_chunks)).cast("int")
        sent_to = queries.mapInArrow(to_parts(own), "part long, uid long, raw binary, bound double").withColumn("chunk", chunk)
        both = [d.repartition(4 * n_parts * n_chunks, "part", "chunk").groupBy("part", "chunk") for d in (places, sent_to)]
        return stage(both[0].cogroup(both[1]).applyInArrow(searched(own), "uid long, other long, score double"), f"ann-found-{name}")

    best_first = Window.partitionBy("uid").orderBy(F.desc("score"), "other")
    first = run(distinct.withColumn("bound", F.lit(float("-inf"))), True, "own")
    bound = first.withColumn("at", F.row_number().over(best_first)).filter(F.col("at") == k + 1).select("uid", F.col("score").alias("bound"))
    known = distinct.join(bound, "uid", "left").select("uid", "raw", F.coalesce("bound", F.lit(float("-inf"))).alias("bound"))
    second = run(known, False, "others")
    found = first.unionByName(second).withColumn("at", F.row_number().over(best_first)).filter(F.col("at") <= k + 1)
    # the copies of what was found, and then each query without itself
    copies = join_small(found.select("uid", "other", "score"), ids.select(F.col("uid").alias("other"), "ids"), "other", "inner", 0)
    each = copies.select("uid", "score", F.explode("ids").alias("vec_id"))
    ranked = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    each = each.withColumn("at", F.row_number().over(ranked)).filter(F.col("at") <= k + 1).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("at", "vec_id", "score"))).alias("top"))
    one = asked.select("id", "uid").distinct().join(stage(each, "ann-top"), "uid")
    top_k = F.slice(F.filter("top", lambda t: t["vec_id"] != F.col("id")), 1, k)
    result = one.select(F.col("id").alias("query_id"), F.posexplode(top_k).alias("pos", "t"))
    return result.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"))
