"""Exact similarity join on word shingles: universe partition and pigeonhole.

Sets whose sizes fall in one band, or in two neighbouring ones, share a scheme: a hash puts each
shingle into one of its segments.  Similar sets differ in at most H shingles, so of any H + 1
segments that are not empty in one of them, at least one is equal in both.  Each set is indexed
by the signatures of its segments' subsets.  What to look up is allocated by cost: a segment with
a short list is looked up as it is; a frequent one is left out while H + 1 others remain.  Of sets
that are left short of segments the frequent lists are followed where few such sets are in them; the
rest get one-deletion neighbourhoods, which count for two, and again the cheapest that suffice.
All candidates are verified on their whole sets.

Equal sets are one class from the start.  Links within a large group of near copies are found from its
first member and from neighbours in order; a list whose members are in one component already
costs nothing, and any other is followed up exactly, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_small, release, stage, tidy, width
from .components import components
from .textvec import U, mix, shingles, texts

#: Lists of up to so many sets give all their pairs.
SHORT = 10
#: Segments of a scheme, as a multiple of the H + 1 that must not be empty.
_SPARE = 1.12
_SALT = U(0x632BE59BD9B4E019)
#: Rows of an Arrow batch of texts or sets.
_BATCH = 1000
#: Bytes of a run of texts whose shingles are held together.
_RUN = 1 << 19


def most_errors(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The largest symmetric difference of similar sets of sizes ``a`` and ``b``."""
    least = -(-percent * (a + b) // (100 + percent))
    return a + b - 2 * least


@lru_cache
def bands(percent: int, top: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """First and last size of each band; a set is similar to none beyond the next band."""
    first, last = [], []
    a = 1
    while a < top:
        b = a * 100 // percent
        first.append(a)
        last.append(b)
        a = b + 1
    return np.array(first), np.array(last)


@lru_cache
def segments(percent: int) -> np.ndarray:
    """How many segments each band's scheme has.  Its sets lie in the band or in the next."""
    last = bands(percent)[1].astype(np.float64)
    ratio = (100 - percent) / percent
    return np.ceil(_SPARE * (last * ratio + 1)).astype(np.int64) + 2


def needed(size: np.ndarray, band: np.ndarray, role: int, percent: int) -> np.ndarray:
    """H + 1 for a set of this size: role 0 in its own band's scheme, where partners are up to
    100 / percent times as large; role 1 in the scheme below, with that band's sets only."""
    last = bands(percent)[1]
    if role == 0:
        partner = size * 100 // percent
    else:
        partner = np.where(band > 0, last[np.maximum(band - 1, 0)], 1)
        partner = np.minimum(partner, size)
    # H falls by 1 where the least intersection steps up, and never over two steps: the largest H
    # is at the largest partner or at the one before
    most = np.maximum(most_errors(size, partner, percent), 0)
    before = np.where(100 * (partner - 1) >= percent * size, most_errors(size, partner - 1, percent), 0)
    return np.maximum(most, before) + 1


def _subsets(doc: np.ndarray, h: np.ndarray, size: np.ndarray, role: int, percent: int):
    """For each set of a run (``doc`` sorted, ``size`` per set): (set, signature) of the subsets that
    are not empty, and for each shingle its subset's place in that order."""
    first, _ = bands(percent)
    band = np.searchsorted(first, size, "right") - 1
    scheme = band - role
    m = np.where(scheme >= 0, segments(percent)[np.maximum(scheme, 0)], 0)
    m[size == 0] = 0
    base = np.cumsum(m) - m
    on = m[doc] > 0
    key = base[doc[on]] + ((mix(h[on] ^ (_SALT * (scheme[doc[on]] + 1).astype(U))) >> U(32)).astype(np.int64) * m[doc[on]] >> 32)
    total = np.zeros(int(m.sum()), U)
    np.add.at(total, key, mix(h[on] + _SALT))
    count = np.bincount(key, minlength=len(total))
    full = np.flatnonzero(count)
    owner = np.repeat(np.arange(len(m)), m)[full]
    place = mix(scheme[owner].astype(U) * U(1 << 40) + (full - base[owner]).astype(U))
    at = np.cumsum(count > 0) - 1
    return owner, total[full] + place, at[key], on, place


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


_INDEX, _SETS = 0, 1


def _index(percent: int, k: int, buckets: int):
    """Texts -> (bucket, kind, n, data).  Kind _INDEX holds runs of signatures by set, kind _SETS the
    size, the identity and the spare segments of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for t in texts(b.column(1), _RUN):
                doc, h = shingles(t, k)
                own = ids[t.first : t.first + len(t)].astype(np.int64)
                size = np.bincount(doc, minlength=len(t))
                identity = np.zeros(len(t), U)
                np.add.at(identity, doc, mix(h ^ _SALT))
                identity = mix(identity + size.astype(U))
                band = np.searchsorted(bands(percent)[0], size, "right") - 1
                rows, spare = [], []
                # equal sets of a run are indexed once, under the smallest id
                order = np.lexsort((own, identity))
                lead = np.ones(len(t), bool)
                lead[order[1:]] = identity[order[1:]] != identity[order[:-1]]
                for role in (0, 1):
                    owner, sig, *_ = _subsets(doc, h, size, role, percent)
                    have = np.bincount(owner, minlength=len(t))
                    spare.append(have - needed(size, band, role, percent))
                    use = lead[owner]
                    owner, sig = owner[use], mix(sig[use])
                    bucket = (sig >> U(40)) % U(buckets)
                    order = np.argsort(bucket, kind="stable")
                    owner, sig, bucket = owner[order], sig[order], bucket[order]
                    edge = np.searchsorted(bucket, np.arange(buckets + 1))
                    for i in np.flatnonzero(np.diff(edge)).tolist():
                        o, s = owner[edge[i] : edge[i + 1]], sig[edge[i] : edge[i + 1]]
                        head = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
                        n = np.diff(np.r_[head, len(o)]).astype(np.uint32)
                        rows.append((i, _INDEX, len(head), role, _pack(own[o[head]], identity[o[head]], n, s)))
                rows.append((int(identity[0] % U(buckets)), _SETS, len(t), 0, _pack(own, size.astype(np.int64), identity, spare[0].astype(np.int64), spare[1].astype(np.int64))))
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["bucket", "kind", "n", "role", "data"])

    return run


_FOUND = "kind int, a long, b long, c long, d long, e long"
_SET, _PAIR, _MEMBER = 0, 1, 2


def _rows(kind: int, *columns) -> pa.RecordBatch:
    n = len(columns[0])
    full = [np.asarray(c).astype(np.int64) if np.asarray(c).dtype != U else np.asarray(c).view(np.int64) for c in columns]
    full += [np.zeros(n, np.int64)] * (5 - len(full))
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *(pa.array(c) for c in full)], ["kind", *"abcde"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition of the index -> sets as they are; candidate pairs; members of long lists."""
    sigs, owners, identities, roles = [], [], [], []
    for b in batches:
        for kind, n, role, data in zip(*(b.column(c).to_pylist() for c in ("kind", "n", "role", "data"))):
            if kind == _SETS:
                x = np.frombuffer(data, np.int64).reshape(5, n)
                yield _rows(_SET, *x)
                continue
            head = np.frombuffer(data, np.int64, 2 * n)
            count = np.frombuffer(data, np.uint32, n, 16 * n)
            owners.append(np.repeat(head[:n], count))
            identities.append(np.repeat(head[n:], count))
            sigs.append(np.frombuffer(data, U, -1, 20 * n) if 20 * n % 8 == 0 else np.frombuffer(data[20 * n :], U))
            roles.append(np.full(len(sigs[-1]), role, np.int8))
    if not sigs:
        return
    sig = np.concatenate(sigs)
    del sigs
    order = np.argsort(sig, kind="stable")
    sig = sig[order]
    same = np.zeros(len(sig), bool)
    same[1:] = sig[1:] == sig[:-1]
    same[:-1] |= same[1:]
    order, sig = order[same], sig[same]
    owner, identity, role = np.concatenate(owners)[order], np.concatenate(identities)[order], np.concatenate(roles)[order]
    # one entry for each class of equal sets, under its smallest id
    at = np.lexsort((owner, identity, sig))
    sig, owner, identity, role = sig[at], owner[at], identity[at], role[at]
    one = np.ones(len(sig), bool)
    one[1:] = (sig[1:] != sig[:-1]) | (identity[1:] != identity[:-1])
    sig, owner, role = sig[one], owner[one], role[one]
    at = np.lexsort((owner, sig))
    sig, owner, role = sig[at], owner[at], role[at]
    start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
    n = np.diff(np.r_[start, len(sig)])
    if len(start):  # sets of the upper band alone meet in their own scheme
        mine = np.repeat(np.minimum.reduceat(role, start) == 0, n)
        sig, owner, role = sig[mine], owner[mine], role[mine]
        start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, np.int64)
        n = np.diff(np.r_[start, len(sig)])
    size = np.repeat(n, n)
    head = np.repeat(start, n)
    place = np.arange(len(sig)) - head
    left, right, shared = [], [], []
    for d in range(1, SHORT):  # all pairs of short lists
        i = np.flatnonzero((size <= SHORT) & (place + d < size))
        i = i[(role[i] == 0) | (role[i + d] == 0)]
        left.append(i)
        right.append(i + d)
        shared.append(np.ones(len(i), np.int64))
    long = np.flatnonzero((size > SHORT) & (place > 0))  # of others the first, and neighbours
    left += [head[long], long - 1]
    right += [long, long]
    shared += [np.zeros(2 * len(long), np.int64)]
    i, j, shared = map(np.concatenate, (left, right, shared))
    keep = owner[i] != owner[j]
    i, j, shared = i[keep], j[keep], shared[keep]
    pair = np.lexsort((role[j], role[i], owner[j], owner[i]))
    a, b, roles, shared = owner[i][pair], owner[j][pair], (2 * role[i] + role[j])[pair].astype(np.int64), shared[pair]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (roles[1:] != roles[:-1])]) if len(a) else np.zeros(0, np.int64)
    if len(first):
        times = np.diff(np.r_[first, len(a)])
        short_ = np.add.reduceat(shared, first)
        for x in range(0, len(first), 200_000):
            f = slice(x, x + 200_000)
            yield _rows(_PAIR, a[first[f]], b[first[f]], roles[first[f]], short_[f], (times - short_)[f])
    member = np.flatnonzero(size > SHORT)
    for x in range(0, len(member), 200_000):
        i = member[x : x + 200_000]
        yield _rows(_MEMBER, sig[i], owner[i], role[i])


def sets_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(doc, identity, shingles) of the documents in ``ids`` (doc), as sorted 64-bit hashes."""
    some = join_small(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")), ids, "doc", "left_semi", 500_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in texts(b.column(1), _RUN):
                doc, h = shingles(t, k)
                edge = np.searchsorted(doc, np.arange(len(t) + 1))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, len(t)), pa.array([h[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:])], pa.binary())], ["doc", "shingles"])

    return some.mapInArrow(tidy(run), "doc long, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y"))
    n, m = F.octet_length("x"), F.octet_length("y")
    both = pairs.join(left, "a").join(right, "b").filter((100 * n >= percent * m) & (100 * m >= percent * n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                z = np.concatenate([x, y])
                z.sort(kind="stable")
                common = int((z[1:] == z[:-1]).sum())
                ok.append(100 * common >= percent * (len(z) - common))
            ok = np.array(ok, bool)
            yield pa.RecordBatch.from_arrays([pa.array(b.column(i).to_numpy()[ok]) for i in (0, 1)], ["a", "b"])

    return both.select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long").distinct()


def _with_totals(rows: DataFrame, key: str, pieces: int, once: list[str] | None = None, **totals: tuple) -> DataFrame:
    """``rows`` with aggregates of all rows of their key: total=(aggregate, column).  Rows of a key travel once, as lists; of a
    key's rows, ``pieces`` lists are made, so that no list holds more than a share of a frequent key.  With ``once`` the key does not matter: of
    lists with equal totals that agree in these columns one is left, and lists are dealt out evenly, whatever their keys."""
    how = {"count": (F.count, F.sum), "min": (F.min, F.min), "max": (F.max, F.max)}
    parts = [how[f][0](F.lit(1) if c is None else F.col(c)).alias(t) for t, (f, c) in totals.items()]
    members = F.collect_list(F.struct(*(c for c in rows.columns if c != key))).alias("__rows")
    if pieces == 1:
        lists = rows.groupBy(key).agg(*parts, members)
    else:
        first = rows.groupBy(key, F.pmod(F.xxhash64("doc"), F.lit(pieces)).alias("__piece")).agg(*parts, members)
        whole = first.groupBy(key).agg(*(how[f][1](t).alias(t) for t, (f, _) in totals.items()))
        lists = first.select(key, "__rows").join(whole, key)
    if once:
        kept = F.array_sort(F.transform("__rows", lambda r: F.struct(*(r[c].alias(c) for c in once))))
        return lists.select(*totals, kept.alias("__rows")).distinct().select(*totals, F.inline("__rows"))
    return lists.select(key, *totals, F.inline("__rows"))


#: Rows of lists for which one more piece of a frequent key is made.
_PIECE = 1_000_000


def _neighbourhoods(percent: int, k: int, single: bool):
    """(doc, shingles, roles, component) -> (doc, role, need, segment, deletion, sig, component): signatures of subsets and of
    subsets less one shingle.  ``single``: each shingle is a segment of its own, and there are no deletions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, component = b.column(0).to_numpy(), b.column(3).to_numpy()
            for i, (raw, roles) in enumerate(zip(b.column(1), b.column(2).to_pylist())):
                h = np.frombuffer(raw.as_buffer(), U)
                size, doc = np.array([len(h)]), np.zeros(len(h), np.int64)
                band = int(np.searchsorted(bands(percent)[0], len(h), "right") - 1)
                for role in sorted(roles):
                    if band < role or not len(h):
                        continue
                    need = int(needed(size, np.array([band]), role, percent)[0])
                    if single:
                        sig = mix(h + _SALT * U(band - role + 1))
                        seg, deletion = np.arange(len(h)), np.zeros(len(h), bool)
                    else:
                        _, full, at, _, _ = _subsets(doc, h, size, role, percent)
                        sig = np.concatenate([full, full[at] - mix(h + _SALT)])
                        seg = np.concatenate([np.arange(len(full)), at])
                        deletion = np.arange(len(sig)) >= len(full)
                    n = len(sig)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, ids[i])), pa.array(np.full(n, role, np.int32)), pa.array(np.full(n, need)), pa.array(seg.astype(np.int64)), pa.array(deletion), pa.array(sig.view(np.int64)), pa.array(np.full(n, component[i]))],
                        ["doc", "role", "need", "segment", "deletion", "sig", "component"],
                    )

    return run


def _followed(open_: DataFrame, sets: DataFrame, comp: DataFrame, percent: int, k: int, single: bool) -> tuple[DataFrame, DataFrame]:
    """Groups (hub, doc, component) that hold all similar sets of different components among those of
    ``open_`` (doc, role), which looked up too little before: by the cheapest sufficient allocation; and
    those sets for which all of it is too little."""
    asked = join_small(sets, open_.groupBy("doc").agg(F.collect_set("role").alias("roles")), "doc", "inner")
    asked = join_small(asked, comp, "doc", "left").select("doc", "shingles", "roles", F.coalesce("component", "doc").alias("component"))
    rows = stage(asked.mapInArrow(tidy(_neighbourhoods(percent, k, single)), "doc long, role int, need long, segment long, deletion boolean, sig long, component long"), "neighbourhoods")
    pieces = 1 + rows.count() // _PIECE
    # a signature can only be shared within its scheme; one component needs no more links
    mixed = _with_totals(rows, "sig", pieces, n=("count", None), low=("min", "component"), high=("max", "component")).filter("low <> high").drop("low", "high")
    mixed = stage(mixed, "mixed-lists")
    place = ["doc", "role", "need", "segment"]
    none = F.lit(0).cast("long")
    costs = mixed.select(*place, F.when(~F.col("deletion"), F.col("n")).otherwise(0).alias("one"), F.col("n").alias("all"))
    priced = costs.unionByName(rows.select(*place, none.alias("one"), none.alias("all"))).groupBy(*place).agg(F.sum("one").alias("one"), F.sum("all").alias("all"))
    units = [F.struct(F.lit(1).alias("unit"), F.col("one").alias("cost"))]
    if not single:
        units.append(F.struct(F.lit(2).alias("unit"), F.greatest("one", F.col("all") - F.col("one")).alias("cost")))
    units = priced.select(*place, F.explode(F.array(*units)).alias("u")).select("*", "u.*")
    order = Window.partitionBy("doc", "role").orderBy("cost", "segment", "unit")
    units = stage(units.withColumn("at", F.row_number().over(order)).filter("at <= need").select(*place, "unit"), "allocation")
    short = units.groupBy("doc", "role").agg(F.count("*").alias("n"), F.max("need").alias("need")).filter("n < need").select("doc", "role")
    # what a segment's units take of its signatures
    taken = mixed.select("doc", "role", "segment", none.cast("int").alias("unit"), F.struct("sig", "deletion").alias("s")).unionByName(
        units.select("doc", "role", "segment", "unit", F.lit(None).cast("struct<sig:long,deletion:boolean>").alias("s"))
    )
    taken = taken.groupBy("doc", "role", "segment").agg(F.max("unit").alias("unit"), F.collect_list("s").alias("s"))
    taken = taken.select("unit", F.inline("s")).filter("unit = 2 or (unit = 1 and not deletion)").select("sig").distinct()
    both = mixed.select("sig", "doc", "component", F.lit(0).alias("use")).unionByName(taken.select("sig", F.lit(None).cast("long").alias("doc"), F.lit(None).cast("long").alias("component"), F.lit(1).alias("use")))
    shared = _with_totals(both, "sig", pieces, used=("max", "use")).filter("used = 1 and doc is not null").select("sig", "doc", "component").distinct()
    return _by_hub(shared, pieces), short


def _by_hub(shared: DataFrame, pieces: int) -> DataFrame:
    """(sig, doc, component) -> (hub, doc, component): lists come together under their most frequent member; near copies share it in most lists."""
    shared = shared.withColumn("fame", F.count("*").over(Window.partitionBy("doc"))).withColumn("h", F.struct("fame", F.negative("doc").alias("less")))
    group = _with_totals(stage(shared.drop("fame"), "shared-lists"), "sig", pieces, once=["doc", "component"], top=("max", "h"))
    return stage(group.select(F.negative("top.less").alias("hub"), "doc", "component").distinct(), "hub-groups")


def _between(pairs: DataFrame, ends: DataFrame) -> DataFrame:
    """The pairs (a, b) of which both are in ``ends`` (doc, component), in different components."""
    for x in "ab":
        pairs = join_small(pairs, ends.select(F.col("doc").alias(x), F.col("component").alias(f"in_{x}")), x, "inner", 500_000)
    return pairs.filter("in_a <> in_b").select("a", "b")


#: A set is followed through its long lists as they are while those it needs have up to so many open sets each: some 2000
#: comparisons within blocks cost less than a row for each segment and shingle of the set, and their lists.
_FOLLOWED = 2048


def _few_lists(mixed: DataFrame, open_: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``mixed`` (sig, doc, component, role): the long lists of several components; ``open_`` (doc, role, spare): the sets that are in more of
    these than they can do without.  Similar sets of which one is not open are found already, so that only open members count.  Any so many as are more
    than ``spare`` of a set's lists hold each of its links that no short list holds: the shortest are followed.  Result: groups (hub, doc, component) of what these lists hold, and the
    (doc, role) that are left: those that need a list of more than ``_FOLLOWED`` open sets, and those with fewer lists than they need."""
    among = mixed.join(open_, ["doc", "role"])
    rows = stage(among, "open-members")
    pieces = 1 + rows.count() // _PIECE
    rows = _with_totals(rows, "sig", pieces, n=("count", None), low=("min", "component"), high=("max", "component")).filter("low <> high")
    own = Window.partitionBy("doc", "role")
    rows = rows.withColumn("at", F.row_number().over(own.orderBy("n", "sig"))).withColumn("wanted", F.count("*").over(own) - F.col("spare"))
    rows = rows.withColumn("most", F.max(F.when(F.col("at") <= F.col("wanted"), F.col("n"))).over(own))
    rows = stage(rows.select("sig", "doc", "role", "component", "spare", "most", (F.col("at") <= F.col("wanted")).alias("asked")), "open-lists")
    # a set without rows here is in no list with another component
    far = rows.filter((F.col("spare") < 0) | (F.col("most") > _FOLLOWED)).select("doc", "role").distinct()
    far = far.unionByName(open_.filter("spare < 0").select("doc", "role")).distinct()
    use = rows.withColumn("use", (F.col("asked") & (F.col("spare") >= 0) & (F.col("most") <= _FOLLOWED)).cast("int"))
    shared = _with_totals(use.select("sig", "doc", "component", "use"), "sig", pieces, used=("max", "use")).filter("used = 1").select("sig", "doc", "component").distinct()
    return _by_hub(shared, pieces), far


#: Shingles of two blocks that are compared at a time, and of a block of sets (a longer set is a block of its own).
_SLICE, _BLOCK_ITEMS = 400_000, 500_000


def _blocks_linked(percent: int):
    """Two blocks of sets -> a link for each pair of components that similar sets connect."""

    def run(table: pa.Table) -> pa.Table:
        found = []
        doc, component, side = (table[c].to_numpy() for c in ("doc", "component", "side"))
        sets = [np.frombuffer(x.as_buffer(), U) for x in table["shingles"]]
        size = np.array([len(x) for x in sets], np.int64)
        first, second = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        if len(first) and len(second) and (component != component[0]).any():
            common = np.zeros((len(first), len(second)), np.float32)
            row, column = np.full(len(sets), -1), np.full(len(sets), -1)
            row[first], column[second] = np.arange(len(first)), np.arange(len(second))
            # by ranges of hashes, so that some hundred thousand are held at a time
            slices = int(size.sum()) // _SLICE + 1
            edges = [np.searchsorted(x, np.array([(i << 64) // slices for i in range(1, slices)], U)) for x in sets]
            for r in range(slices):
                parts = [x[e[r - 1] if r else 0 : e[r] if r < slices - 1 else len(x)] for x, e in zip(sets, edges)]
                owner = np.repeat(np.arange(len(sets)), [len(x) for x in parts])
                _, item, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
                kept = np.flatnonzero(times > 1)  # what one set alone holds is in no intersection
                place = np.full(len(times), -1)
                place[kept] = np.arange(len(kept))
                item = place[item]
                for a in range(0, len(kept), 2048):
                    on = np.flatnonzero((item >= a) & (item < a + 2048))
                    x, y = np.zeros((len(first), 2048), np.float32), np.zeros((len(second), 2048), np.float32)
                    i = on[row[owner[on]] >= 0]
                    x[row[owner[i]], item[i] - a] = 1
                    i = on[column[owner[on]] >= 0]
                    y[column[owner[i]], item[i] - a] = 1
                    common += x @ y.T
            both = common.astype(np.int64)
            i, j = np.nonzero(100 * both >= percent * (size[first][:, None] + size[second][None, :] - both))
            i, j = first[i], second[j]
            i, j = i[component[i] != component[j]], j[component[i] != component[j]]
            if len(i):
                _, one = np.unique(np.stack([component[i], component[j]]), axis=1, return_index=True)
                found = [(int(doc[p]), int(doc[q])) for p, q in zip(i[one], j[one])]
        release()
        return pa.table({"a": pa.array([min(f) for f in found], pa.int64()), "b": pa.array([max(f) for f in found], pa.int64())})

    return run


def linked_groups(group: DataFrame, sets: DataFrame, percent: int, block: int = 512) -> DataFrame:
    """Links (a, b) between components within groups (hub, doc, component): one for each pair of
    components and blocks, at least.  A group of any size is compared block by block, so a task holds two
    blocks of bounded number and length, and pairs are never rows."""
    group = group.join(sets.select("doc", (F.octet_length("shingles") / 8).alias("items")), "doc")
    sizes = group.groupBy("hub").agg(F.count("*").alias("n"), F.sum("items").alias("total"), (F.min("component") != F.max("component")).alias("mixed"))
    g = join_small(group, sizes.filter("mixed"), "hub", "inner", 500_000)
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("total") / _BLOCK_ITEMS))
    g = g.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    # each block meets itself and every other one: (low, high), as side 0, 1 or 2 (both)
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    g = g.select("hub", "doc", "component", "own", other)
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    g = g.select("doc", "component", "hub", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), side.alias("side"))
    whole = g.join(sets, "doc")
    return whole.groupBy("hub", "low", "high").applyInArrow(_blocks_linked(percent), "a long, b long").distinct()


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by similar shingle sets.

    A document's set: its distinct ``k``-word shingles, A-Z lower-cased; with fewer words the whole
    sequence as one; without words none.  Two documents are linked when 100 * intersection >=
    percent * union.  Result, one row for each row of ``docs``: ``id_col``, n_shingles, component_id
    (the smallest id that links reach, its own included).

    Null and empty texts have empty sets and no links.  Rows without an id take no part and have a
    null component.  Repeated rows are equal sets; rows of one id with different texts share that
    id's component.  Texts of any length are read whole.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    n = width(spark)
    base = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    index = base.mapInArrow(tidy(_index(percent, k, n)), "bucket int, kind int, n int, role int, data binary")
    # each bucket is a partition of its own: none is empty, none holds two
    found = stage(index.repartitionById(n, F.col("bucket")).mapInArrow(tidy(_lists), _FOUND), "jaccard-lists", _BATCH)

    sets = found.filter(F.col("kind") == _SET).select(F.col("a").alias("doc"), F.col("b").alias("n_shingles"), F.col("c").alias("identity"), F.col("d").alias("spare0"), F.col("e").alias("spare1"))
    classes = sets.filter("n_shingles > 0").groupBy("identity", "n_shingles").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    classes = stage(classes.filter("first <> last").drop("last"), "jaccard-classes")

    spare = sets.filter("n_shingles > 0").select("doc", F.explode(F.array(F.struct(F.lit(0).alias("role"), F.col("spare0").alias("spare")), F.struct(F.lit(1).alias("role"), F.col("spare1").alias("spare")))).alias("s")).select("doc", "s.*")
    members = found.filter(F.col("kind") == _MEMBER).select(F.col("a").alias("sig"), F.col("b").alias("doc"), F.col("c").cast("int").alias("role"))
    long = members.groupBy("doc", "role").agg(F.count("*").alias("long"))
    # similar sets share at least so many short lists; where that is none or less, the set's links
    # are not all found in short lists
    least = spare.join(long, ["doc", "role"], "left").select("doc", "role", "spare", (F.col("spare") + 1 - F.coalesce("long", F.lit(0))).alias("least"))
    pairs = found.filter(F.col("kind") == _PAIR).groupBy("a", "b", "c").agg(F.sum("d").alias("short"), F.sum("e").alias("near"))
    for x, role in (("a", F.floor(F.col("c") / 2)), ("b", F.col("c") % 2)):
        own = least.select(F.col("doc").alias(x), F.col("role").alias("role"), F.col("least").alias(f"least_{x}"), F.col("spare").alias(f"spare_{x}"))
        pairs = pairs.withColumn("role", role.cast("int")).join(own, [x, "role"]).drop("role")
    enough = [(F.col(f"least_{x}") < 1) | (F.col("short") >= F.col(f"least_{x}")) for x in "ab"]
    likely = (F.col("least_a") >= 1) | (F.col("least_b") >= 1) | (F.col("short") + F.col("near") > F.greatest(F.lit(0), F.least("spare_a", "spare_b")))
    # the others share a short list, but may be similar only if both are open below
    pairs = pairs.filter(enough[0] & enough[1] & (likely | (F.col("short") > 0))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likely.alias("likely"))
    pairs = stage(pairs.groupBy("a", "b").agg(F.max("likely").alias("likely")), "jaccard-pairs")
    pairs, doubtful = pairs.filter("likely").select("a", "b"), pairs.filter("not likely").select("a", "b")
    in_pairs = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc"))).distinct()
    shingle_sets = stage(sets_of(docs, in_pairs, id_col, text_col, k), "jaccard-sets", _BATCH)
    links = stage(verified(pairs, shingle_sets, percent), "jaccard-links", _BATCH)
    comp = components(links).select(F.col("node").alias("doc"), "component")

    # sets whose short lists are too few: long lists within one component make up for it
    by_doc = members.groupBy("doc").agg(F.collect_list(F.struct("sig", "role")).alias("m"))  # a set's own lists
    member = join_small(by_doc, comp, "doc", "left", 500_000).select("doc", F.coalesce("component", "doc").alias("component"), F.inline("m"))
    member = stage(member, "jaccard-members")
    mixed = _with_totals(member, "sig", 1 + member.count() // _PIECE, low=("min", "component"), high=("max", "component")).filter("low <> high")
    mixed = stage(mixed.select("sig", "doc", "component", "role"), "jaccard-mixed")
    costly = mixed.groupBy("doc", "role").agg(F.count("*").alias("n"))
    open_ = spare.join(costly, ["doc", "role"], "left").filter(F.col("spare") < F.coalesce("n", F.lit(0))).groupBy("doc", "role").agg(F.min("spare").alias("spare"))
    # of equal sets one stands for all
    same = sets.join(classes, ["identity", "n_shingles"]).filter("doc <> first").select("doc").distinct()
    open_ = stage(join_small(open_, same, "doc", "left_anti", 500_000), "jaccard-open")
    more = []
    for level in ("lists", "deletions", "shingles"):
        if not open_.limit(1).count():
            break
        if level == "lists":
            open_sets = stage(sets_of(docs, open_.select("doc").distinct(), id_col, text_col, k), "jaccard-sets", _BATCH)
            ends = join_small(open_.select("doc").distinct(), comp, "doc", "left", 500_000).select("doc", F.coalesce("component", "doc").alias("component"))
            more.append(stage(verified(_between(doubtful, ends), open_sets, percent), "jaccard-links", _BATCH))
            extra, open_ = _few_lists(mixed, open_)
        else:
            extra, open_ = _followed(open_, open_sets, comp, percent, k, level == "shingles")
        more.append(stage(linked_groups(extra, open_sets, percent), "jaccard-links", _BATCH))
    for x in more:
        links = links.unionByName(x)
    if more and any(x.limit(1).count() for x in more):
        comp = components(links).select(F.col("node").alias("doc"), "component")

    result = join_small(sets.select("doc", "n_shingles", "identity"), classes, ["identity", "n_shingles"], "left", 500_000)
    result = result.withColumn("head", F.when(F.col("n_shingles") > 0, F.coalesce("first", "doc")).otherwise(F.col("doc")))
    result = join_small(result, comp.select(F.col("doc").alias("head"), "component"), "head", "left", 500_000)
    result = result.select(F.col("doc").alias(id_col), "n_shingles", F.coalesce("component", "head").alias("component_id"))
    nulls = docs.filter(F.col(id_col).isNull()).select(F.lit(None).cast("long").alias(id_col), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return result.unionByName(nulls)
