"""A Merkle manifest of a dataset: a hash tree for each group of rows, a tree over the groups, and proofs by climbing.

Rows are hashed to leaves in the JVM and get dense places by group from one range sort.  Each level of the trees is an aggregate of runs of
``FANOUT`` nodes and is kept as node rows that point to their parent.  A recursive query then climbs from the leaves to the root:
each step joins the parent's row, appends the siblings and folds the (tampered) hash.  What the leaves of a run have in common, their parent's siblings
and everything above, travels once for the run; every leaf's own hash is folded at every step.

Near the root many runs meet in few nodes.  Such nodes are stored in as many copies as there are runs below them by the
thousand, and a run climbs by the copy of its own number, so that no join sends all runs to one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import ROW, with_row_id
from .common import BROADCAST_ROWS, join_small, stage

FANOUT = 16
#: Runs below a node that climb by the same copy of it.
RUNS_A_COPY = 4096
#: At most 2 ** so many rows of a group meet in one key of the join that numbers them.
_BLOCK = 20
#: The group of the tree over all groups.
TOP = -1
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _hash(text: Column) -> Column:
    return F.sha2(text, 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """A value as the leaves hold it: ``-`` for null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, fields: list[str], group_col: str, id_col: str, tampered: Column, tampered_field: str, tamper: Column) -> DataFrame:
    """(grp, id, leaf, other): the leaf of each row and, where ``tampered`` holds, the leaf with ``tamper`` in place of ``tampered_field``."""
    leaf = _hash(F.concat(*(field(F.col(f"`{c}`")) for c in fields)))
    other = _hash(F.concat(*(field(tamper if c == tampered_field else F.col(f"`{c}`")) for c in fields)))
    return docs.select(
        F.col(f"`{group_col}`").cast("string").alias("grp"), F.col(f"`{id_col}`").cast("long").alias("id"),
        F.unhex(leaf).alias("leaf"), F.when(F.coalesce(tampered, F.lit(False)), F.unhex(other)).alias("other"),
    )


def _grown(first: DataFrame, name: str, depth: int) -> list[DataFrame]:
    """The levels above ``first`` (grp, idx, n: nodes of the level, below: runs below, digest): runs of nodes become nodes as long as a
    group has several.  Each is staged with ``parts``, its children's digests in order."""
    out, level = [], first
    for k in range(depth):
        some = level.filter("n > 1").groupBy("grp", (F.col("idx") / FANOUT).cast("long").alias("idx")).agg(
            F.first("n").alias("n"), F.sum("below").alias("below"), F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("parts")
        )
        some = some.select("grp", "idx", F.ceil(F.col("n") / FANOUT).cast("long").alias("n"), "below", F.col("parts.digest").alias("parts"))
        level = stage(some.withColumn("digest", F.unhex(_hash(F.array_join(F.transform("parts", _hex), "")))), f"{name}-{k + 2}")
        out.append(level)
    return out


def _copies(below: Column) -> Column:
    return F.ceil(below / RUNS_A_COPY).cast("long")


@contextmanager
def _unbounded(spark: SparkSession) -> Iterator[None]:
    """Recursive queries may return as many rows as there are runs, meanwhile."""
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "-1")
        yield
    finally:
        spark.conf.set(setting, before)


#: One step: siblings to the left and right of the node in its parent's run, then the parent in its place.
CLIMB = """
with recursive climb (run, grp, level, idx, place, copies, siblings, folds, subroot, root) as (
  select run, grp, level, idx, place, copies, cast('' as binary), folds, subroot, root from {first}
  union all
  select c.run, n.up_grp, n.up_level, n.up_idx, n.up_place, n.up_copies,
    concat(c.siblings, substring(n.parts, 1, 32 * c.place), substring(n.parts, 32 * c.place + 33)),
    transform(c.folds, f -> unhex(sha2(concat(lower(hex(substring(n.parts, 1, 32 * c.place))), lower(hex(f)), lower(hex(substring(n.parts, 32 * c.place + 33)))), 256))),
    case when n.grp >= 0 then n.digest else c.subroot end, n.digest
  from climb c join {nodes} n on n.grp = c.grp and n.level = c.level and n.idx = c.idx and n.copy = pmod(xxhash64(c.run), c.copies)
)
select run, siblings, folds, subroot, root from climb where level = 0
"""


def manifest(docs: DataFrame, fields: list[str], group_col: str, id_col: str, tampered: Column, tampered_field: str, tamper: Column) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of ``docs``.

    A leaf is the hash of the row's ``fields`` (see ``field``).  By group, leaves ascend by id (nulls first; equal ids by leaf), and runs of ``FANOUT``
    consecutive nodes become their hash until one is left, the subroot; a lone leaf is its group's subroot.  Subroots in the order of their
    groups (null first, by bytes) become the root likewise.  proof_sha256 is the hash of the siblings of a row from level to level, folded_root what
    climbing from the row's leaf leads to, where ``tampered`` holds from the leaf with ``tamper`` in place of ``tampered_field``; verified tells
    whether that is the root.  Nulls in any column are values of their own; repeated rows are leaves of their own; columns that are not named
    in ``fields`` do not matter.  An empty table gives an empty result."""
    spark = docs.sparkSession
    base = stage(leaves(docs, fields, group_col, id_col, tampered, tampered_field, tamper), "merkle-leaves")
    placed = with_row_id(base, ["grp", "id", "leaf"]).withColumnRenamed(ROW, "at")
    groups = stage(placed.groupBy("grp").agg(F.min("at").alias("first"), F.count("*").alias("n_leaves")), "merkle-groups")
    groups = stage(with_row_id(groups, ["first"]).withColumnRenamed(ROW, "no"), "merkle-numbers")
    keys = groups.select("grp", "first", "n_leaves", "no", F.explode(F.sequence(F.shiftright("first", _BLOCK), F.shiftright(F.col("first") + F.col("n_leaves") - 1, _BLOCK))).alias("block"))
    keys = keys.select(F.col("grp").alias("__grp"), "block", "first", "n_leaves", "no")
    placed = placed.withColumn("block", F.shiftright("at", _BLOCK))
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    placed = placed.join(keys, placed["grp"].eqNullSafe(keys["__grp"]) & (placed["block"] == keys["block"]))
    place = F.col("at") - F.col("first")
    runs = placed.groupBy(F.col("no").alias("grp"), (place / FANOUT).cast("long").alias("idx")).agg(
        F.first("n_leaves").alias("n_leaves"), F.sort_array(F.collect_list(F.struct(F.col("at"), "id", "leaf", "other"))).alias("rows"), F.min("at").alias("run")
    )
    one = F.col("rows.leaf")
    digest = F.when(F.col("n_leaves") == 1, one[0]).otherwise(F.unhex(_hash(F.array_join(F.transform(one, _hex), ""))))
    runs = stage(runs.select("grp", "idx", "run", "n_leaves", F.transform("rows", lambda r: r.dropFields("at")).alias("rows"), digest.alias("digest")), "merkle-runs")

    most = groups.agg(F.max("n_leaves").alias("n"), F.count("*").alias("groups")).first()
    if not most.groups:
        return docs.sparkSession.createDataFrame([], "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")

    def depth(n: int) -> int:
        d = 1
        while FANOUT**d < n:
            d += 1
        return d

    first = runs.select("grp", "idx", F.ceil(F.col("n_leaves") / FANOUT).cast("long").alias("n"), F.lit(1).cast("long").alias("below"), "digest")
    levels = _grown(first, "merkle-level", depth(most.n) - 1)
    tops = [x.filter("n = 1").select("grp", "below", "digest") for x in (first, *levels)]
    subroots = tops[0]
    for x in tops[1:]:
        subroots = subroots.unionByName(x)
    sub = stage(subroots.select(F.lit(TOP).cast("long").alias("grp"), F.col("grp").alias("idx"), F.lit(most.groups).cast("long").alias("n"), "below", "digest"), "merkle-subroots")
    over = _grown(sub, "merkle-top", depth(most.groups) if most.groups > 1 else 0)

    # parents: level 2 and up of a group's tree, 1 and up of the tree over the groups; level 0 stands for none
    sizes = join_small(sub.select(F.col("idx").alias("grp"), F.col("idx").alias("__no")), groups.select(F.col("no").alias("grp"), "n_leaves"), "grp").drop("__no")
    none = {"up_grp": F.lit(TOP).cast("long"), "up_level": F.lit(0), "up_idx": F.lit(0).cast("long"), "up_place": F.lit(0), "up_copies": F.lit(1).cast("long")}
    first_top = over[0].select(F.col("idx").alias("__top"), F.col("below").alias("__below")) if over else None

    def linked(x: DataFrame, level: int, above: DataFrame | None) -> DataFrame:
        """Node rows with their parent: the node of the next level, or for a subroot that of the tree over all groups."""
        if level and above is not None:  # within a group's tree or the top tree
            up = above.select(F.col("grp").alias("__grp"), F.col("idx").alias("__idx"), F.col("below").alias("__up"))
            x = x.withColumn("__parent", (F.col("idx") / FANOUT).cast("long"))
            x = x.join(up, (x["grp"] == up["__grp"]) & (x["__parent"] == up["__idx"]), "left")
        else:
            x = x.withColumns({"__parent": F.lit(0).cast("long"), "__up": F.lit(None).cast("long")})
        inner = F.col("__up").isNotNull()
        nothing = {"__top": F.lit(None).cast("long"), "__below": F.lit(None).cast("long")}
        if first_top is None:
            x = x.withColumns(nothing)
        else:  # a row for each group joins the top tree, the others stay where they are
            last = x.filter(~inner & (F.col("grp") >= 0)).withColumn("__top", (F.col("grp") / FANOUT).cast("long"))
            x = x.filter(inner | (F.col("grp") < 0)).withColumns(nothing).unionByName(join_small(last, first_top, "__top"))
        outer = F.col("__top").isNotNull()
        return x.withColumns({
            "up_grp": F.when(inner, F.col("grp")).otherwise(none["up_grp"]), "up_level": F.when(inner, F.lit(level + 1)).when(outer, F.lit(1)).otherwise(none["up_level"]),
            "up_idx": F.when(inner, F.col("__parent")).when(outer, F.col("__top")).otherwise(none["up_idx"]),
            "up_place": F.when(inner, F.col("idx") % FANOUT).when(outer, F.col("grp") % FANOUT).otherwise(none["up_place"]).cast("int"),
            "up_copies": F.when(inner, _copies(F.col("__up"))).when(outer, _copies(F.col("__below"))).otherwise(none["up_copies"]),
        })

    nodes = None
    for start, found in ((2, levels), (1, over)):
        for k, x in enumerate(found):
            above = found[k + 1] if k + 1 < len(found) else None
            rows = linked(x, start + k, above).select(
                "grp", F.lit(start + k).alias("level"), "idx", F.array_join(F.transform("parts", F.hex), "").alias("parts"), "digest", "up_grp", "up_level", "up_idx", "up_place", "up_copies",
                F.explode(F.sequence(F.lit(0).cast("long"), _copies(F.col("below")) - 1)).alias("copy"),
            )
            nodes = rows if nodes is None else nodes.unionByName(rows)
    own = F.expr("transform(rows, r -> coalesce(r.other, r.leaf))")
    fold = F.when(F.col("n_leaves") == 1, own).otherwise(F.expr(
        "transform(transform(rows, r -> coalesce(r.other, r.leaf)), (f, i) -> unhex(sha2(array_join(transform(rows, (r, j) -> lower(hex(if(i = j, f, r.leaf)))), ''), 256)))"
    ))
    start = linked(runs.withColumn("n", F.ceil(F.col("n_leaves") / FANOUT).cast("long")), 1, levels[0] if levels else None).select(
        "run", F.col("up_grp").alias("grp"), F.col("up_level").alias("level"), F.col("up_idx").alias("idx"), F.col("up_place").alias("place"), F.col("up_copies").alias("copies"),
        fold.alias("folds"), F.col("digest").alias("subroot"), F.col("digest").alias("root"),
    )
    if nodes is None:
        ended = start.select("run", F.lit(b"").alias("siblings"), "folds", "subroot", "root")
    else:
        nodes = stage(nodes.withColumn("parts", F.unhex("parts")), "merkle-nodes")
        with _unbounded(spark):
            ended = spark.sql(CLIMB, first=stage(start, "merkle-start"), nodes=nodes)
            ended = stage(ended, "merkle-climb")
    out = runs.select("run", "n_leaves", "rows").join(ended, "run")
    out = out.select("siblings", "folds", "subroot", "root", "rows", "n_leaves", F.posexplode("rows").alias("at", "r"))
    near = F.when(F.col("n_leaves") == 1, F.lit("")).otherwise(F.expr("array_join(transform(filter(rows, (r, j) -> j <> at), r -> lower(hex(r.leaf))), '')"))
    folded = F.element_at("folds", F.col("at") + 1)
    return out.select(
        F.col("r.id").alias("id"), _hex(F.col("r.leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
        _hash(F.concat(near, _hex(F.col("siblings")))).alias("proof_sha256"), _hex(folded).alias("folded_root"), (folded == F.col("root")).alias("verified"),
    )


def lower_cased(text_col: str) -> Column:
    """A-Z in lower case, nothing else: what tampering does to a text."""
    return F.translate(F.col(f"`{text_col}`"), _UPPER, _UPPER.lower())
