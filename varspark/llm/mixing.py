"""Mixing sources to target weights by Pareto order sampling.

A source's target is a share of all words.  Within a source each document has an expected
number of copies; its whole part is certain, and the fraction left is an inclusion probability.
Documents are ranked by random odds over inclusion odds, and the lowest ranks are taken until
the source's words are spent.  The ranking is never sorted as a whole: a histogram of ranks
finds the bin where the budget ends, and only that bin is ordered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, join_small, stage

WORD = r"[^\x20\x09-\x0D]+"
_BINS = 1 << 14


def word_count(text: Column) -> Column:
    """Number of runs of other bytes than space and ``\\t\\n\\v\\f\\r``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A key that equals for nulls as well."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0, by code point and null last.  Sorted by range over many
    partitions; the driver sees one count for each partition."""
    s = stage(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "sources")
    part, pos = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before, offsets = 0, []
    for r in s.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets.append((r["part"], before))
        before += r["count"]
    offsets = s.sparkSession.createDataFrame(offsets, "part long, before long")
    return join_small(s.withColumn("part", part), offsets, "part", "inner").withColumn("rank", F.col("before") + pos).drop("at", "part", "before")


def targets(sources: DataFrame, cap: float = 3.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """(source, key, source_size, target): the sources in order take ``weights`` in turn and share
    the sum of all sizes; a target stops at ``cap`` times its source's size, and the excess is
    shared again by weight until none is above.  Each round is one aggregation to three numbers."""
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    s = stage(ranked(sources).withColumn("weight", w).withColumn("most", cap * F.col("source_size")), "targets")
    total = s.agg(F.sum("source_size")).first()[0] or 0
    share = None  # words for a weight of 1
    while True:
        over = F.lit(False) if share is None else F.col("weight") * share > F.col("most")
        n, capped, left = s.agg(
            F.count_if(over), F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("weight")))
        ).first()
        new = (total - (capped or 0.0)) / left if left else 0.0
        if share is not None and new <= share:
            break
        share = new
    return s.select("source", "key", "source_size", F.least("most", F.col("weight") * share).alias("target"))


def _cut(docs: DataFrame, gap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (key, id, row, size, rank, bin) with ``drawn``, true for the lowest ranks of each key whose words
    stay within its gap (key, gap), of the documents that are not longer than the gap; and the gaps left."""
    at = join_small(docs, gap, "key", "inner").withColumn("words", F.when(F.col("size") <= F.col("gap"), F.col("size")).otherwise(0))
    hist = at.groupBy("key", "bin").agg(F.sum("words").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("key").orderBy("bin"))
    edge = join_small(hist, gap, "key", "inner").withColumn("upto", upto).filter("upto > gap")
    edge = edge.groupBy("key").agg(F.min("bin").alias("edge"), F.min_by(F.col("upto") - F.col("words"), "bin").alias("before"))
    edge = stage(edge, "mix-edges")
    at = join_small(at, edge, "key", "left")
    run = F.sum("words").over(Window.partitionBy("key").orderBy("rank", "id", "row")) + F.col("before")
    inside = stage(at.filter(F.col("bin") == F.col("edge")).withColumn("run", run).select("row", (F.col("run") <= F.col("gap")).alias("in")), "mix-edge")
    drawn = (F.col("words") > 0) & F.coalesce("in", F.col("bin") < F.coalesce("edge", F.lit(_BINS)))
    done = stage(join_small(at, inside, "row", "left").withColumn("drawn", drawn).select(*docs.columns, "drawn"), "mix-drawn")
    spent = done.filter("drawn").groupBy("key").agg(F.sum("size").alias("spent"))
    left = join_small(gap, stage(spent, "mix-spent"), "key", "left").select("key", (F.col("gap") - F.coalesce("spent", F.lit(0))).alias("gap"))
    return done, stage(left, "mix-gap")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    cap: float = 3.0,
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    seed: int = 1,
) -> DataFrame:
    """How often the mix takes each document.

    Result, one row for each row of ``docs``: ``id_col``, ``source_col``, rid (hash of the text),
    size (words), source_size, target, expected (copies), copies (long), taken (words).  Expected
    copies are proportional to the logarithm of the size and at most ``cap``; their words add up to
    the target.  The budget is spent by whole documents only.  After the last rank that fits, the
    gap takes its best fit, then goes on down the ranks with all documents that still fit, and so
    on until none does; each round at least halves the gap.  One document that is too long may
    close what is left, where that comes closer to the target.

    Null texts have size 0 and are never taken; null sources are one source, the last; rows
    without an id take part as others do.  Repeated rows are drawn one by one.  Draws depend on
    ``seed``, id and text only, so reruns agree.  Empty tables give an empty result.
    """
    d = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        _key(F.col(source_col)).alias("key"),
        F.xxhash64(text_col).alias("rid"),
        word_count(F.col(text_col)).alias("size"),
    )
    band = F.length(F.bin("size"))  # bits of the size
    u = (F.xxhash64(F.lit(seed), "id", "rid").bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    d = stage(d.withColumns({"band": F.when(F.col("size") > 0, band).otherwise(0), "u": u, "row": F.monotonically_increasing_id()}), "mix-sizes")

    bands = stage(d.groupBy("key", "source", "band").agg(F.sum("size").alias("words")), "mix-bands")
    goal = stage(targets(bands.groupBy("key", "source").agg(F.sum("words").alias("source_size")), cap, weights), "mix-goal")
    # expected copies are min(cap, c * band): with the longest bands at the cap, c follows from
    # the rest; the first band that then stays below its cap settles it
    down = Window.partitionBy("key").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    up = Window.partitionBy("key").orderBy(F.desc("band")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    c = join_small(bands.filter("band > 0"), goal.select("key", "target"), "key", "inner")
    c = c.withColumn("c", (F.col("target") - cap * F.coalesce(F.sum("words").over(down), F.lit(0))) / F.sum(F.col("words") * F.col("band")).over(up))
    c = c.filter(F.col("c") * F.col("band") <= cap).groupBy("key").agg(F.max_by("c", "band").alias("c"))
    goal = stage(goal.join(c, "key", "left"), "mix-rates")

    lam = F.when(F.col("size") > 0, F.least(F.lit(cap), F.coalesce(F.col("c") * F.col("band"), F.lit(cap)))).otherwise(0.0)
    pi = F.col("expected") - F.col("whole")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("pi") / (1 - F.col("pi")))
    d = join_small(d, goal.drop("source"), "key", "left").withColumn("expected", lam)
    d = d.withColumn("whole", F.floor("expected")).withColumn("pi", pi)
    d = d.withColumn("rank", F.when(F.col("pi") > 0, odds / (1 + odds)))
    d = d.withColumn("bin", F.least(F.floor(F.col("rank") * _BINS), F.lit(_BINS - 1)))

    sure = stage(d.groupBy("key").agg(F.sum(F.col("whole") * F.col("size")).alias("sure")), "mix-sure")
    gap = stage(join_small(sure, goal.select("key", "target"), "key", "inner").select("key", (F.col("target") - F.col("sure")).alias("gap")), "mix-gap")
    rest, gap = _cut(d.filter("pi > 0").select("key", "id", "row", "size", "rank", "bin"), gap)
    taken = [rest.filter("drawn").select("row")]
    # what no document of the gap's size or less can close is closed by a longer one, of less than twice the gap
    near = lambda: join_small(rest.filter("not drawn").drop("drawn"), gap, "key", "inner").filter("size < 2 * gap")
    while True:
        open_ = stage(near(), "mix-rest")
        fits = open_.filter("size <= gap")
        if not fits.limit(1).count():
            break
        best = stage(fits.groupBy("key").agg(F.min(F.struct(F.col("gap") - F.col("size"), "rank", "row", "size")).alias("b")).select("key", "b.row", "b.size"), "mix-best")
        taken.append(best.select("row"))
        gap = stage(join_small(gap, best.select("key", "size"), "key", "left").select("key", (F.col("gap") - F.coalesce("size", F.lit(0))).alias("gap")), "mix-gap")
        open_ = join_small(open_.drop("gap"), best.select("key", F.col("row").alias("best")), "key", "left").filter(~F.col("row").eqNullSafe(F.col("best"))).drop("best")
        rest, gap = _cut(open_, gap)
        taken.append(rest.filter("drawn").select("row"))
    last = open_.groupBy("key").agg(F.min(F.struct(F.col("size") - F.col("gap"), "rank", "row")).alias("b")).select("b.row")
    drawn = reduce(DataFrame.unionByName, [*taken, last]).withColumn("drawn", F.lit(True))
    copies = (F.col("whole") + F.when(F.col("drawn"), 1).otherwise(0)).cast("long")
    d = join_small(d, drawn, "row", "left").withColumn("copies", copies)
    return d.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "rid", "size", "source_size", "target", "expected", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of a mix, each as often as it is taken, with the columns of ``docs``, whatever their names.

    Rows of one id and text share what the plan takes of them: in the order of a hash of all their columns, each different row gets its
    share, rounded so that the shares add up to the plan's copies.  Rows that are equal in every column are alike.  Null ids are one id."""
    inside = F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))) if any("map<" in k for _, k in docs.dtypes) else F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("rid"), F.xxhash64(inside).alias("h"))
    total = plan.groupBy(F.col(id_col).alias("id"), "rid").agg(F.sum("copies").alias("n")).filter("n > 0")
    kinds = whole.groupBy("id", "rid", "h").agg(F.count("*").alias("k"))
    upto = Window.partitionBy("id", "rid").orderBy("h")  # different rows of one id and text: few
    kinds = kinds.withColumns({"upto": F.sum("k").over(upto), "all": F.sum("k").over(Window.partitionBy("id", "rid"))})
    kinds = kinds.join(total.withColumnsRenamed({"id": "t_id", "rid": "t_rid"}), F.col("id").eqNullSafe(F.col("t_id")) & (F.col("rid") == F.col("t_rid")))
    share = F.floor(F.col("n") * F.col("upto") / F.col("all")) - F.floor(F.col("n") * (F.col("upto") - F.col("k")) / F.col("all"))
    taken = stage(kinds.select(F.col("id").alias("t_id"), F.col("rid").alias("t_rid"), F.col("h").alias("t_h"), "k", share.cast("long").alias("copies")).filter("copies > 0"), "mix-copies")
    hit = whole.join(taken, F.col("id").eqNullSafe(F.col("t_id")) & (F.col("rid") == F.col("t_rid")) & (F.col("h") == F.col("t_h"))).select("row", "id", "rid", "h", "k", "copies")
    again = hit.filter("k > 1").groupBy("id", "rid", "h").agg(F.any_value("row").alias("row"), F.any_value("copies").alias("copies"))
    once = hit.filter("k = 1").select("row", "copies").unionByName(again.select("row", "copies"))
    return once.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
