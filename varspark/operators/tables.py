"""Table utilities: columns, rows, comparison, merge and upsert; order and slices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import is_blank, trim_key
from ..staging import stage
from .slots import settled

ROW = "_row_id"


def _known(df: DataFrame, cols) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns {missing}; there are {df.columns}")


def _col(c: str):
    return F.col(f"`{c}`")


def filter_columns(df: DataFrame, keep: list[str] | None = None, omit: list[str] | None = None) -> DataFrame:
    """Some columns, in the order of the input."""
    if (keep is None) == (omit is None):
        raise ValueError("give keep or omit")
    _known(df, keep or omit or [])
    names = [c for c in df.columns if (c in keep if keep is not None else c not in omit)]
    if not names:
        raise ValueError("no column would be left")
    return df.select(*map(_col, names))


def rename_columns(df: DataFrame, keep: list[str] | None = None, omit: list[str] | None = None, reorder: bool = False) -> DataFrame:
    """``keep``: SRC or SRC:DEST, the first of a SRC counts; in their own order if ``reorder``."""
    if omit is not None:
        return filter_columns(df, omit=omit)
    specs: dict[str, str] = {}
    for s in keep or []:
        src, _, dest = s.partition(":")
        specs.setdefault(src, dest or src)
    _known(df, specs)
    names = list(specs) if reorder else [c for c in df.columns if c in specs]
    return df.select(*(_col(c).alias(specs[c]) for c in names))


def reorder_columns(df: DataFrame, order: list[str]) -> DataFrame:
    if not order:
        raise ValueError("no columns given")
    _known(df, order)
    return df.select(*map(_col, [*order, *(c for c in df.columns if c not in order)]))


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def filter_rows(df: DataFrame, cols: list[str], match: str = "any", state: str = "non-empty") -> DataFrame:
    _known(df, cols)
    tests = [is_blank(_col(c)) if state == "blank" else ~is_blank(_col(c)) for c in cols]
    return df.filter(reduce((lambda a, b: a | b) if match == "any" else (lambda a, b: a & b), tests))


def compare_columns(df: DataFrame, first: list[str], second: list[str]) -> DataFrame:
    """Rows in which a pair of columns differs, with the pairs in ``differences``."""
    if len(first) != len(second):
        raise ValueError("lists of equal length are needed")
    _known(df, [*first, *second])
    pairs = [F.when(trim_key(_col(a)) != trim_key(_col(b)), F.lit(f"{a}≠{b}")) for a, b in zip(first, second)]
    return df.withColumn("differences", F.array_join(F.array_compact(F.array(*pairs)), "; ")).filter("differences <> ''")


def last_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key; with one shuffle and a partial aggregate, no window."""
    return _pick(df, keys, F.max, order)


def first_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    return _pick(df, keys, F.min, order)


def _pick(df: DataFrame, keys: list[str], best, order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c != order]
    picked = df.groupBy(*keys).agg(best(F.struct(_col(order), *map(_col, rest))).alias("_p"))
    return picked.select(*(_col(c) if c in keys else F.col(f"_p.`{c}`") for c in df.columns))


def merge_columns(base: DataFrame, extra: DataFrame, keys: list[str], extra_keys: list[str] | None = None, add: list[str] | None = None, renames: dict[str, str] | None = None, order: str | None = None) -> DataFrame:
    """Left join on trimmed keys that adds columns of ``extra``; its last row of a key counts.  Without ``add`` all
    columns whose new name is new are added; a named column may replace one of ``base``.  Misses are empty."""
    extra_keys, renames = extra_keys or keys, renames or {}
    _known(base, keys)
    _known(extra, [*extra_keys, *(add or [])])
    names = add if add is not None else [c for c in extra.columns if c not in extra_keys and c != order and renames.get(c, c) not in base.columns]
    if order is None:
        extra, order = extra.withColumn("_o", F.monotonically_increasing_id()), "_o"
    on = [f"_k{i}" for i in range(len(keys))]
    right = extra.select(*(trim_key(_col(c)).alias(k) for c, k in zip(extra_keys, on)), _col(order).alias("_ord"), *(_col(c).cast("string").alias(f"_x{i}") for i, c in enumerate(names)))
    right = last_wins(right, on, "_ord").drop("_ord")
    left = base.select("*", *(trim_key(_col(c)).alias(k) for c, k in zip(keys, on)))
    new = {renames.get(c, c): F.coalesce(F.col(f"_x{i}"), F.lit("")) for i, c in enumerate(names)}
    out = left.join(right, on, "left")
    return out.select(*(new[c].alias(c) if c in new else _col(c) for c in base.columns), *(v.alias(k) for k, v in new.items() if k not in base.columns))


def replace_rows(tables: list[DataFrame], keys: list[str], order: str) -> DataFrame:
    """Ordered upsert: later rows replace earlier ones of their key and take their place; new keys come last."""
    first = tables[0]
    if any(set(t.columns) != set(first.columns) for t in tables):
        raise ValueError("the tables' columns differ")
    at = F.struct("_file", _col(order))
    rows = reduce(DataFrame.unionByName, (t.withColumn("_file", F.lit(i)) for i, t in enumerate(tables)))
    on = [trim_key(_col(c)).alias(f"_k{i}") for i, c in enumerate(keys)]
    best = rows.groupBy(*on).agg(F.min(at).alias("_at"), F.max(F.struct("_file", _col(order), F.struct(*map(_col, first.columns)).alias("row"))).alias("_p"))
    return best.select(F.col("_at").alias("_place"), "_p.row.*")


def _before(counts: DataFrame) -> DataFrame:
    """(_part, _before): what all earlier partitions hold; ``counts`` has a row for each partition."""
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))


def _sorted(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows sorted by range and staged with ``_at`` (partition and place in it), so that each later evaluation sees them
    where they were."""
    return stage(df.orderBy(*map(_col, order)).withColumn("_at", F.monotonically_increasing_id()), name)


def with_row_id(df: DataFrame, order: list[str]) -> DataFrame:
    """Dense ids from 0 in the given order, over many partitions: sorted by range once, counted by partition.  Rows of
    equal order get ids in an arbitrary but fixed order; an empty table gives none."""
    s = _sorted(df.drop(ROW), order, "sorted")
    part = F.shiftright("_at", 33)
    before = _before(s.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")))
    out = s.withColumn("_part", part).join(F.broadcast(before), "_part")  # a row for each partition of one exchange
    return out.withColumn(ROW, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_part", "_before", "_at")


def slice_rows(df: DataFrame, skip: int = 0, limit: int | None = None, row_id: str = ROW) -> DataFrame:
    if skip < 0 or (limit is not None and limit < 1):
        raise ValueError("skip must be at least 0 and limit at least 1")
    out = df.filter(_col(row_id) >= skip)
    return out if limit is None else out.filter(_col(row_id) < skip + limit)


#: Rows that the driver gets to choose range borders from, for each partition of an exchange.
SAMPLES_A_PARTITION = 20


def range_borders(df: DataFrame, order: str, parts: int) -> list:
    """At most ``parts`` - 1 values of ``order``, in order, that cut ``df`` into ranges of about equal size: from the values with the smallest
    hashes, so that every evaluation finds the same.  The driver gets ``SAMPLES_A_PARTITION`` values for each range, about."""
    values = df.select(_col(order).alias("v")).filter("v is not null")
    n, most = values.count(), parts * SAMPLES_A_PARTITION
    share = min(1.0, most / max(1, n))
    some = values if share == 1.0 else values.filter(F.xxhash64("v") <= int(-(2**63) + share * (2**64 - 1)))
    found = sorted(r.v for r in some.orderBy(F.xxhash64("v")).limit(2 * most).collect())
    return sorted({found[i * len(found) // parts] for i in range(1, parts)}) if found else []


def range_of(value: Column, borders: list, kind) -> Column:
    """How many of the sorted ``borders`` are not above ``value``, by bisection; 0 for null."""
    if not borders:
        return F.lit(0)
    sorted_borders = F.array(*(F.lit(b).cast(kind) for b in borders))
    steps = [1 << k for k in range(len(borders).bit_length() - 1, -1, -1)]
    higher = lambda lo, step: F.when(F.coalesce(F.get(sorted_borders, lo + step - 1) <= value, F.lit(False)), lo + step).otherwise(lo)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), higher)


def contiguous_runs(df: DataFrame, key: str, order: str, within: list[str] | None = None) -> DataFrame:
    """Number of the run of equal keys that a row belongs to, from 1 (``run``), over the whole table or ``within`` groups.

    Rows are dealt into ranges of ``order`` (and by group) in one exchange; a range's runs are numbered within it.  Its first and last key and its
    number of runs, read from the key columns alone, tell the next ranges where to go on, so that no task holds a group.  Null keys
    are equal; rows of equal order stand in the order of their keys."""
    within = within or []
    rows = settled(df.drop("run"), _range=range_of(_col(order), range_borders(df, order, max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))), df.schema[order].dataType))
    part = [*within, "_range"]
    in_order = Window.partitionBy(*map(_col, part)).orderBy(_col(order), F.struct(_col(key)))
    marked = lambda d: d.withColumns({"_new": F.when(F.lag(F.lit(True)).over(in_order).isNull(), 0).when(_col(key).eqNullSafe(F.lag(_col(key)).over(in_order)), 0).otherwise(1)})
    narrow = marked(rows.select(*map(_col, dict.fromkeys([*part, key, order]))))
    at = F.struct(_col(order), F.struct(_col(key)).alias("_k"))
    ends = narrow.groupBy(*map(_col, part)).agg(F.min(at)["_k"].alias("_first"), F.max(at)["_k"].alias("_last"), F.sum("_new").alias("_n"))
    groups = Window.partitionBy(*map(_col, within)) if within else Window.partitionBy()
    ranges = groups.orderBy("_range")  # a row for each range of a group
    before = F.lag("_last").over(ranges)
    ends = ends.withColumn("_opens", (~before.eqNullSafe(F.col("_first"))).cast("int")).withColumn("_n", F.col("_n") + F.col("_opens"))
    ends = ends.withColumns({"_before": F.coalesce(F.sum("_n").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    right = ends.select(*(_col(c).alias(f"_g{i}") for i, c in enumerate(part)), "_opens", "_before")
    up = in_order.rowsBetween(Window.unboundedPreceding, 0)
    runs = marked(rows).withColumn("_run", F.sum("_new").over(up))
    out = runs.join(right, reduce(lambda a, b: a & b, (_col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(part))))
    return out.select(*(_col(c) for c in df.columns if c != "run"), (F.col("_before") + F.col("_opens") + F.col("_run")).alias("run"))


def group_rows(df: DataFrame, group: str, sequence: str, order: str) -> DataFrame:
    """Groups by ``group``, or by ``sequence`` where that is blank, wherever their rows are: the first row's
    sequence, whether others differ, and the number of rows."""
    key = F.when(is_blank(_col(group)), trim_key(_col(sequence))).otherwise(trim_key(_col(group)))
    return df.groupBy(key.alias("group_key")).agg(
        F.min(F.struct(_col(order), _col(sequence)))[sequence].alias("first_sequence"), (F.countDistinct(_col(sequence)) > 1).alias("sequences_differ"), F.count("*").alias("n_rows")
    )


def run_report(df: DataFrame, **counted) -> DataFrame:
    """One row: the number of rows, and of those for which each of ``counted`` (name=condition) holds; null conditions do
    not.  An empty table counts 0."""
    return df.agg(F.count("*").alias("n_rows"), *(F.count_if(c).alias(k) for k, c in counted.items()))


def distinct_keys(df: DataFrame, col: str) -> DataFrame:
    """The distinct trimmed values of a column that are not blank, as ``key``."""
    return df.select(trim_key(_col(col)).alias("key")).filter("key <> ''").distinct()
