"""The candidate-list kernel: explode once, join on the long layer, pack once.

The long layer has one row for each slot: the row's id, the slot's number and its values, never
the wide row.  Ids must be the same whenever the frame is evaluated, so they are a key of the table or staged.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import is_blank, join_slots, trim_key
from ..staging import stage

ROW, SLOT = "_row_id", "_slot"


def _col(c: str) -> Column:
    return F.col(f"`{c}`")


def keyed(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """``df`` with a row id: its own, or ``key`` (columns that are unique together), or else numbers that are staged
    with the rows."""
    if ROW in df.columns:
        return df
    if key:
        return df.withColumn(ROW, _col(key[0]) if len(key) == 1 else F.struct(*map(_col, key)))
    return stage(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")


def computed(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with columns in a projection of their own: what is read more than once above it is not computed again."""
    return df.withColumns(values)


def spread(df: DataFrame, struct: Column, *names: str) -> DataFrame:
    """``df`` with the fields of a struct as columns ``names``; nulls where it is null."""
    df = df.withColumn("_spread", struct)
    fields = df.schema["_spread"].dataType.names
    return df.select(*(_col(c) for c in df.columns if c not in ("_spread", *names)), *(F.col(f"_spread.{f}").alias(n) for f, n in zip(fields, names)))


def settled(df: DataFrame, **values: Column) -> DataFrame:
    """As ``computed``, behind a border: the columns come out of a generator, below which no filter is pushed.  For branches that filter by
    what was computed, which else repeat the whole computation within their filters."""
    return df.select("*", F.inline(F.array(F.struct(*(v.alias(k) for k, v in values.items())))))


def _lists(c: str) -> Column:
    return F.split(F.coalesce(_col(c), F.lit("")), r"\|", -1)


def explode_slots(df: DataFrame, **lists: str) -> DataFrame:
    """(row id, slot's number, slots of ``lists``: name=column): lists are aligned by index and short ones filled with
    empty slots."""
    split = df.select(ROW, *(_lists(c).alias(k) for k, c in lists.items()))
    long = split.select(ROW, F.posexplode(F.arrays_zip(*lists)).alias(SLOT, "_s"))
    return long.select(ROW, SLOT, *(trim_key(F.col("_s").getField(k)).alias(k) for k in lists))


def pack_slots(long: DataFrame, values: Mapping[str, Column | str], row_values: Mapping[str, Column] | None = None, sizes: Mapping[str, Column] | None = None) -> DataFrame:
    """(row id, one candidate list for each of ``values``, aggregates ``row_values``).  Nulls are empty slots; of a list
    with one of ``sizes`` only so many slots are kept."""
    named = {k: F.col(v) if isinstance(v, str) else v for k, v in values.items()}
    row_values, sizes = row_values or {}, sizes or {}
    # not array_sort, which makes an ordering for every comparison
    packed = F.sort_array(F.collect_list(F.struct(SLOT, *(v.cast("string").alias(f"v{i}") for i, v in enumerate(named.values())))))
    rows = long.groupBy(ROW).agg(packed.alias("_p"), *(F.max(v).alias(f"_n{k}") for k, v in sizes.items()), *(v.alias(f"_r{i}") for i, v in enumerate(row_values.values())))
    part = lambda k, c: F.slice(c, 1, F.col(f"`_n{k}`")) if k in sizes else c
    lists = (join_slots(part(k, F.col(f"_p.v{i}"))).alias(k) for i, k in enumerate(named))
    return rows.select(ROW, *lists, *(F.col(f"_r{i}").alias(k) for i, k in enumerate(row_values)))


def attach(df: DataFrame, packed: DataFrame) -> DataFrame:
    """``df`` with the packed columns of its rows; columns of these names are replaced in place."""
    new = [c for c in packed.columns if c != ROW]
    made = {c: f"_new{i}" for i, c in enumerate(new)}
    short = packed.select(ROW, *(_col(c).alias(n) for c, n in made.items()))
    return _in_place(df.join(short, ROW, "left"), df.columns, made)


def lookup(long: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a table that is unique by ``on``, the first of which is text.  Slots without a whole key match
    nothing; they are dealt out by their own number, not gathered as one null key."""
    kinds = dict(long.dtypes)
    whole = reduce(lambda a, b: a & b, (F.coalesce(F.col(c) != "", F.lit(False)) if kinds[c] == "string" else F.col(c).isNotNull() for c in on))
    apart = F.concat(F.lit("\u0000"), F.xxhash64(ROW, SLOT).cast("string"))
    return long.withColumn(on[0], F.when(whole, F.col(on[0])).otherwise(apart)).join(table, on, "left")


@dataclass(frozen=True)
class Step:
    """An annotation of slots.  ``apply`` gets the long layer with the slots of ``lists`` (name -> list column, or one that
    an earlier step of the chain made) and adds columns.  ``values`` of them become list columns; ``row_values`` (column of
    the long layer, aggregate) become columns of the row.  A list has as many slots as the longest of ``sized_by`` (all
    of ``lists`` by default).  ``before`` and ``after`` work on the wide rows."""

    lists: Mapping[str, str]
    apply: Callable[[DataFrame], DataFrame]
    values: Mapping[str, Column | str] = field(default_factory=dict)
    row_values: Mapping[str, tuple[str, Callable[[Column], Column]]] = field(default_factory=dict)
    sized_by: tuple[str, ...] = ()
    before: Callable[[DataFrame], DataFrame] | None = None
    after: Callable[[DataFrame], DataFrame] | None = None


def run_steps(long: DataFrame, steps: tuple[Step, ...], at: dict[str, str], size: dict[str, Column]) -> tuple[DataFrame, dict[str, str], dict[str, Column], dict[str, Column]]:
    """Runs steps over a long layer.  ``at``: its column for each list column, ``size``: the list's number of slots; both come back with what
    the steps have made, besides the aggregates for the row."""
    totals: dict[str, Column] = {}
    for i, s in enumerate(steps):
        base = long.columns
        found = s.apply(long.withColumns({k: F.col(at[c]) for k, c in s.lists.items()}))
        values = {c: (F.col(v) if isinstance(v, str) else v).alias(f"_v{i}_{j}") for j, (c, v) in enumerate(s.values.items())}
        sums = {c: F.col(v).alias(f"_w{i}_{j}") for j, (c, (v, _)) in enumerate(s.row_values.items())}
        long = found.select(*base, *values.values(), *sums.values())
        by = [size[s.lists[k]] for k in (s.sized_by or s.lists)]
        size = size | dict.fromkeys(values, F.greatest(*by) if len(by) > 1 else by[0])
        at = at | {c: f"_v{i}_{j}" for j, c in enumerate(values)}
        totals |= {c: how(F.col(f"_w{i}_{j}")) for j, (c, (_, how)) in enumerate(s.row_values.items())}
    return long, at, size, totals


def _list_columns(steps: tuple[Step, ...]) -> list[str]:
    """The list columns that steps read of the rows: all but those that an earlier step makes."""
    read, made = [], set()
    for s in steps:
        read += [c for c in s.lists.values() if c not in made and c not in read]
        made |= set(s.values)
    return read


def _annotated(rows: DataFrame, steps: tuple[Step, ...]) -> DataFrame:
    """(row id, what ``steps`` make): the rows' lists exploded once and packed once."""
    read = {c: f"_l{i}" for i, c in enumerate(_list_columns(steps))}  # list column -> its name in the long layer
    size = {c: F.col(f"_n{i}") for i, c in enumerate(read)}
    split = rows.select(ROW, *(_lists(c).alias(k) for c, k in read.items()))
    split = split.select("*", *(F.size(k).alias(f"_n{i}") for i, k in enumerate(read.values())))
    long = split.select(ROW, *size.values(), F.posexplode(F.arrays_zip(*read.values())).alias(SLOT, "_s"))
    long = long.select(ROW, SLOT, *size.values(), *(trim_key(F.col("_s").getField(k)).alias(k) for k in read.values()))
    long, at, size, totals = run_steps(long, steps, dict(read), size)
    lists = [c for s in steps for c in s.values]
    packed = pack_slots(long, {c: at[c] for c in lists}, totals, {c: size[c] for c in lists})
    return packed.select(ROW, *(_col(c) for s in steps for c in (*s.values, *s.row_values)))


def _annotated_by_lists(rows: DataFrame, steps: tuple[Step, ...]) -> DataFrame:
    """``rows`` with what ``steps`` make, which run once for each distinct combination of lists; rows are joined by their lists.  The
    combinations are staged with a number each, and so is what was made of them: its size is known when the join is planned."""
    read = _list_columns(steps)
    text = {f"_k{i}": F.coalesce(_col(c), F.lit("")) for i, c in enumerate(read)}
    asked = keyed(rows.select(*(v.alias(c) for v, c in zip(text.values(), read))).distinct())
    found = _annotated(asked, steps)
    made = {c: f"_new{i}" for i, c in enumerate(found.columns[1:])}
    found = asked.select(ROW, *(_col(c).alias(k) for c, k in zip(read, text))).join(found.select(ROW, *(_col(c).alias(n) for c, n in made.items())), ROW).drop(ROW)
    return _in_place(rows.withColumns(text).join(stage(found, "lists"), [*text], "left"), rows.columns, made)


def _in_place(joined: DataFrame, columns: list[str], made: Mapping[str, str]) -> DataFrame:
    """``columns`` of ``joined``, and ``made`` (column -> its name there) at their places or after them."""
    return joined.select(*(F.col(made[c]).alias(c) if c in made else _col(c) for c in columns), *(F.col(n).alias(c) for c, n in made.items() if c not in columns))


def annotate(df: DataFrame, *steps: Step, key: list[str] | None = None, by_lists: bool = False) -> DataFrame:
    """Runs steps over one long layer: lists are exploded once and packed once, however many steps there are.

    ``key``: columns that identify a row; without them (and without a row id) the rows are staged with one.  A
    null or empty list is one empty slot; repeated rows stay apart unless ``key`` makes them one.  ``by_lists``: for tables whose
    rows share their lists; each combination of lists is annotated once, and rows need neither key nor id."""
    rows = df if by_lists else keyed(df, key)
    for s in steps:
        rows = s.before(rows) if s.before else rows
    layer = tuple(s for s in steps if s.values or s.row_values)  # the others work on the wide rows alone
    if layer:
        rows = _annotated_by_lists(rows, layer) if by_lists else attach(rows, _annotated(rows, layer))
    for s in steps:
        rows = s.after(rows) if s.after else rows
    return rows if by_lists or ROW in df.columns else rows.drop(ROW)


#: Columns that hold candidate lists, besides those with these prefixes (fixed values).
LIST_COLUMNS = ["mapped_hgvs_g", "mapped_hgvs_c", "dna_clingen_allele_id", "touches_intronic_region", "spans_intron"]
LIST_PREFIXES = ("spliceai.", "clinvar.", "gnomad.")


def detect_list_columns(df: DataFrame) -> list[str]:
    def listed(c: str) -> bool:
        parts = c.split("_")
        coordinate = c.startswith("mapped_hgvs_") and len(parts) == 4 and parts[3] in ("start", "stop", "ref", "alt")
        return c in LIST_COLUMNS or c.startswith(LIST_PREFIXES) or coordinate

    return [c for c in df.columns if listed(c)]


def has_candidates(df: DataFrame, cols: list[str]) -> Column:
    test = F.lit(False)
    for c in cols:
        test = test | ~is_blank(_col(c))
    return test


def flatten_candidates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row for each candidate: rows without any go, short lists end in empty slots, other columns repeat."""
    cols = detect_list_columns(df) if cols is None else cols
    if not cols:
        raise ValueError("no candidate-list columns")
    short = {c: f"_l{i}" for i, c in enumerate(cols)}
    split = df.filter(has_candidates(df, cols)).select("*", *(_lists(c).alias(k) for c, k in short.items()))
    long = split.select(*(_col(c) for c in df.columns if c not in short), F.explode(F.arrays_zip(*short.values())).alias("_s"))
    return long.select(*(trim_key(F.col("_s").getField(short[c])).alias(c) if c in short else _col(c) for c in df.columns))
