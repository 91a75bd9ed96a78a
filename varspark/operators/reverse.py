"""Reverse translation of protein rows: candidates of the external solver, joined and parsed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import append_error, is_blank, trim_key
from .coordinates import coordinate_steps
from .mapping import classify_assay_level, resolve_transcript
from .slots import ROW, SLOT, Step, annotate, pack_slots, run_steps, settled

G, C, P = "mapped_hgvs_g", "mapped_hgvs_c", "mapped_hgvs_p"
#: The derived columns (names are fixed values).
DERIVED = [
    *(f"{G}_{k}" for k in ("chromosome", "start", "stop", "ref", "alt")), *(f"{C}_{k}" for k in ("transcript", "start", "stop", "ref", "alt")), "touches_intronic_region", "spans_intron",
]


def reverse_translate(
    df: DataFrame, associations: DataFrame, candidates: DataFrame, errors: DataFrame, fallback_cols: tuple[str, ...] = (), level: str = "assayed_variant_level",
    chunks: DataFrame | None = None, size: int = 0, key: list[str] | None = None, by_lists: bool = False,
) -> DataFrame:
    """Protein rows without DNA strings get the candidate lists of their (transcript, p. string), and all rows the level,
    twelve columns derived from their lists, ``reverse_translation_error`` and ``reverse_translation_warnings``.

    ``associations``: (pro_ac, tx_ac); ``candidates``: (transcript, hgvs_p, ordinal, hgvs_c, hgvs_g); ``errors``: (transcript, hgvs_p,
    error), the least text of a pair counts.  A row without a transcript or without candidates gets an error after those it
    has.  Flags of introns are by slot, empty for empty slots.  One row for each of ``df``; null cells are empty.
    ``by_lists``: rows with lists of their own share them (``annotate``)."""
    blanks = {c: F.lit("") for c in (G, C, P, level, "reverse_translation_error", "reverse_translation_warnings") if c not in df.columns}
    names = [*df.columns, *blanks]
    rows = df.withColumns(blanks)
    given = F.lower(trim_key(F.col(level)))
    bare = is_blank(F.col(G)) & is_blank(F.col(C)) & ~is_blank(F.col(P))
    rows = rows.withColumn("_todo", bare & given.isin("protein", "")).withColumn(level, F.coalesce(classify_assay_level(*(F.col(c) for c in (level, G, C, P))), F.lit("")))
    rows = resolve_transcript(rows, associations, P, fallback_cols).drop("transcript_error")
    todo, has = F.col("_todo"), F.col("transcript") != ""
    rows = settled(rows, _bare=F.coalesce(todo & has, F.lit(False)))
    keep = [c for c in names if c not in DERIVED]

    # rows that ask for candidates: the candidates' own long layer is parsed, packed by pair and joined
    steps = tuple(coordinate_steps(G, C, P, chunks, size, slot_flags=True)[:2])
    pairs = derived_lists(candidates, steps)
    told = errors.groupBy(F.col("transcript").alias("_kt"), trim_key(F.col("hgvs_p")).alias("_kp")).agg(F.min("error").alias("_error"))
    asked = rows.filter("_bare").withColumns({"_kt": F.col("transcript"), "_kp": trim_key(F.col(P))})
    asked = asked.join(pairs, ["_kt", "_kp"], "left").join(told, ["_kt", "_kp"], "left")
    none = (F.coalesce("_c_list", F.lit("")) == "") & (F.coalesce("_g_list", F.lit("")) == "")
    message = F.when(~is_blank(F.col("_error")), F.col("_error")).when(none, "Reverse translation returned no candidate DNA variants")
    error = F.coalesce("reverse_translation_error", F.lit(""))
    new = {C: F.coalesce("_c_list", F.lit("")), G: F.coalesce("_g_list", F.lit("")), "reverse_translation_error": F.when(message.isNotNull(), append_error(error, message)).otherwise(error)}
    made = [c for s in steps for c in s.values]
    asked = asked.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in keep), *(F.coalesce(f"_d_{c}", F.lit("")).alias(c) for c in made))

    # the others have lists of their own, or none
    rest = rows.filter("not _bare")
    lost = F.when(todo, append_error(error, F.lit("Unable to resolve transcript accession for protein reverse translation"))).otherwise(error)
    new = {C: F.coalesce(C, F.lit("")), G: F.coalesce(G, F.lit("")), "reverse_translation_error": lost}
    rest = annotate(rest.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in keep)), *steps, key=key, by_lists=by_lists)
    return asked.unionByName(rest.select(*asked.columns))


def derived_lists(candidates: DataFrame, steps: tuple[Step, ...]) -> DataFrame:
    """(_kt, _kp, _c_list, _g_list, _d_*): for each pair of transcript and p. string its candidates in order, and what ``steps`` make of them.  A
    candidate is parsed once, however many rows share its pair, and no list is packed to be split again."""
    long = candidates.select(
        F.struct("transcript", trim_key(F.col("hgvs_p")).alias("hgvs_p")).alias(ROW), F.struct("ordinal", "hgvs_c", "hgvs_g").alias(SLOT),
        trim_key(F.col("hgvs_c")).alias("_c_in"), trim_key(F.col("hgvs_g")).alias("_g_in"), "hgvs_c", "hgvs_g",
    )
    one = F.lit(1)  # lists are as long as the pair has candidates
    long, at, _, _ = run_steps(long, steps, {C: "_c_in", G: "_g_in"}, {C: one, G: one})
    made = {f"_d_{c}": at[c] for s in steps for c in s.values}
    packed = pack_slots(long, {"_c_list": "hgvs_c", "_g_list": "hgvs_g", **made})
    return packed.select(F.col(f"{ROW}.transcript").alias("_kt"), F.col(f"{ROW}.hgvs_p").alias("_kp"), *(c for c in packed.columns if c != ROW))
