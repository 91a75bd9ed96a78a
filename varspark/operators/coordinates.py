"""Coordinates of HGVS candidate lists, with reference bases where they are known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import accession_of, chromosome_of, nucleotide_change, nucleotide_groups, parse_nucleotide, protein_change, protein_groups, reverse_complement, spans_intron, to_long, touches_intron
from .mapping import bases_of, fetch_ref_bases
from .slots import Step, annotate, computed, settled, spread

_PARTS = ("start", "stop", "ref", "alt")


_CHANGE = ("_start", "_stop", "_ref", "_alt", "_kind")


def _parsed(long: DataFrame, column: str, found, change, names: tuple[str, ...] = _CHANGE) -> DataFrame:
    """``names``: the parts of the change of each slot, from the groups of one pattern, which runs once a slot."""
    long = computed(long, _p=F.when(F.contains(F.col(column), F.lit(":")), found(F.col(column))))
    return spread(long, F.when(F.col("_p").isNotNull(), change(F.col("_p"))), *names).drop("_p")


_UNSAID = "\u0000"


def _with_span(long: DataFrame, bases: Column | None = None) -> DataFrame:
    """``_h_start``, ``_h_stop``, ``_h_ref`` and ``_h_alt``: what the components ``_c`` make of their whole span, from ``_lo`` to ``_hi``.  Components
    are laid over the span's text one after another, so the last one counts; what none says of the reference is filled with ``bases``, those of the
    span.  Null where that is not known."""
    n = (F.col("_hi") - F.col("_lo") + 1).cast("int")

    def laid(on: Column, part: str) -> Column:
        over = lambda text, x: F.overlay(text, x[part], (x["s"] - F.col("_lo") + 1).cast("int"), F.length(x[part]))
        return F.substr(F.aggregate("_c", on, over), F.lit(1), n)

    there = F.col("_c").isNotNull()
    blank = F.repeat(F.lit(_UNSAID), n)
    if bases is None:
        long = long.withColumn("_ground", F.when(there, blank))
    else:
        long = computed(long, _said=F.when(there, laid(blank, "ref")))
        long = computed(long, _ground=F.when(there, F.when(F.contains(F.col("_said"), F.lit(_UNSAID)) & (F.length(bases) == n), bases).otherwise(blank)))
    long = computed(long, _new_ref=F.when(there, laid(F.col("_ground"), "ref")), _new_alt=F.when(there, laid(F.col("_ground"), "alt")))
    whole = there & ~F.contains(F.col("_new_ref"), F.lit(_UNSAID)) & ~F.contains(F.col("_new_alt"), F.lit(_UNSAID))
    found = {"start": F.col("_lo").cast("string"), "stop": F.col("_hi").cast("string"), "ref": F.col("_new_ref"), "alt": F.col("_new_alt")}
    return long.withColumns({f"_h_{k}": F.when(whole, v) for k, v in found.items()})


def _with_components(long: DataFrame, column: str) -> DataFrame:
    """``_c``: the changes of ``acc:g.[a;b]`` with positions as numbers; null if there are none or one is not of known form."""
    inner = F.regexp_extract(column, r"^[^:]+:g\.\[([^\]]+)\]$", 1)
    texts = F.filter(F.transform(F.split(inner, ";"), lambda x: F.trim(x)), lambda x: x != "")
    parsed = F.transform(texts, lambda x: parse_nucleotide(F.concat(F.lit("g."), x)))
    long = computed(long, _f=F.when(F.contains(F.col(column), F.lit(":g.[")), parsed))
    typed = lambda v: F.struct(to_long(v["start"]).alias("s"), to_long(v["stop"]).alias("e"), v["ref"].alias("ref"), v["alt"].alias("alt"))
    long = computed(long, _t=F.transform("_f", typed))
    ok = (F.size("_t") > 0) & F.forall("_t", lambda v: v["s"].isNotNull() & v["e"].isNotNull() & (v["e"] >= v["s"]) & v["ref"].isNotNull())
    long = computed(long, _c=F.when(ok, F.col("_t"))).drop("_f", "_t")
    return computed(long, _lo=F.array_min(F.transform("_c", lambda x: x["s"])), _hi=F.array_max(F.transform("_c", lambda x: x["e"])))


def _genomic(chunks: DataFrame | None, size: int):
    def apply(long: DataFrame) -> DataFrame:
        long = _with_components(_parsed(long, "x", nucleotide_groups, nucleotide_change), "x")
        v = {k: F.col(f"_{k}") for k in (*_PARTS, "kind")}
        if chunks is None:
            long = _with_span(long)
            return long.withColumns({f"_{k}": F.coalesce(v[k], F.col(f"_h_{k}")) for k in _PARTS})
        start, stop = to_long(v["start"]), to_long(v["stop"])
        blank = (v["ref"] == "") & v["kind"].isin("del", "dup", "inv")
        cut = v["alt"] == ""
        genomic = F.col("x").rlike(r"^[^:]+:\s*g\.")
        long = computed(long, _s=start, _e=stop, _blank=F.coalesce(genomic & blank, F.lit(False)), _cut=F.coalesce(genomic & cut, F.lit(False)), _acc=accession_of(F.col("x")))
        need = (F.col("_blank") | F.col("_cut")) & F.col("_s").isNotNull() & F.col("_e").isNotNull() & (F.col("_e") >= F.col("_s"))
        # one lookup serves all: the span and, where there is one, the base before it
        long = computed(long, _first=F.when(need, F.greatest(F.col("_s") - 1, F.lit(1))).otherwise(F.col("_lo")), _last=F.when(need, F.col("_e")).otherwise(F.col("_hi")))
        long = bases_of(long, "_acc", F.col("_first"), F.col("_last"), chunks, size)
        b, at = F.col("bases"), F.col("_first")
        own = F.when(b.isNotNull(), F.substr(b, (F.col("_s") - at + 1).cast("int"), (F.col("_e") - F.col("_s") + 1).cast("int")))
        long = computed(long, _own=own, _known=F.when(F.col("_blank"), F.coalesce(own, v["ref"])).otherwise(v["ref"]))
        long = _with_span(long, b)
        ref = F.col("_known")
        alt = F.when((v["kind"] == "inv") & (v["alt"] == "inv") & (ref != ""), reverse_complement(ref)).otherwise(v["alt"])
        anchored = F.col("_cut") & (F.col("_s") > 1) & b.isNotNull()
        anchor = F.substring(b, 1, 1)
        whole = {
            "start": F.when(anchored, (F.col("_s") - 1).cast("string")).otherwise(v["start"]), "stop": v["stop"],
            "ref": F.when(anchored, F.concat(anchor, F.when(ref != "", ref).otherwise(F.col("_own")))).otherwise(ref), "alt": F.when(anchored, anchor).otherwise(alt),
        }
        return long.withColumns({f"_{k}": F.coalesce(whole[k], F.col(f"_h_{k}")) for k in _PARTS})

    return apply


def coordinate_steps(g: str = "mapped_hgvs_g", c: str = "mapped_hgvs_c", p: str = "mapped_hgvs_p", chunks: DataFrame | None = None, size: int = 0, slot_flags: bool = False) -> list[Step]:
    """For each list the chromosome (g, p) or transcript (c), start, stop, ref and alt of its slots, and two flags of the
    row (of each slot with ``slot_flags``): whether a c. change touches or spans an intron.  With reference bases (``chunks`` of ``size``) blank refs of genomic
    deletions, duplications and inversions are read, deletions get the base before them, and gaps of ``g.[a;b]`` are filled."""
    named = lambda col: {f"{col}_{k}": F.col(f"_{k}") for k in _PARTS}
    place = chromosome_of(accession_of(F.col("x")))

    def coding(long: DataFrame) -> DataFrame:
        long = _parsed(long, "x", nucleotide_groups, nucleotide_change)
        start, stop = F.col("_start"), F.col("_stop")
        return settled(long, _touches=touches_intron(start, stop), _spans=spans_intron(start, stop))  # a method of its own: longer ones stay uncompiled

    some = lambda flag: F.coalesce(F.bool_or(flag), F.lit(False)).cast("string")
    flags = {"touches_intronic_region": "_touches", "spans_intron": "_spans"}
    by_slot = {k: F.when(F.col("x") != "", F.col(v)) for k, v in flags.items()} if slot_flags else {}
    by_row = {} if slot_flags else {k: (v, some) for k, v in flags.items()}
    return [
        Step({"x": g}, _genomic(chunks, size), {f"{g}_chromosome": place, **named(g)}),
        Step({"x": c}, coding, {f"{c}_transcript": accession_of(F.col("x")), **named(c), **by_slot}, by_row),
        Step({"x": p}, lambda long: _parsed(long, "x", protein_groups, protein_change, _CHANGE[:4]), {f"{p}_chromosome": place, **named(p)}),
    ]


def add_coordinates(df: DataFrame, g: str = "mapped_hgvs_g", c: str = "mapped_hgvs_c", p: str = "mapped_hgvs_p", chunks: DataFrame | None = None, size: int = 0, key: list[str] | None = None, by_lists: bool = False) -> DataFrame:
    return annotate(df, *coordinate_steps(g, c, p, chunks, size), key=key, by_lists=by_lists)


def vcf_anchor(alleles: DataFrame, chunks: DataFrame, size: int) -> DataFrame:
    """``alleles`` (accession, start, stop, ref, alt; start and stop numbers): deletions get the base before them, and a blank
    ``ref`` of a deletion is read from the reference.  Unchanged where bases are unknown or at the first base."""
    wanted = (F.col("alt") == "") & (F.col("start") > 1)
    out = bases_of(alleles, "accession", F.when(wanted, F.col("start") - 1), F.col("stop"), chunks, size)
    on = F.col("bases").isNotNull()
    return out.select(
        *(c for c in alleles.columns if c not in ("start", "ref", "alt")),
        F.when(on, F.col("start") - 1).otherwise(F.col("start")).alias("start"),
        F.when(on, F.col("bases")).otherwise(F.col("ref")).alias("ref"),
        F.when(on, F.substring("bases", 1, 1)).otherwise(F.col("alt")).alias("alt"),
    )


def fill_missing_ref(alleles: DataFrame, chunks: DataFrame, size: int) -> DataFrame:
    """The reference's bases for alleles (accession, start, stop, ref, kind) whose ``ref`` is blank: del, dup and inv."""
    need = (F.col("ref") == "") & F.col("kind").isin("del", "dup", "inv")
    out = bases_of(alleles, "accession", F.when(need, F.col("start")), F.col("stop"), chunks, size)
    return out.withColumn("ref", F.when(need, F.coalesce("bases", F.lit(""))).otherwise(F.col("ref"))).drop("bases")


def genomic_haplotype(rows: DataFrame, chunks: DataFrame, size: int) -> DataFrame:
    """``rows`` (id, accession, components: substitutions of ``g.[a;b]``) with the whole span, its reference and its alternative."""
    form = r"^(\d+)([ACGTN])>([ACGTN])$"
    parts = rows.select("id", "accession", F.explode("components").alias("x"))
    parts = parts.select("id", "accession", to_long(F.regexp_extract("x", form, 1)).alias("pos"), F.regexp_extract("x", form, 3).alias("base"))
    span = parts.groupBy("id", "accession").agg(F.min("pos").alias("start"), F.max("pos").alias("stop"), F.collect_set(F.struct("pos", "base")).alias("said"))
    out = fetch_ref_bases(span, chunks, size).withColumn("at", F.map_from_entries("said"))
    alt = F.array_join(F.transform(F.sequence("start", "stop"), lambda p: F.coalesce(F.element_at("at", p), F.substring(F.col("bases"), (p - F.col("start") + 1).cast("int"), F.lit(1)))), "")
    return out.select("id", "accession", "start", "stop", F.col("bases").alias("ref"), F.when(F.col("bases").isNotNull(), alt).alias("alt"))
