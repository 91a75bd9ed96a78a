"""Column expressions: blanks, keys, candidate lists, accessions and HGVS parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accession versions of chromosomes 1-22, X, Y by build, and the mitochondrial one.
GRCH38 = [11, 12, 12, 12, 10, 12, 14, 11, 12, 11, 10, 12, 11, 9, 10, 10, 11, 10, 10, 11, 9, 11, 11, 10]
GRCH37 = [10, 11, 11, 11, 9, 11, 13, 10, 11, 10, 9, 11, 10, 8, 9, 9, 10, 9, 9, 10, 8, 10, 10, 9]
MITOCHONDRIAL = "NC_012920.1"
CHROMOSOMES = [*map(str, range(1, 23)), "X", "Y"]
# Amino acids by three-letter and one-letter code.
AMINO = dict(zip("Ala Arg Asn Asp Cys Gln Glu Gly His Ile Leu Lys Met Phe Pro Ser Thr Trp Tyr Val Ter Sec Pyl".split(), "ARNDCQEGHILKMFPSTWYV*UO"))
#: Values that say that there is no HGVS string (fixed values).
NO_HGVS = ["", "NA", "N/A", "None", "none", "_wt", "_sy", "="]


def literal_map(d: dict) -> Column:
    return F.create_map(*(F.lit(x) for kv in d.items() for x in kv))


def trim_key(c: Column) -> Column:
    """Null as empty, white space of any kind stripped."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return trim_key(c) == ""


def has_hgvs(c: Column) -> Column:
    return ~trim_key(c).isin(NO_HGVS)


def to_long(c: Column) -> Column:
    """A whole number, or null.  Text of another form is set aside before the cast, whose failures cost an exception a row."""
    return F.when(c.cast("string").rlike(r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"), c).try_cast("long")


def to_double(c: Column) -> Column:
    """A number (NaN and infinity are some), or null; text without a digit is set aside before the cast."""
    return F.when(c.cast("string").rlike("[0-9]|(?i)nan|(?i)inf"), c).try_cast("double")


def bases(c: Column) -> Column:
    """Bases in upper case; cheaper than ``upper``, which knows all of Unicode."""
    return F.translate(c, "acgtn", "ACGTN")


def first_non_blank(*cols: Column) -> Column:
    """The first trimmed value that is not empty; empty if there is none."""
    return F.coalesce(*(F.nullif(trim_key(c), F.lit("")) for c in cols), F.lit(""))


def append_error(c: Column, message: Column) -> Column:
    return F.when(is_blank(c), message).when(F.contains(c, message), c).otherwise(F.concat_ws("; ", c, message))


# --- candidate lists -------------------------------------------------------------------------


def split_slots(c: Column) -> Column:
    """The slots of a candidate list, trimmed; empty slots stay, and an empty cell is one slot."""
    return F.transform(F.split(F.coalesce(c, F.lit("")), r"\|", -1), trim_key)


def split_values(c: Column) -> Column:
    return F.filter(split_slots(c), lambda x: x != "")


def join_slots(values: Column) -> Column:
    """Candidate list text of an array; nulls are empty slots."""
    return F.array_join(F.transform(values, lambda x: F.coalesce(x.cast("string"), F.lit(""))), "|")


def zip_slots(**cols: Column) -> Column:
    """Arrays of structs, aligned by index; short lists are filled with empty slots."""
    n = F.greatest(*(F.size(c) for c in cols.values()), F.lit(1)) if len(cols) > 1 else F.size(next(iter(cols.values())))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(*(F.coalesce(F.get(c, i), F.lit("")).alias(k) for k, c in cols.items())))


def any_slot(c: Column, test) -> Column:
    return F.exists(split_slots(c), test)


# --- accessions and ids ----------------------------------------------------------------------


def nc_to_chrom(accession: Column, build: str = "grch38") -> Column:
    """Chromosome of a versioned accession (1-22, X, Y, MT); null for others."""
    versions = GRCH38 if build.lower() == "grch38" else GRCH37
    table = {f"NC_{i:06d}.{v}": c for i, (c, v) in enumerate(zip(CHROMOSOMES, versions), 1)}
    return F.element_at(literal_map(table | {MITOCHONDRIAL: "MT"}), accession)


def chromosome_of(accession: Column) -> Column:
    """Chromosome by the accession without its version (M for the mitochondrial one); empty for others."""
    table = {f"NC_{i:06d}": c for i, c in enumerate(CHROMOSOMES, 1)} | {"NC_012920": "M"}
    return F.coalesce(F.element_at(literal_map(table), F.substring(accession, 1, 9)), F.lit(""))


def accession_of(hgvs: Column) -> Column:
    return F.when(F.contains(hgvs, F.lit(":")), F.trim(F.substring_index(hgvs, ":", 1))).otherwise("")


def is_transcript(accession: Column) -> Column:
    return accession.rlike("^(NM_|NR_|XM_|XR_|ENST|LRG_)")


def is_protein(accession: Column) -> Column:
    return accession.rlike("^(NP_|XP_|YP_|WP_)")


def transcript_sort_key(accession: Column) -> Column:
    """(class rank, newest version first, text): NM_, NR_, XM_, XR_, ENST, LRG_, others."""
    rank = reduce(lambda c, x: c.when(accession.startswith(x[1]), x[0]), enumerate(["NM_", "NR_", "XM_", "XR_", "ENST", "LRG_"]), F)
    version = F.coalesce(F.regexp_extract(accession, r"\.(\d+)$", 1).try_cast("int"), F.lit(0))
    return F.struct(rank.otherwise(6).alias("rank"), (-version).alias("newest"), accession.alias("accession"))


def normalize_caid(c: Column) -> Column:
    """Letters and a number without leading zeros; other text as it is."""
    return F.regexp_replace(trim_key(c), r"^([A-Za-z]+)0*(\d+)$", "$1$2")


def allele_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws(":", F.when(chrom.startswith("chr"), chrom).otherwise(F.concat(F.lit("chr"), chrom)), pos.cast("string"), ref, alt)


def registry_id(at_id: Column, id_: Column) -> Column:
    """Last path part of ``@id``, else ``id``; placeholders (``_:``) are null."""
    found = F.element_at(F.split(first_non_blank(at_id, id_), "/"), -1)
    return F.when((found != "") & ~found.startswith("_:"), found)


def allele_type(id_: Column) -> Column:
    return F.when(id_.startswith("CA"), "CA").when(id_.startswith("PA"), "PA").otherwise("unknown")


def score_set_of(urn: Column) -> Column:
    """What stands before the last ``#``; null if there is none."""
    return F.nullif(F.regexp_extract(trim_key(urn), r"^(.*)#[^#]*$", 1), F.lit(""))


def strip_gene_symbol(hgvs: Column) -> Column:
    return F.regexp_replace(hgvs, r"^([^():]+)\([^()]*\):", "$1:")


def hgvs_expressions(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), trim_key), lambda x: F.contains(x, F.lit(":")))


# Stars by review status, in the order in which prefixes are tried.
STARS = {
    "practice guideline": 4,
    "reviewed by expert panel": 3,
    "criteria provided, multiple submitters, no conflicts": 2,
    "criteria provided, conflicting classifications": 1,
    "criteria provided, conflicting interpretations": 1,
    "criteria provided, single submitter": 1,
    "no assertion criteria provided": 0,
    "no assertion provided": 0,
    "no classifications from unflagged records": 0,
    "no classification for the single variant": 0,
    "no classification provided": 0,
}


def stars(status: Column) -> Column:
    """Stars of a review status as text: by the whole phrase, else by the first that it starts with."""
    s = F.lower(trim_key(status))
    whole = F.element_at(literal_map(STARS), s)
    prefix = reduce(lambda c, kv: c.when(s.startswith(kv[0]), kv[1]), STARS.items(), F)
    return F.coalesce(F.coalesce(whole, prefix).cast("string"), F.lit(""))


def dash_to_blank(c: Column) -> Column:
    v = trim_key(c)
    return F.when(v == "-", "").otherwise(v)


def fmt4(c: Column) -> Column:
    """Four decimals; null stays null.  Ordinary values go by a decimal, which is much cheaper than a format; the format takes what has no
    such decimal and what is written with the sign of a zero."""
    v = c.cast("double")
    plain = ((v > 0) | (v <= -0.0001)) & (F.abs(v) < 1e9)
    zero = F.when(v.cast("string") == "-0.0", "-0.0000").otherwise("0.0000")
    return F.when(plain, v.cast("decimal(14,4)").cast("string")).when(v == 0, zero).when(v.isNotNull(), F.format_string("%.4f", v))


# --- HGVS ------------------------------------------------------------------------------------


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGTacgt", "TGCAtgca"))


def aa3to1(c: Column) -> Column:
    known = F.element_at(literal_map({k.lower(): v for k, v in AMINO.items()}), F.lower(c))
    return F.coalesce(known, F.upper(c))


def aa1to3(c: Column) -> Column:
    return F.coalesce(F.element_at(literal_map({v: k for k, v in AMINO.items()}), F.upper(c)), c)


def normalize_protein(c: Column) -> Column:
    """One-letter protein changes in three letters: ``=`` repeats the amino acid, ``*`` is Ter and ``-`` del; other
    text is left as it is."""
    v = trim_key(c)
    form = r"^(.*:)?p\.\(?([ARNDCQEGHILKMFPSTWYVUO*])(\d+)(fs|del|dup|ins|ext|[ARNDCQEGHILKMFPSTWYVUO*=-])([^)]*)\)?$"
    ref, pos, alt, rest = (F.regexp_extract(v, form, i) for i in (2, 3, 4, 5))
    new = F.when(alt == "=", aa1to3(ref)).when(alt == "-", "del").when(alt.isin("fs", "del", "dup", "ins", "ext"), alt).otherwise(aa1to3(alt))
    return F.when(v.rlike(form), F.concat(F.regexp_extract(v, form, 1), F.lit("p."), aa1to3(ref), pos, new, rest)).otherwise(c)


_POS = r"([*-]?\d+(?:[+-]\d+)?)(?:_([*-]?\d+(?:[+-]\d+)?))?"
_LETTERS = "[ACGTNacgtn]"
# start, stop | ref > alt | del ref ins alt | del, dup or inv, ref | ins alt | =
_NUCLEOTIDE = rf"^(?:.*:)?[cgnm]\.{_POS}(?:({_LETTERS}+)>({_LETTERS}+)|(del)({_LETTERS}*)ins({_LETTERS}+)|(del|dup|inv)({_LETTERS}*)|ins({_LETTERS}+)|(=))$"
# first, position | last, position | edit
_PROTEIN = r"^([A-Za-z*]{1,3})(\d+)(?:_([A-Za-z*]{1,3})(\d+))?(.*)$"


def groups(c: Column, pattern: str, n: int) -> Column:
    """The ``n`` groups of a pattern that spans the text, as an array, with one pass of it; null without a match."""
    parts = F.split(F.regexp_replace(c, pattern, "\u0001".join(f"${i}" for i in range(1, n + 1))), "\u0001", -1)
    return F.get(F.filter(F.array(parts), lambda p: F.size(p) == n), F.lit(0))  # one pass wherever it is read


def once(c: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is read there."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def nucleotide_groups(hgvs: Column) -> Column:
    return groups(trim_key(hgvs), _NUCLEOTIDE, 11)


def nucleotide_change(p: Column, with_kind: bool = True) -> Column:
    """struct(start, stop, ref, alt, kind) of ``nucleotide_groups``; nulls without a match."""
    at = lambda i: F.get(p, F.lit(i))
    up = lambda i: bases(at(i))
    sub, delins, kind, named, ins = at(2) != "", at(4) != "", at(7), up(8), at(9) != ""
    bare = named == ""
    ref = F.when(sub, up(2)).when(delins, up(5)).when(ins | (at(10) != ""), "").otherwise(named)
    alt = (
        F.when(sub, up(3)).when(delins, up(6)).when(ins, up(9)).when(kind == "dup", F.when(bare, "dup").otherwise(F.concat(named, named)))
        .when(kind == "inv", F.when(bare, "inv").otherwise(reverse_complement(named))).otherwise("")
    )
    what = F.when(sub, "sub").when(delins, "delins").when(ins, "ins").when(kind != "", kind).otherwise("=")
    on = lambda v: F.when(p.isNotNull(), v)
    stop = F.when(at(1) == "", at(0)).otherwise(at(1))
    parts = [at(0).alias("start"), stop.alias("stop"), on(ref).alias("ref"), on(alt).alias("alt")]
    return F.struct(*parts, *([on(what).alias("kind")] if with_kind else []))


def parse_nucleotide(hgvs: Column) -> Column:
    """struct(start, stop, ref, alt) of a genomic or coding change; nulls if it has no such form."""
    return once(nucleotide_groups(hgvs), lambda p: nucleotide_change(p, False))


def protein_groups(hgvs: Column) -> Column:
    change = F.regexp_replace(F.regexp_extract(trim_key(hgvs), r"^(?:.*:)?p\.(.*)$", 1), r"^\((.*)\)$", "$1")
    return groups(change, _PROTEIN, 5)


def protein_change(p: Column) -> Column:
    """struct(start, stop, ref, alt) of ``protein_groups``; what follows an unknown edit is null."""
    at = lambda i: F.get(p, F.lit(i))
    edit, ranged = at(4), at(2) != ""
    first = aa3to1(at(0))
    known = F.when(ranged, F.concat_ws("_", first, aa3to1(at(2)))).otherwise(first)
    ins, fs, sub = edit.startswith("ins") & ~ranged, edit.startswith("fs") & ~ranged, edit.rlike(r"^[A-Za-z*]{1,3}$") & ~ranged
    alt = (
        F.when(edit == "=", known).when(edit.startswith("delins"), aa3to1(F.substr(edit, F.lit(7)))).when(edit.startswith("del"), "").when(edit.startswith("dup"), F.concat(known, known))
        .when(ins, aa3to1(F.substr(edit, F.lit(4)))).when(fs, "fs").when(sub, aa3to1(edit))
    )
    ref = F.when(ins, "").when(~ranged | alt.isNotNull(), known)
    return F.struct(at(1).alias("start"), F.when(ranged, at(3)).otherwise(at(1)).alias("stop"), ref.alias("ref"), alt.alias("alt"))


def parse_protein(hgvs: Column) -> Column:
    """struct(start, stop, ref, alt) of a protein change in one-letter codes; nulls for other forms."""
    return once(protein_groups(hgvs), protein_change)


_INTRONIC = r"^[*-]?\d+[+-]\d+$"


def touches_intron(start: Column, stop: Column) -> Column:
    return F.coalesce(start.rlike(_INTRONIC), F.lit(False)) | F.coalesce(stop.rlike(_INTRONIC), F.lit(False))


def spans_intron(start: Column, stop: Column) -> Column:
    """Both ends lie in one intron, from its first exon's side to its last's."""
    p = r"^([*-]?)(\d+)([+-])(\d+)$"
    a, b = ([F.regexp_extract(c, p, i) for i in (1, 2, 3)] for c in (start, stop))
    near = F.abs(to_long(a[1]) - to_long(b[1])) == 1
    return F.coalesce(start.rlike(p) & stop.rlike(p) & (a[0] == b[0]) & (a[2] != b[2]) & near, F.lit(False))


def snv_of(hgvs: Column, build: str = "grch38") -> Column:
    """struct(chrom, pos, ref, alt) of a single-base genomic substitution on a known accession, else null."""
    return once(groups(trim_key(hgvs), r"^(NC_\d+\.\d+):g\.(\d+)([ACGT])>([ACGT])$", 4), lambda p: snv_parts(p, build))


def snv_parts(p: Column, build: str) -> Column:
    chrom, (pos, ref, alt) = nc_to_chrom(F.get(p, F.lit(0)), build), (F.get(p, F.lit(i)) for i in (1, 2, 3))
    return F.when(chrom.isNotNull(), F.struct(chrom.alias("chrom"), to_long(pos).alias("pos"), ref.alias("ref"), alt.alias("alt")))


def haplotype_components(hgvs: Column) -> Column:
    """The substitutions of ``[acc:]c.[a;b;...]``, upper-cased; null unless there are two or more plain ones."""
    inner = F.regexp_extract(trim_key(hgvs), r"^(?:[^:]+:)?c\.\[([^\]]*;[^\]]*)\]$", 1)
    parts = F.transform(F.filter(F.split(inner, ";"), lambda x: F.trim(x) != ""), lambda x: F.upper(F.trim(x)))
    return F.when((F.size(parts) >= 2) & F.forall(parts, lambda x: x.rlike(r"^\d+[ACGTN]>[ACGTN]$")), parts)


def _field(i: int):
    return lambda f: F.get(f, F.lit(i))


SPLICE_FIELDS = ("ds_ag", "ds_al", "ds_dg", "ds_dl", "dp_ag", "dp_al", "dp_dg", "dp_dl")


def spliceai_numbers(info: Column, alt: Column | None = None) -> Column:
    """The eight numbers of each usable entry of ``SpliceAI=`` as an array.  With ``alt`` (where it is not null) only that allele's entries count."""
    entries = F.split(F.regexp_extract(info, r"SpliceAI=([^;\s]+)", 1), ",")
    fields = F.filter(F.transform(entries, lambda e: F.split(e, r"\|", -1)), lambda f: F.size(f) >= 10)
    if alt is not None:
        fields = F.filter(fields, lambda f: alt.isNull() | (F.get(f, 0) == alt))
    numbers = F.transform(fields, lambda f: F.transform(F.slice(f, 3, 8), to_double))
    return F.filter(numbers, lambda f: F.forall(f, lambda x: x.isNotNull() & ~F.isnan(x)))


def spliceai_best(numbers: Column) -> dict[str, Column]:
    """The largest value of each field; null without an entry."""
    one, alone = F.get(numbers, F.lit(0)), F.size(numbers) == 1  # as a rule there is one
    return {n: F.when(alone, F.get(one, F.lit(i))).otherwise(F.array_max(F.transform(numbers, _field(i)))) for i, n in enumerate(SPLICE_FIELDS)}


def spliceai_info(info: Column, alt: Column | None = None) -> Column:
    """Largest value of each field over the entries of ``SpliceAI=``: struct(ds_ag, ds_al, ds_dg, ds_dl, dp_ag, dp_al, dp_dg, dp_dl,
    max); null without a usable entry.  With ``alt`` (where it is not null) only that allele's entries count."""

    def found(numbers: Column) -> Column:
        best = spliceai_best(numbers)
        return F.when(F.size(numbers) > 0, F.struct(*(b.alias(n) for n, b in best.items()), F.greatest(*(best[n] for n in SPLICE_FIELDS[:4])).alias("max")))

    # a list of one, so that the entries are parsed once and read by all fields
    return F.get(F.transform(F.array(spliceai_numbers(info, alt)), found), F.lit(0))


def max_of_list(c: Column) -> Column:
    """The largest number of a ``;`` list, without ``.``, blanks and text."""
    numbers = F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda x: to_double(F.trim(x)))
    return F.array_max(F.filter(numbers, lambda x: x.isNotNull() & ~F.isnan(x)))
