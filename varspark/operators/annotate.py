"""Annotation joins over candidate lists: each a step of the list kernel, and a function that runs the step alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import SPLICE_FIELDS, bases, first_non_blank, fmt4, groups, is_blank, max_of_list, nc_to_chrom, normalize_caid, score_set_of, snv_of, spliceai_best, spliceai_numbers, stars, strip_gene_symbol, to_long, trim_key
from ..sources.io import read_frequency_cache
from .mapping import _dealt, bases_of, validate_id_prefix
from .rank import ALLELE, argmax, frequency, max_score, number, ordered_distinct_concat, severity_rank
from .slots import ROW, SLOT, Step, annotate, computed, explode_slots, keyed, lookup


def allele_id_step(registry: DataFrame, c_col: str = "mapped_hgvs_c", g_col: str = "mapped_hgvs_g", out: str = "dna_clingen_allele_id", existing: str | None = None, raw_nt: str | None = None) -> Step:
    """Allele id of each slot by its c. string, else by its g. string; ``registry`` has (hgvs, id).  A DNA row of one slot
    with an id of its own keeps it."""
    ids = registry.filter(~F.col("id").startswith("_:")).groupBy("hgvs").agg(F.min("id").alias("id"))

    def apply(long: DataFrame) -> DataFrame:
        for c in "cg":
            long = lookup(long, ids.select(F.col("hgvs").alias(c), F.col("id").alias(f"{c}_id")), [c])
        return long

    def own(df: DataFrame) -> DataFrame:
        i = trim_key(F.col(existing))
        keep = (i != "") & ~F.contains(i, F.lit("|")) & ~is_blank(F.col(raw_nt)) & ~F.contains(F.col(out), F.lit("|"))
        return df.withColumn(out, F.when(keep, i).otherwise(F.col(out)))

    return Step({"c": c_col, "g": g_col}, apply, {out: F.coalesce("c_id", "g_id")}, after=None if existing is None else own)


def resolve_allele_ids(df: DataFrame, registry: DataFrame, c_col: str = "mapped_hgvs_c", g_col: str = "mapped_hgvs_g", out: str = "dna_clingen_allele_id", existing: str | None = None, raw_nt: str | None = None, key: list[str] | None = None) -> DataFrame:
    return annotate(df, allele_id_step(registry, c_col, g_col, out, existing, raw_nt), key=key)


def add_allele_ids(df: DataFrame, registry: DataFrame, out: str = "dna_clingen_allele_id", existing: str = "clingen_allele_id", raw_nt: str = "raw_hgvs_nt", key: list[str] | None = None, check: bool = True) -> DataFrame:
    """Ids of all candidates; a row whose own id has the wrong prefix is an error (``check``), reported by its row id (a
    number: ``key`` may name one column)."""
    rows = keyed(df, key)
    if check:
        validate_id_prefix(rows, existing, raw_nt, ROW)
    out_rows = resolve_allele_ids(rows, registry, out=out, existing=existing, raw_nt=raw_nt)
    return out_rows if ROW in df.columns else out_rows.drop(ROW)


def clinvar_step(bridge: DataFrame, summary: DataFrame, ids_col: str = "dna_clingen_allele_id", ns: str = "clinvar", version: str = "202601") -> Step:
    """Six columns by slot: ids of the variation and allele, significance, review status, its stars, last review.
    ``bridge``: (caid, variation_id, allele_id); ``summary``: (allele_id, clinical_significance, review_status, last_review_date)."""
    table = bridge.join(summary.withColumn("stars", stars(F.col("review_status"))), "allele_id", "left")
    names = ["variation_id", "allele_id", "clinical_significance", "review_status", "stars", "last_review_date"]
    return Step({"caid": ids_col}, lambda long: lookup(long, table, ["caid"]), {f"{ns}.{version}.{c}": c for c in names})


def annotate_clinvar(df: DataFrame, bridge: DataFrame, summary: DataFrame, ids_col: str = "dna_clingen_allele_id", ns: str = "clinvar", version: str = "202601", key: list[str] | None = None) -> DataFrame:
    return annotate(df, clinvar_step(bridge, summary, ids_col, ns, version), key=key)


_FREQUENCY = ["allele_count", "allele_number", "allele_frequency", "minor_allele_frequency", "faf95_max", "faf95_max_ancestry"]
COORDINATES = ("mapped_hgvs_g_chromosome", "mapped_hgvs_g_start", "mapped_hgvs_g_ref", "mapped_hgvs_g_alt")


def _with_frequency(freq: DataFrame) -> DataFrame:
    f = freq.withColumn("_f", frequency(F.col("allele_count"), F.col("allele_number"))).filter("_f is not null")
    return f.withColumn("allele_frequency", F.col("_f.af")).withColumn("minor_allele_frequency", F.col("_f.maf")).drop("_f")


def frequency_step(freq: DataFrame, mode: str = "coordinates", prefix: str = "gnomad.v4_1", ids_col: str = "dna_clingen_allele_id", coordinates: tuple[str, ...] = COORDINATES) -> Step:
    """Six frequency columns by slot: by allele (chrom, pos, ref, alt), or by ``caid``."""
    values = {f"{prefix}.{c}": c for c in _FREQUENCY}
    table = _with_frequency(freq)
    if mode != "coordinates":
        return Step({"caid": ids_col}, lambda long: lookup(long.withColumn("caid", normalize_caid(F.col("caid"))), table, ["caid"]), values)

    def apply(long: DataFrame) -> DataFrame:
        typed = long.withColumn("pos", to_long(F.col("pos"))).withColumn("chrom", F.regexp_replace("chrom", "^chr", ""))
        return lookup(typed, table, ALLELE)

    return Step(dict(zip(ALLELE, coordinates)), apply, values)


def annotate_frequency(df: DataFrame, freq: DataFrame, mode: str = "coordinates", prefix: str = "gnomad.v4_1", ids_col: str = "dna_clingen_allele_id", coordinates: tuple[str, ...] = COORDINATES, key: list[str] | None = None) -> DataFrame:
    """As ``frequency_step``; by ``caid`` also where a coordinate column is missing."""
    if any(c not in df.columns for c in coordinates):
        mode = "caid"
    return annotate(df, frequency_step(freq, mode, prefix, ids_col, coordinates), key=key)


def wanted_places(df: DataFrame, chrom: str = COORDINATES[0], pos: str = COORDINATES[1]) -> DataFrame:
    """(chrom, pos) of the rows' slots, for readers that open what is needed only."""
    long = explode_slots(df.withColumn(ROW, F.lit(0)), chrom=chrom, pos=pos)
    return long.select("chrom", to_long(F.col("pos")).alias("pos")).filter("chrom <> '' and pos is not null").distinct()


def annotate_frequency_from_cache(df: DataFrame, path: str, prefix: str = "gnomad.v4_1", coordinates: tuple[str, ...] = COORDINATES, key: list[str] | None = None) -> DataFrame:
    """As ``annotate_frequency`` by coordinates over a cache of ``write_frequency_cache``: of it, the blocks with the rows' places are read."""
    freq = read_frequency_cache(df.sparkSession, path, wanted_places(df, *coordinates[:2]))
    return annotate_frequency(df, freq, "coordinates", prefix, coordinates=coordinates, key=key)


def id_to_coords(df: DataFrame, ids_col: str, coordinates: dict[str, str]) -> DataFrame:
    """(caid, chrom, pos, ref, alt) from the rows' own slots, one allele for each id."""
    rows = df.withColumn(ROW, F.lit(0))  # the rows' ids are not used
    long = explode_slots(rows, caid=ids_col, **coordinates)
    long = long.withColumn("caid", normalize_caid(F.col("caid"))).withColumn("pos", to_long(F.col("pos")))
    long = long.filter("caid <> '' and chrom <> '' and pos is not null and ref <> '' and alt <> ''")
    return long.groupBy("caid").agg(F.min(F.struct(*ALLELE)).alias("a")).select("caid", "a.*")


_SPLICE = {**{c: c for c in ("ds_ag", "ds_al", "ds_dg", "ds_dl", "dp_ag", "dp_al", "dp_dg", "dp_dl")}, "max_delta_score": "max"}
# accession | start, stop | ref > alt | kind, bases
_GENOMIC = r"^(NC_\d+\.\d+):g\.(\d+)(?:_(\d+))?(?:([ACGTacgt]+)>([ACGTacgt]+)|(delins|del|dup|ins)([ACGTacgt]*))$"


def hgvs_g_to_vcf(long: DataFrame, g: str = "g", build: str = "grch38", chunks: DataFrame | None = None, size: int = 0) -> DataFrame:
    """Adds chrom, pos, ref and alt of genomic strings, and what a shape needs: _kind, _len and _seq.  ``ref`` and ``alt`` of
    substitutions are in the string; those of deletions, insertions and duplications (with the base before them as anchor)
    are read from ``chunks`` and null where bases are unknown.  Other text has null chrom."""
    part = [F.get("_p", F.lit(i)) for i in range(7)]
    start = to_long(part[1])
    stop, kind, seq, sub = F.coalesce(to_long(part[2]), start), part[5], bases(part[6]), part[3] != ""
    ranged = part[2] != ""
    # fixed forms: no range of a substitution, one of an insertion; bases only where something is inserted
    ok = F.when(sub, ~ranged).when(kind == "ins", ranged & (seq != "")).when(kind == "delins", seq != "").otherwise(seq == "")
    out = computed(long, _p=groups(F.col(g), _GENOMIC, 7))
    out = computed(out, chrom=F.when(ok, nc_to_chrom(part[0], build)), _acc=part[0], _start=start, _stop=stop, _kind=F.when(sub, "sub").otherwise(kind), _seq=seq, _ref=bases(part[3]), _alt=bases(part[4]))
    k = F.col("_kind")
    pos = F.when(k.isin("del", "dup"), F.col("_start") - 1).otherwise(F.col("_start"))
    out = computed(out, pos=F.when(F.col("chrom").isNotNull(), pos), _len=F.col("_stop") - F.col("_start") + 1)
    if chunks is None:
        b = F.lit(None).cast("string")
    else:
        end = F.when(k == "ins", F.col("_start")).otherwise(F.col("_stop"))
        out, b = bases_of(out, "_acc", F.when((k != "sub") & (F.col("pos") > 0), F.col("pos")), end, chunks, size), F.upper("bases")
    first = F.substring(b, 1, 1)
    ref = F.when(k == "sub", F.col("_ref")).when(k == "dup", first).otherwise(b)
    alt = F.when(k == "sub", F.col("_alt")).when(k == "del", first).when(k == "ins", F.concat(b, "_seq")).when(k == "dup", b).when(b.isNotNull(), F.col("_seq"))
    gone = {"_p", "_acc", "_start", "_stop", "_ref", "_alt", "bases"}
    return out.select(*(c for c in out.columns if c not in gone), F.when(F.col("chrom").isNotNull(), ref).alias("ref"), F.when(F.col("chrom").isNotNull(), alt).alias("alt"))


def splice_places(scores: DataFrame) -> DataFrame:
    """(chrom, pos, found): the entries of each position, best first: lowest file, bare chromosome before ``chr``, first line.  A position
    has a handful of alleles in a file, so the lists are short; unique by position, the table joins like any other lookup."""
    entry = F.struct("file_rank", F.col("chrom").startswith("chr").cast("int").alias("chr"), "line", F.col("ref").alias("r"), F.col("alt").alias("a"), "info")
    places = scores.select(F.regexp_replace("chrom", "^chr", "").alias("chrom"), "pos", entry.alias("_e"))
    return places.groupBy("chrom", "pos").agg(F.sort_array(F.collect_list("_e")).alias("found"))


def spliceai_step(scores: DataFrame, g_col: str = "mapped_hgvs_g", build: str = "grch38", chunks: DataFrame | None = None, size: int = 0) -> Step:
    """Nine columns by slot from ``scores`` (file_rank, line, chrom, pos, ref, alt, info): the first file, bare chromosome
    before ``chr``, first line.  Alleles match exactly where they are known (entries of that allele count); deletions,
    insertions and duplications without reference bases (``chunks`` of ``size``) match by position and allele lengths.  Slots are joined
    once, by position, to a table that has one row for each; which entry fits is settled within the row."""
    table = splice_places(scores)
    k, exact = F.col("_kind"), F.col("ref").isNotNull()

    def fits(e: Column) -> Column:
        r, a, n, m = e["r"], e["a"], F.length(e["r"]), F.length(e["a"])
        by_shape = (
            F.when(k == "del", (n == F.col("_len") + 1) & (m == 1)).when(k == "ins", (n == 1) & (a == F.concat(r, "_seq")))
            .when(k == "delins", (n == F.col("_len")) & (a == F.col("_seq"))).when(k == "dup", (n == 1) & (m == F.col("_len") + 1))
        )
        return F.coalesce(F.when(exact, (r == F.col("ref")) & (a == F.col("alt"))).otherwise(by_shape), F.lit(False))

    def apply(long: DataFrame) -> DataFrame:
        placed = lookup(hgvs_g_to_vcf(long, "g", build, chunks, size), table, ["chrom", "pos"])
        hit = computed(placed, _info=F.get(F.transform(F.filter("found", fits), lambda e: e["info"]), F.lit(0)))
        hit = computed(hit, _n=F.when(F.col("_info").isNotNull(), spliceai_numbers(F.col("_info"), F.when(exact, F.col("alt")))))
        best = computed(hit, **{f"_{f}": v for f, v in spliceai_best(F.col("_n")).items()})
        return best.withColumn("_max", F.greatest(*(F.col(f"_{f}") for f in SPLICE_FIELDS[:4])))

    return Step({"g": g_col}, apply, {f"spliceai.{c}": fmt4(F.col(f"_{f}")) for c, f in _SPLICE.items()})


def annotate_spliceai(df: DataFrame, scores: DataFrame, g_col: str = "mapped_hgvs_g", build: str = "grch38", chunks: DataFrame | None = None, size: int = 0, key: list[str] | None = None) -> DataFrame:
    return annotate(df, spliceai_step(scores, g_col, build, chunks, size), key=key)


def missense_step(revel: DataFrame | None = None, alphamissense: DataFrame | None = None, dbnsfp: DataFrame | None = None, g_col: str = "mapped_hgvs_g", build: str = "grch38") -> Step:
    """Scores of single-base slots; columns exist for the tables given.  MutPred2 is one value a row: the largest."""
    if revel is None and alphamissense is None and dbnsfp is None:
        raise ValueError("no score table given")
    tables, values, row_values = [], {}, {}
    if revel is not None:
        tables.append(max_score(revel).withColumnRenamed("score", "revel"))
        values["revel.score"] = fmt4(F.col("revel"))
    if alphamissense is not None:
        am = argmax(alphamissense.withColumn("chrom", F.regexp_replace("chrom", "^chr", "")), ALLELE, "score", "line", "class")
        tables.append(am.withColumnRenamed("score", "am").withColumnRenamed("class", "am_class"))
        values |= {"alphamissense.score": fmt4(F.col("am").cast("double")), "alphamissense.class": "am_class"}
    if dbnsfp is not None:
        tables.append(dbnsfp.withColumn("chrom", F.regexp_replace("chrom", "^chr", "")).groupBy(*ALLELE).agg(F.max(max_of_list(F.col("mutpred2_score"))).alias("mutpred2")))
        row_values["mutpred2.score"] = ("mutpred2", lambda c: fmt4(F.max(c)))

    def apply(long: DataFrame) -> DataFrame:
        long = long.withColumn("v", snv_of(F.col("g"), build)).select("*", *(F.col(f"v.{c}").alias(c) for c in ALLELE)).drop("v")
        return reduce(lambda d, t: lookup(d, t, ALLELE), tables, long)

    return Step({"g": g_col}, apply, values, row_values)


def annotate_missense(df: DataFrame, revel: DataFrame | None = None, alphamissense: DataFrame | None = None, dbnsfp: DataFrame | None = None, g_col: str = "mapped_hgvs_g", build: str = "grch38", key: list[str] | None = None) -> DataFrame:
    return annotate(df, missense_step(revel, alphamissense, dbnsfp, g_col, build), key=key)


_SOURCE = "clingen_evidence_repository"


def evidence_step(evidence: DataFrame, hgvs_col: str, variation_col: str, caid_col: str, fields: list[str], keys: tuple[str, ...] = ("hgvs", "clinvar", "caid")) -> Step:
    """Records of an evidence repository by slot of ``hgvs_col``, found by up to three keys and merged in their order, each uuid
    once; ``warnings`` for keys that disagree.  ``evidence``: (record, hgvs array, variation_id, caid, uuid, and ``fields``)."""
    key_of = {"hgvs": F.transform("hgvs", strip_gene_symbol), "clinvar": F.array("variation_id"), "caid": F.array("caid")}
    ranked = F.array(*(F.struct(F.lit(i).alias("rank"), F.array_distinct(key_of[k]).alias("k")) for i, k in enumerate(keys)))
    by = evidence.select("record", "uuid", *fields, F.explode(ranked).alias("_k")).select("record", "uuid", *fields, F.col("_k.rank").alias("rank"), F.explode("_k.k").alias("k")).filter("k <> ''")

    def apply(long: DataFrame) -> DataFrame:
        long = long.withColumn("hgvs", strip_gene_symbol(F.col("hgvs")))
        asked = long.select(ROW, SLOT, F.posexplode(F.array(*keys)).alias("rank", "k")).filter("k <> ''")
        hits = asked.join(by, ["rank", "k"])
        once = hits.groupBy(ROW, SLOT, "uuid").agg(F.min(F.struct("rank", "record", *fields)).alias("p"), F.collect_set("rank").alias("ranks"))
        merged = once.groupBy(ROW, SLOT).agg(
            *(ordered_distinct_concat(F.struct("p.rank", "p.record"), F.col(f"p.{f}")).alias(f"f_{f}") for f in fields),
            *(F.collect_set(F.when(F.array_contains("ranks", i), F.col("uuid"))).alias(f"u_{k}") for i, k in enumerate(keys)),
        )
        out = long.join(merged, [ROW, SLOT], "left")
        none = F.array().cast("array<string>")
        u = {k: F.coalesce(F.col(f"u_{k}"), none) for k in keys}
        hit_n = sum(((F.size(u[k]) > 0).cast("int") for k in keys), F.lit(0))
        apart = [F.when((F.size(u[a]) > 0) & (F.size(u[b]) > 0) & ~F.arrays_overlap(u[a], u[b]), F.lit(f"non-overlapping results for keys '{a}' and '{b}'")) for i, a in enumerate(keys) for b in keys[i + 1 :]]
        missed = F.sort_array(F.array_compact(F.array(*(F.when((F.size(u[k]) == 0) & (F.col(k) != ""), F.lit(f"'{k}'")) for k in keys))))
        one = F.when((hit_n == 1) & (F.size(missed) > 0) & F.lit(len(keys) > 1), F.concat(F.lit("found via "), reduce(lambda c, k: c.when(F.size(u[k]) > 0, F.lit(f"'{k}'")), keys, F).otherwise(""), F.lit(" but not "), F.array_join(missed, ", ")))
        warnings = F.when(hit_n > 1, F.array_join(F.array_compact(F.array(*apart, F.lit(None).cast("string"))), "; ")).otherwise(F.coalesce(one, F.lit("")))
        return out.withColumn("_warnings", warnings)

    values = {f"{_SOURCE}.{f}": f"f_{f}" for f in fields} | {f"{_SOURCE}.warnings": "_warnings"}
    return Step({"hgvs": hgvs_col, "clinvar": variation_col, "caid": caid_col}, apply, values, sized_by=("hgvs",))


def annotate_evidence(df: DataFrame, evidence: DataFrame, hgvs_col: str, variation_col: str, caid_col: str, fields: list[str], keys: tuple[str, ...] = ("hgvs", "clinvar", "caid"), key: list[str] | None = None) -> DataFrame:
    return annotate(df, evidence_step(evidence, hgvs_col, variation_col, caid_col, fields, keys), key=key)


def pick_calibrations(calibrations: DataFrame) -> DataFrame:
    """(score_set, role, calibration, ordinal): the primary one, else the first of the investigators, else the first not
    for research only; and the investigators' first."""
    rank = F.when(F.col("primary"), 0).when(F.col("investigator"), 1).when(~F.col("research_only"), 2)
    main = calibrations.withColumn("_r", rank).filter("_r is not null").groupBy("score_set").agg(F.min_by("calibration", F.struct("_r", "ordinal")).alias("calibration"))
    own = calibrations.filter("investigator").groupBy("score_set").agg(F.min_by("calibration", "ordinal").alias("calibration"))
    return main.withColumn("role", F.lit("primary")).unionByName(own.withColumn("role", F.lit("investigator")))


def _classes(ranges: DataFrame) -> DataFrame:
    """(calibration, classes): the classes of a calibration in their order; a document's worth each."""
    names = ["ordinal", "label", "low", "high", "low_in", "high_in", *(c for c in ("id",) if c in ranges.columns)]
    return ranges.groupBy("calibration").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("classes"))


def _in_range(c: Column, s: Column) -> Column:
    above = c["low"].isNull() | (s > c["low"]) | ((s == c["low"]) & F.coalesce(c["low_in"], F.lit(True)))
    below = c["high"].isNull() | (s < c["high"]) | ((s == c["high"]) & F.coalesce(c["high_in"], F.lit(False)))
    return above & below


def _label_by_range(classes: Column, s: Column) -> Column:
    return F.when(s.isNotNull(), F.get(F.filter(classes, lambda c: F.coalesce(_in_range(c, s), F.lit(False))), F.lit(0))["label"])


def _label_by_id(classes: Column, class_id: Column) -> Column:
    return F.get(F.filter(classes, lambda c: c["id"] == class_id), F.lit(0))["label"]


def classify_by_range(scores: DataFrame, ranges: DataFrame) -> DataFrame:
    """``scores`` (calibration, score text) with label: the first range of the calibration that holds the score, empty if none does.
    ``ranges``: (calibration, ordinal, label, low, high, low_in, high_in), null bounds are open, bounds default to low in and
    high out.  A calibration's ranges travel as one array, so that rows are neither multiplied nor joined back."""
    rows = scores.drop("label").join(_classes(ranges), "calibration", "left")
    label = _label_by_range(F.col("classes"), number(F.col("score")))
    return rows.select(*(c for c in scores.columns if c != "label"), F.coalesce(label, F.lit("")).alias("label"))


def classify_by_assignment(scores: DataFrame, assigned: DataFrame, labels: DataFrame) -> DataFrame:
    """Label by variant: (calibration, urn) -> class id -> label."""
    return scores.join(assigned, ["calibration", "urn"], "left").join(labels, ["calibration", "class_id"], "left").withColumn("label", F.coalesce("label", F.lit(""))).drop("class_id")


def annotate_calibration(df: DataFrame, calibrations: DataFrame, ranges: DataFrame, urn_col: str, score_col: str, ns: str, site: str, assigned: DataFrame | None = None) -> DataFrame:
    """Eight columns ``ns``.{primary,investigator_provided}_calibration.{urn,name,url,functional_class}: the score set's calibrations
    by role, and the class of the row.  ``calibrations``: (score_set, ordinal, calibration, title, primary, investigator,
    research_only); ``ranges`` as in ``classify_by_range``, with the class's ``id``.  A calibration whose first class has no
    range takes the class from ``assigned`` (calibration, urn, class_id).  Rows without a score set, a calibration or a class
    have empty columns.  Each row is joined by its values, so no row id is needed."""
    names = [c for c in df.columns if not c.startswith(f"{ns}.")]
    parts = ranges if "id" in ranges.columns else ranges.withColumn("id", F.lit(None).cast("int"))
    whole = parts if "ranged" in parts.columns else parts.withColumn("ranged", F.lit(True))
    first = whole.groupBy("calibration").agg(F.min_by("ranged", "ordinal").alias("by_range"))
    titles = calibrations.select("calibration", *(["title"] if "title" in calibrations.columns else [])).dropDuplicates(["calibration"])
    known = titles.join(_classes(whole.filter("ranged")).withColumnRenamed("classes", "ranges"), "calibration", "left").join(first, "calibration", "left")
    known = known.join(parts.groupBy("calibration").agg(F.sort_array(F.collect_list(F.struct("ordinal", "id", "label"))).alias("ids")), "calibration", "left")
    if "title" not in known.columns:
        known = known.withColumn("title", F.lit(""))
    picked = pick_calibrations(calibrations).join(known, "calibration")
    roles = {"primary": "primary", "investigator": "investigator_provided"}
    sets = picked.groupBy("score_set").agg(*(F.max_by(F.struct("calibration", "title", "by_range", "ranges", "ids"), F.when(F.col("role") == r, 1)).alias(f"_{r}") for r in roles))
    urn = trim_key(F.col(urn_col))
    score = number(trim_key(F.col(score_col).cast("string")))
    out = df.select(*(F.col(f"`{c}`") for c in names), score_set_of(urn).alias("_set"), urn.alias("_urn"), score.alias("_score"))
    out = out.withColumn("_asked", _dealt(F.coalesce(F.col("_set") != "", F.lit(False)), F.col("_set"), "_urn", *(f"`{c}`" for c in names if "map<" not in dict(df.dtypes)[c])))
    out = out.join(sets.withColumnRenamed("score_set", "_asked"), "_asked", "left").drop("_asked")
    given = None if assigned is None else assigned.groupBy("calibration", "urn").agg(F.max("class_id").alias("class_id"))
    new = []
    for r, long_name in roles.items():
        p = F.col(f"_{r}")
        label = F.when(p["by_range"], _label_by_range(p["ranges"], F.col("_score")))
        if given is not None:
            out = out.withColumn(f"_c_{r}", F.when(~p["by_range"], p["calibration"]))
            right = given.select(F.col("calibration").alias(f"_c_{r}"), F.col("urn").alias(f"_u_{r}"), F.col("class_id").alias(f"_id_{r}"))
            out = out.withColumn(f"_u_{r}", F.when(~p["by_range"], F.col("_urn")).otherwise(F.concat(F.lit("\u0000"), F.col("_urn")))).withColumn(f"_c_{r}", _dealt(F.col(f"_c_{r}").isNotNull(), F.col(f"_c_{r}"), "_urn", *(f"`{c}`" for c in names if "map<" not in dict(df.dtypes)[c])))
            out = out.join(right, [f"_c_{r}", f"_u_{r}"], "left")
            label = F.when(~p["by_range"], _label_by_id(p["ids"], F.col(f"_id_{r}"))).otherwise(label)
        there = p["calibration"].isNotNull()
        values = {"urn": p["calibration"], "name": p["title"], "url": F.when(there, F.concat(F.lit(f"{site}/score-sets/"), F.col("_set"))), "functional_class": label}
        new += [F.coalesce(v, F.lit("")).alias(f"{ns}.{long_name}_calibration.{c}") for c, v in values.items()]
    return out.select(*(F.col(f"`{c}`") for c in names), *new)


def calibration_step(calibrations: DataFrame, ranges: DataFrame, urn_col: str, score_col: str, ns: str, site: str, assigned: DataFrame | None = None) -> Step:
    """``annotate_calibration`` as a step of a chain: it reads the rows' own urn and score, and shares the chain's long layer without adding to it."""
    after = lambda df: annotate_calibration(df, calibrations, ranges, urn_col, score_col, ns, site, assigned)
    return Step({"urn": urn_col}, lambda long: long, {}, after=after)


def consequence_step(vep: DataFrame, recoded: DataFrame, cols: list[str], ns: str = "vep", access_date: Column | None = None) -> Step:
    """Consensus of the slots' consequences: from ``vep`` (hgvs, consequence), or for strings that are not in it the most severe
    of their ``recoded`` ones (hgvs, genomic).  Slots are those of the first of ``cols`` that is not blank."""
    table = vep.groupBy("hgvs").agg(F.min("consequence").alias("consequence"))
    genomic = table.select(F.col("hgvs").alias("genomic"), "consequence")
    rank = severity_rank(F.col("consequence"))
    other = recoded.join(table.select("hgvs"), "hgvs", "left_anti").join(genomic, "genomic").filter(rank.isNotNull()).groupBy("hgvs").agg(F.min_by("consequence", rank).alias("worst"))

    def apply(long: DataFrame) -> DataFrame:
        found = lookup(lookup(long, table, ["hgvs"]), other, ["hgvs"])
        return found.withColumn("_c", F.coalesce("consequence", "worst", F.lit("")))

    def after(df: DataFrame) -> DataFrame:
        known = F.filter("_known", lambda x: x != "")
        differs = F.concat(F.lit("Discrepant VEP mutational consequences across DNA candidates: "), "_all")
        new = {f"{ns}.consequence": F.when(F.size(known) == 1, F.get(known, F.lit(0))).otherwise(""), f"{ns}.error": F.when(F.size(known) > 1, differs).otherwise(""), f"{ns}.access_date": access_date if access_date is not None else F.date_format(F.current_date(), "yyyy-MM-dd")}
        old = [c for c in df.columns if c not in new and c not in ("_in", "_all", "_known")]
        return df.select(*(F.col(f"`{c}`") for c in old), *(v.alias(c) for c, v in new.items()))

    return Step({"hgvs": "_in"}, apply, {"_all": "_c"}, {"_known": ("_c", F.collect_set)}, before=lambda df: df.withColumn("_in", first_non_blank(*(F.col(c) for c in cols))), after=after)


def annotate_consequence(df: DataFrame, vep: DataFrame, recoded: DataFrame, cols: list[str], ns: str = "vep", keep_existing: bool = False, access_date: Column | None = None, key: list[str] | None = None) -> DataFrame:
    """As ``consequence_step``; with ``keep_existing`` only rows whose consequence is blank are annotated, the others
    pass by."""
    step = consequence_step(vep, recoded, cols, ns, access_date)
    out = f"{ns}.consequence"
    if out not in df.columns or not keep_existing:
        return annotate(df, step, key=key)
    rows = keyed(df, key)
    blank = is_blank(F.col(f"`{out}`"))
    fresh = annotate(rows.filter(blank), step)
    had = rows.filter(~blank)
    for c in (f"{ns}.error", f"{ns}.access_date"):
        had = had if c in had.columns else had.withColumn(c, F.lit(""))
    both = fresh.unionByName(had)
    return both if ROW in df.columns else both.drop(ROW)
