"""The mapping family: routing, reuse of earlier results, joins to mapping, registry and transcript tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import accession_of, append_error, has_hgvs, haplotype_components, is_blank, is_protein, is_transcript, normalize_protein, transcript_sort_key, trim_key
from .slots import ROW, SLOT, keyed, settled
from .tables import last_wins


def _col(c: str) -> Column:
    return F.col(f"`{c}`")


def classify_input(nt: Column, pro: Column) -> Column:
    """1: nucleotide string with an accession; 2: without; 3: protein only; null: neither."""
    return F.when(has_hgvs(nt), F.when(F.contains(nt, F.lit(":")), 1).otherwise(2)).when(has_hgvs(pro), 3)


def classify_assay_level(level: Column, g: Column, c: Column, p: Column) -> Column:
    given = F.lower(trim_key(level))
    dna = ~is_blank(c) | ~is_blank(g)
    protein = (given == "protein") | ((given == "") & ~dna & ~is_blank(p))
    return F.when(protein, "protein").when(dna, "dna").otherwise(level)


def bad_id_prefix(df: DataFrame, id_col: str, nt_col: str, row_id: str) -> DataFrame:
    """Rows whose allele id does not start as it must: CA on DNA rows, PA on others; placeholders don't count."""
    i = trim_key(F.col(id_col))
    wanted = F.when(is_blank(F.col(nt_col)), "PA").otherwise("CA")
    return df.filter((i != "") & ~i.startswith("_:") & ~F.startswith(i, wanted)).select(F.col(row_id), (F.col(row_id) + 2).alias("line"), i.alias("id"), wanted.alias("wanted"))


def validate_id_prefix(df: DataFrame, id_col: str, nt_col: str, row_id: str) -> DataFrame:
    first = bad_id_prefix(df, id_col, nt_col, row_id).orderBy(row_id).limit(1).collect()
    if first:
        raise ValueError(f"row {first[0]['line']}: id {first[0]['id']} does not start with {first[0]['wanted']}")
    return df


def ensure_outcome(df: DataFrame, mapped: list[str], error: str = "mapping_error") -> DataFrame:
    blank = is_blank(F.col(error))
    for c in mapped:
        blank = blank & is_blank(F.col(c))
    return df.withColumn(error, F.when(blank, "Mapping produced no HGVS output").otherwise(F.col(error)))


def keep_existing(new: Column, old: Column) -> Column:
    return F.when(is_blank(old), new).otherwise(old)


def split_existing(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(rows that still need ``col``, rows that have it): only the first are to be annotated, then both are united."""
    blank = is_blank(_col(col))
    return df.filter(blank), df.filter(~blank)


def _dealt(on: Column, key: Column, *by: str) -> Column:
    """A join key where ``on`` holds; elsewhere text that matches nothing and differs by row, so that it gathers nowhere."""
    return F.when(on & key.isNotNull(), key).otherwise(F.concat(F.lit("\u0000"), F.xxhash64(*by).cast("string")))


def _hashable(df: DataFrame) -> list[str]:
    """The columns whose values tell rows apart: all but maps."""
    return [f"`{c}`" for c, kind in df.dtypes if "map<" not in kind]


def read_targets(targets: DataFrame, name_col: str, order: str) -> DataFrame:
    """The last row of each name that is not blank."""
    if name_col not in targets.columns:
        raise ValueError(f"no column {name_col}; there are {targets.columns}")
    return last_wins(targets.withColumn(name_col, trim_key(F.col(name_col))).filter(F.col(name_col) != ""), [name_col], order)


def join_targets(df: DataFrame, targets: DataFrame, name_col: str, fill: list[str]) -> DataFrame:
    """Fills blank ``fill`` columns from the target of the row's name; other columns of the target are added."""
    renamed = targets.select(F.col(name_col).alias("_name"), *(F.col(c).alias(f"_t_{c}") for c in targets.columns if c != name_col))
    name = trim_key(_col(name_col))
    out = df.withColumn("_name", _dealt(name != "", name, *_hashable(df))).join(renamed, "_name", "left")
    value = lambda c: F.coalesce(F.col(f"_t_{c}"), F.lit(""))
    more = [c for c in targets.columns if c != name_col and c not in df.columns]
    return out.select(*(F.when(is_blank(F.col(c)), value(c)).otherwise(F.col(c)).alias(c) if c in fill else F.col(c) for c in df.columns), *(value(c).alias(c) for c in more))


def earlier_results(tables: list[DataFrame], order: str, keys: list[str], mapped: tuple[str, ...]) -> DataFrame | None:
    """Several earlier results as one table for ``reuse_existing``, in their order (column ``_order``): tables that lack one of the ``keys`` columns are
    passed over, columns of ``mapped`` that one lacks are empty there.  None if no table is left."""
    usable = [(i, d) for i, d in enumerate(tables) if set(keys) <= set(d.columns)]
    if not usable:
        return None
    one = lambda i, d: d.select(
        F.struct(F.lit(i).alias("table"), _col(order).cast("long").alias("line")).alias("_order"), *(_col(k).cast("string").alias(k) for k in keys),
        *((_col(c) if c in d.columns else F.lit("")).cast("string").alias(c) for c in mapped if c not in keys),
    )
    return reduce(DataFrame.unionByName, (one(i, d) for i, d in usable))


def reuse_existing(df: DataFrame, prior: DataFrame, order: str, nt: str, pro: str, extra: tuple[str, ...] = (), mapped: tuple[str, ...] = ("mapped_hgvs_g", "mapped_hgvs_c", "mapped_hgvs_p", "mapping_error"), useful: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows with the first earlier result of their key, rows still to do).  Earlier rows count if one of ``useful`` (all of
    ``mapped`` by default) is not blank."""
    keys = ["_k0", "_k1", *(f"_k{i + 2}" for i in range(len(extra)))]
    key = lambda: [trim_key(F.col(nt)).alias("_k0"), normalize_protein(trim_key(F.col(pro))).alias("_k1"), *(trim_key(F.col(c)).alias(f"_k{i + 2}") for i, c in enumerate(extra))]
    some = F.lit(False)
    for c in useful or mapped:
        some = some | ~is_blank(F.col(c))
    old = prior.filter(some).select(F.col(order).alias("_o"), *key(), *(F.col(c).alias(f"_m_{c}") for c in mapped))
    old = old.groupBy(*keys).agg(F.min(F.struct("_o", *(f"_m_{c}" for c in mapped))).alias("p"))
    rows = df.select("*", *key())
    hit = rows.join(old, keys).select(*(c for c in df.columns if c not in mapped), *(F.col(f"p._m_{c}").alias(c) for c in mapped))
    return hit, rows.join(old.select(*keys), keys, "left_anti").drop(*keys)


def best_transcripts(associations: DataFrame) -> DataFrame:
    """(pro_ac, tx_ac): the best transcript of each protein."""
    return associations.groupBy("pro_ac").agg(F.min_by("tx_ac", transcript_sort_key(F.col("tx_ac"))).alias("tx_ac"))


def resolve_transcript(df: DataFrame, associations: DataFrame, p_col: str, fallback: tuple[str, ...] = ()) -> DataFrame:
    """``transcript`` and ``transcript_error`` of protein strings."""
    acc = accession_of(trim_key(F.col(p_col)))
    rows = df.withColumn("_acc", acc).withColumn("_key", _dealt(is_protein(F.col("_acc")), F.col("_acc"), *_hashable(df)))
    rows = rows.join(best_transcripts(associations).withColumnRenamed("pro_ac", "_key"), "_key", "left")
    other = [F.when(is_transcript(accession_of(trim_key(F.col(c)))), accession_of(trim_key(F.col(c)))) for c in fallback]
    tx = F.coalesce(F.when(is_transcript(F.col("_acc")), F.col("_acc")), F.when(is_protein(F.col("_acc")), F.col("tx_ac")), *other)
    return rows.select(*df.columns, F.coalesce(tx, F.lit("")).alias("transcript"), F.when(tx.isNull(), F.concat(F.lit("No transcript for "), F.col(p_col))).otherwise("").alias("transcript_error"))


def lookup_strand(df: DataFrame, alignments: DataFrame, tx_col: str) -> DataFrame:
    one = alignments.filter("method = 'splign'").groupBy("tx_ac").agg(F.min("strand").alias("strand"))
    tx = _col(tx_col)
    rows = df.withColumn("_tx", _dealt(~is_blank(tx), tx, *_hashable(df))).join(one.withColumnRenamed("tx_ac", "_tx"), "_tx", "left")
    return rows.drop("_tx").withColumn("strand", F.coalesce(F.col("strand").cast("string"), F.lit("")))


def ensembl_to_refseq(df: DataFrame, xrefs: DataFrame, tx_col: str) -> DataFrame:
    """The first ``NM_`` cross-reference of a transcript without its version; itself if there is none."""
    best = xrefs.filter(F.col("xref").startswith("NM_")).groupBy("ensembl").agg(F.min_by("xref", "ordinal").alias("_nm"))
    bare = F.substring_index(tx_col, ".", 1)
    out = df.withColumn("_e", _dealt(bare != "", bare, *_hashable(df))).join(best.withColumnRenamed("ensembl", "_e"), "_e", "left")
    return out.select(*df.columns, F.coalesce("_nm", tx_col).alias("refseq"))


def _no_data(hgvs: Column) -> Column:
    return F.concat(F.lit("ClinGen returned no data for '"), hgvs, F.lit("'"))


def join_accessioned(df: DataFrame, assays: DataFrame, registry: DataFrame, nt_col: str) -> DataFrame:
    """Strings with an accession: raw -> assay string -> registry record (hgvs, g, c, p, id).  The c. string falls back to the
    raw one, also where the registry has no record."""
    rest, by = ~is_blank(_col(nt_col)), _hashable(df)
    a = df.withColumn("_raw", _dealt(rest, _col(nt_col), *by)).join(assays.select(F.col("raw").alias("_raw"), "assay"), "_raw", "left")
    a = a.withColumn("_asked", _dealt(rest, F.coalesce("assay", nt_col), *by))
    r = a.join(registry.select(F.col("hgvs").alias("_h"), "g", "c", "p", "id"), F.col("_asked") == F.col("_h"), "left")
    found = F.col("_h").isNotNull()
    g = F.coalesce(F.col("g"), F.when(F.col("assay").startswith("NC_"), F.col("assay")), F.lit(""))
    return r.select(
        *df.columns, F.when(found, g).otherwise("").alias("mapped_hgvs_g"), F.coalesce("c", nt_col).alias("mapped_hgvs_c"), F.coalesce("p", F.lit("")).alias("mapped_hgvs_p"),
        F.coalesce("id", F.lit("")).alias("clingen_allele_id"), F.when(found, "").otherwise(_no_data(F.coalesce("assay", nt_col))).alias("mapping_error"),
    )


def join_mapped_groups(df: DataFrame, results: DataFrame, registry: DataFrame, row_id: str) -> DataFrame:
    """Rows mapped by target sequence: the external result of the row (assay, error), then the registry by assay."""
    rows = df.join(results.select(F.col("row").alias(row_id), "assay", F.col("error").alias("_e")), row_id, "left")
    rows = rows.withColumn("_asked", _dealt(~is_blank(F.col("assay")), F.col("assay"), row_id))
    r = rows.join(registry.select(F.col("hgvs").alias("_h"), "g", "c", "p", "id"), F.col("_asked") == F.col("_h"), "left")
    has, found = ~is_blank(F.col("assay")), F.col("_h").isNotNull()
    as_p = F.contains(F.col("assay"), F.lit(":p.")) | F.col("assay").startswith("p.")
    blank = F.lit("")
    error = F.when(~is_blank(F.col("_e")), F.col("_e")).when(has & ~found, _no_data(F.col("assay"))).otherwise(blank)
    p = F.when(found, F.coalesce("p", F.when(F.col("id").startswith("PA"), F.col("assay")), blank)).when(has & as_p, F.col("assay")).otherwise(blank)
    return r.select(
        *df.columns, F.when(found, F.coalesce("g", blank)).when(has & ~as_p, F.col("assay")).otherwise(blank).alias("mapped_hgvs_g"), F.coalesce("c", blank).alias("mapped_hgvs_c"), p.alias("mapped_hgvs_p"),
        F.coalesce("id", blank).alias("clingen_allele_id"), error.alias("mapping_error"),
    )


#: What mapping adds to a row (names are fixed values).
MAPPED = ["mapped_hgvs_g", "mapped_hgvs_c", "mapped_hgvs_p", "mapping_error", "mapping_warnings", "dna_vrs_digest", "protein_vrs_digest", "strand", "clingen_allele_id"]


def map_variants(
    df: DataFrame, assays: DataFrame, results: DataFrame, registry: DataFrame, alignments: DataFrame, targets: DataFrame | None = None, existing: DataFrame | list[DataFrame] | None = None,
    match_cols: tuple[str, ...] = (), order: str = "line", nt: str = "raw_hgvs_nt", pro: str = "raw_hgvs_pro", sequence: str = "target_sequence", group_by: str = "target_sequence",
    target_name: str = "target_name", drop: tuple[str, ...] = (),
) -> DataFrame:
    """Each row with its mapped g., c. and p. strings, error, warnings, digests, strand and allele id; one row for each of ``df``.

    Blank cells are filled from ``targets`` (unique by ``target_name``); one-letter protein strings are spelled out; rows with an
    earlier result in ``existing`` (one table or several, first by table and ``order``, same strings and ``match_cols``) take it.  Strings with an accession go by
    ``assays`` (raw, assay) to ``registry`` (hgvs, g, c, p, id), their strand by ``alignments`` (tx_ac, strand, method).  Others need
    a target sequence and take ``results`` of the external mapper, unique by (target, nt, pro) with assay, error,
    dna_vrs_digest, protein_vrs_digest and strand; ``target`` is ``group_by`` or else the sequence.  Rows without a usable
    string, without a sequence or without a result have an error.  Null cells are empty; ``drop`` columns go at the end."""
    rows = df
    if targets is not None:
        rows = join_targets(rows, targets, target_name, [c for c in targets.columns if c in df.columns and c != target_name])
    wanted = [c for c in (nt, pro, sequence, group_by) if c not in rows.columns]
    rows = rows.withColumns({c: F.lit("") for c in dict.fromkeys(wanted)})
    spelled = F.when(is_blank(_col(pro)), _col(pro)).otherwise(normalize_protein(_col(pro)))
    rows = rows.withColumn(pro, spelled)
    names = [c for c in rows.columns if c not in MAPPED and c not in wanted]
    done = None
    if isinstance(existing, list):
        existing, order = earlier_results(existing, order, [nt, pro, *match_cols], tuple(MAPPED)), "_order"
    if existing is not None:
        old = existing.withColumns({c: F.lit("") for c in MAPPED if c not in existing.columns})
        done, rows = reuse_existing(rows, old, order, nt, pro, match_cols, tuple(MAPPED), useful=tuple(MAPPED[:4]))
    raw, seq = trim_key(_col(nt)), trim_key(_col(sequence))
    group = F.coalesce(F.nullif(trim_key(_col(group_by)), F.lit("")), seq)
    by = rows.columns
    r = rows.withColumns({"_kind": classify_input(_col(nt), _col(pro)), "_raw": raw, "_seq": seq, "_group": group})
    one, many = F.coalesce(F.col("_kind") == 1, F.lit(False)), F.coalesce(F.col("_kind") > 1, F.lit(False)) & (F.col("_seq") != "")
    a = assays.groupBy(F.col("raw").alias("_ka")).agg(F.min("assay").alias("_assay1"))
    r = r.withColumn("_ka", _dealt(one, F.col("_raw"), *by)).join(a, "_ka", "left")
    kept = {"assay": "_assay2", "error": "_error2", "dna_vrs_digest": "_dna", "protein_vrs_digest": "_pro", "strand": "_strand2"}
    m = results.select(F.col("target").alias("_kt"), trim_key(F.col("nt")).alias("_kn"), trim_key(F.col("pro")).alias("_kp"), *(F.col(c).cast("string").alias(n) for c, n in kept.items()), F.lit(True).alias("_has"))
    r = r.withColumns({"_kt": _dealt(many, F.col("_group"), *by), "_kn": F.col("_raw"), "_kp": trim_key(_col(pro))}).join(m, ["_kt", "_kn", "_kp"], "left")
    failed = ~is_blank(F.col("_error2"))
    hgvs = F.when(one, F.coalesce("_assay1", "_raw")).when(many & ~failed, F.nullif(trim_key(F.col("_assay2")), F.lit("")))
    r = r.withColumn("_assay", hgvs).withColumn("_kh", _dealt(F.lit(True), F.col("_assay"), *by))
    r = r.join(registry.select(F.col("hgvs").alias("_kh"), *(F.col(c).alias(f"_r{c}") for c in ("g", "c", "p", "id")), F.lit(True).alias("_found")), "_kh", "left")
    found, assay, none = F.col("_found").isNotNull(), F.col("_assay"), F.lit(None).cast("string")
    as_p, mapped = F.contains(assay, F.lit(":p.")) | assay.startswith("p."), many & ~failed & assay.isNotNull()
    g = F.when(one & found, F.coalesce("_rg", F.when(assay.startswith("NC_"), assay))).when(mapped & found, F.col("_rg")).when(mapped & ~as_p, assay)
    c = F.when(one, F.coalesce("_rc", "_raw")).when(mapped, F.col("_rc"))
    p = F.when(found, F.coalesce("_rp", F.when(mapped & F.col("_rid").startswith("PA"), assay))).when(mapped & as_p, assay)
    need = F.concat(F.lit("target_sequence is required for case "), F.col("_kind").cast("string"), F.lit(f" but column '{sequence}' is missing or blank"))
    error = (
        F.when(F.col("_kind").isNull(), "No usable HGVS variant data in this row").when(one & ~found, _no_data(assay)).when((F.col("_kind") > 1) & (F.col("_seq") == ""), need)
        .when(many & failed, F.col("_error2")).when(many & assay.isNull(), "No HGVS string produced by mapper").when(many & ~found, _no_data(assay))
    )
    r = r.withColumns({"_g": g, "_c": c, "_p": p, "_e": error})
    tx = accession_of(F.col("_c"))
    strands = alignments.filter("method = 'splign'").groupBy(F.col("tx_ac").alias("_tx")).agg(F.min("strand").cast("string").alias("_strand1"))
    r = r.withColumn("_tx", _dealt(one & (tx != ""), tx, *by)).join(strands, "_tx", "left")
    strand = F.when(one, F.col("_strand1")).when(many, F.col("_strand2"))
    digest = lambda c: F.when(mapped, F.col(c))
    new = dict(zip(MAPPED, [F.col("_g"), F.col("_c"), F.col("_p"), F.col("_e"), none, digest("_dna"), digest("_pro"), strand, F.when(found, F.col("_rid"))]))
    out = r.select(*map(_col, names), *(F.coalesce(v, F.lit("")).alias(k) for k, v in new.items()))
    if done is not None:
        out = out.unionByName(done.select(*map(_col, names), *(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in MAPPED)))
    out = ensure_outcome(out, ["mapped_hgvs_g", "mapped_hgvs_c", "mapped_hgvs_p", "dna_vrs_digest", "protein_vrs_digest"])
    return out.drop(*drop)


def join_reverse_candidates(df: DataFrame, candidates: DataFrame, errors: DataFrame, p_col: str, level: str = "level") -> DataFrame:
    """Candidate lists of protein rows, by (transcript, hgvs_p); rows without any get an error."""
    on = [F.col("transcript"), F.col(p_col)]
    lists = candidates.groupBy("transcript", "hgvs_p").agg(F.array_sort(F.collect_list(F.struct("ordinal", "hgvs_c", "hgvs_g"))).alias("l"))
    lists = lists.select(F.col("transcript").alias("_t"), F.col("hgvs_p").alias("_p"), F.array_join("l.hgvs_c", "|").alias("_c"), F.array_join("l.hgvs_g", "|").alias("_g"))
    errs = errors.select(F.col("transcript").alias("_t2"), F.col("hgvs_p").alias("_p2"), F.col("error").alias("_err"))
    out = df.join(lists, (on[0] == F.col("_t")) & (on[1] == F.col("_p")), "left").join(errs, (on[0] == F.col("_t2")) & (on[1] == F.col("_p2")), "left")
    flagged = F.col(level) == "protein"
    message = F.when(flagged & F.col("_c").isNull(), F.coalesce("_err", F.concat(F.lit("Reverse translation returned no candidate DNA variants for "), p_col)))
    rest = [c for c in df.columns if c not in ("mapped_hgvs_c", "mapped_hgvs_g", "reverse_translation_error")]
    return out.select(
        *rest, F.when(flagged, F.coalesce("_c", F.lit(""))).otherwise(F.col("mapped_hgvs_c")).alias("mapped_hgvs_c"), F.when(flagged, F.coalesce("_g", F.lit(""))).otherwise(F.col("mapped_hgvs_g")).alias("mapped_hgvs_g"),
        F.when(message.isNotNull(), append_error(F.lit(""), message)).otherwise("").alias("reverse_translation_error"),
    )


def lookup_worklist(keys: DataFrame, cache: DataFrame, now: Column, hit_days: int = 100, miss_days: int = 1) -> DataFrame:
    """Distinct keys without a cache entry that still holds: ``cache`` has (key, found, fetched_at); hits last longer than misses."""
    age = F.when(F.col("found"), hit_days).otherwise(miss_days)
    valid = cache.filter(F.date_add(F.to_date("fetched_at"), age) >= F.to_date(now)).select("key")
    return keys.select(trim_key(F.col("key")).alias("key")).filter("key <> ''").distinct().join(valid, "key", "left_anti")


#: Bases of the following chunk that a chunk carries, so that a span up to one base longer lies in one chunk.
OVERLAP = 100


def overlapping(chunks: DataFrame, size: int, overlap: int = OVERLAP) -> DataFrame:
    """``chunks`` (accession, chunk, seq with ``size`` bases each) with the first ``overlap`` bases (one chunk at most) of the following chunk at the
    end of ``seq``, and with their number in ``overlap``.  Worth staging or writing as a bucketed table where many lookups follow."""
    if "overlap" in chunks.columns:
        return chunks
    overlap = min(overlap, size)
    tails = chunks.select("accession", (F.col("chunk") - 1).alias("chunk"), F.substring("seq", 1, overlap).alias("_tail"))
    whole = chunks.select("accession", "chunk", "seq").join(tails, ["accession", "chunk"], "left")
    seq = F.when(F.length("seq") == size, F.concat("seq", F.coalesce("_tail", F.lit("")))).otherwise(F.col("seq"))
    return whole.select("accession", "chunk", seq.alias("seq"), F.lit(overlap).alias("overlap"))


def _cut(text: Column, start: Column, stop: Column, size: int) -> Column:
    """The bases from ``start`` to ``stop`` of the text that begins with the chunk of ``start``; null if it ends before."""
    n = (stop - start + 1).cast("int")
    bases = F.substr(text, (F.pmod(start - 1, F.lit(size)) + 1).cast("int"), n)
    return F.when(F.length(bases) == n, bases)


def _chunk(p: Column, size: int) -> Column:
    return F.floor((p - 1) / size).cast("long")


def _long_spans(spans: DataFrame, chunks: DataFrame, size: int) -> DataFrame:
    """(_ba, _bs, _be, bases) of spans that reach over several chunks: each span once, its chunks in order."""
    s = spans.distinct()
    need = s.select("*", F.explode(F.sequence(_chunk(F.col("_base_start"), size), _chunk(F.col("_base_stop"), size))).alias("chunk")).withColumnRenamed("_base_acc", "accession")
    own = chunks.select("accession", "chunk", F.substring("seq", 1, size).alias("seq"))
    got = need.join(own, ["accession", "chunk"]).groupBy("accession", "_base_start", "_base_stop").agg(F.array_sort(F.collect_list(F.struct("chunk", "seq"))).alias("c"), F.count("*").alias("n"))
    whole = F.col("n") == _chunk(F.col("_base_stop"), size) - _chunk(F.col("_base_start"), size) + 1
    return got.select(F.col("accession").alias("_base_acc"), "_base_start", "_base_stop", F.when(whole, _cut(F.array_join("c.seq", ""), F.col("_base_start"), F.col("_base_stop"), size)).alias("bases"))


def _whole_spans(long: DataFrame, chunks: DataFrame, size: int, names: list[str]) -> DataFrame:
    """Slots with spans over several chunks, with ``bases``: each slot is computed once, and its chunks meet by its row and number."""
    own = chunks.select(F.col("accession").alias("_base_acc"), F.col("chunk").cast("long").alias("_base_chunk"), F.substring("seq", 1, size).alias("_base_seq"))
    need = long.withColumn("_base_chunk", F.explode(F.sequence(_chunk(F.col("_base_start"), size), _chunk(F.col("_base_stop"), size))))
    met = need.join(own, ["_base_acc", "_base_chunk"], "left").groupBy(ROW, SLOT).agg(
        F.any_value(F.struct("_base_start", "_base_stop", *(_col(c) for c in names if c not in (ROW, SLOT)))).alias("_own"),
        F.array_sort(F.collect_list(F.struct("_base_chunk", "_base_seq"))).alias("_c"), F.every(F.col("_base_seq").isNotNull()).alias("_all"),
    )
    bases = F.when(F.col("_all"), _cut(F.array_join("_c._base_seq", ""), F.col("_own._base_start"), F.col("_own._base_stop"), size))
    return met.select(ROW, SLOT, *(F.col(f"_own.`{c}`") for c in names if c not in (ROW, SLOT)), bases.alias("bases"))


def bases_of(df: DataFrame, accession: str, start: Column, stop: Column, chunks: DataFrame, size: int, overlap: int = OVERLAP) -> DataFrame:
    """``df`` with ``bases`` of each row's span (1-based, inclusive); null where the span is null or the reference does not cover it.

    ``chunks``: (accession, chunk, seq) with ``size`` bases each, or what ``overlapping`` made of them with the same ``overlap``.  A span that lies in one chunk and its overlap is
    one equi-join by (accession, chunk), one exchange a side.  Longer spans alone are looked up once each by all their chunks.  Rows without a
    span are dealt out by their content."""
    table = overlapping(chunks, size, overlap)
    whole = F.col("_base_start").isNotNull() & F.col("_base_stop").isNotNull() & (F.col("_base_start") > 0) & (F.col("_base_stop") >= F.col("_base_start")) & F.col("_base_acc").isNotNull()
    rows = settled(df, _base_start=start.cast("long"), _base_stop=stop.cast("long"), _base_acc=_col(accession))
    far = F.coalesce(whole & (F.col("_base_stop") - F.col("_base_start") > min(overlap, size)), F.lit(False))
    hashed = [_col(c) for c, kind in df.dtypes if "map<" not in kind]
    apart = F.concat(F.lit("\u0000"), F.xxhash64(*hashed).cast("string"))
    near = rows.filter(~far).withColumn("_base_in", F.coalesce(whole, F.lit(False)))
    near = near.withColumns({"_base_acc": F.when(F.col("_base_in"), F.col("_base_acc")).otherwise(apart), "_base_chunk": F.when(F.col("_base_in"), _chunk(F.col("_base_start"), size))})
    right = table.select(F.col("accession").alias("_base_acc"), F.col("chunk").cast("long").alias("_base_chunk"), F.col("seq").alias("_base_seq"))
    near = near.join(right, ["_base_acc", "_base_chunk"], "left").select(*map(_col, df.columns), _cut(F.col("_base_seq"), F.col("_base_start"), F.col("_base_stop"), size).alias("bases"))
    long = rows.filter(far)
    if {ROW, SLOT} <= set(df.columns):  # slots are told apart: their chunks meet by slot
        got = _whole_spans(long, table, size, df.columns)
    else:
        spans = _long_spans(long.select("_base_acc", "_base_start", "_base_stop"), table, size)
        got = long.join(spans, ["_base_acc", "_base_start", "_base_stop"], "left")
    return near.unionByName(got.select(*map(_col, df.columns), "bases"))


def fetch_ref_bases(spans: DataFrame, chunks: DataFrame, size: int, overlap: int = OVERLAP) -> DataFrame:
    """``spans`` (accession, start, stop; 1-based, inclusive) with ``bases``; null where the reference does not cover them all."""
    return bases_of(spans, "accession", F.col("start"), F.col("stop"), chunks, size, overlap)


def compose_delins(df: DataFrame, components: str, target: str) -> DataFrame:
    """``composed``: the change of several substitutions in one codon as ``c.S_EdelinsX``; null if they are not in one.  Bases
    between them come from ``target``, which is only needed there."""
    typed = F.transform(components, lambda x: F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("p"), F.regexp_extract(x, r"^\d+([ACGTN])>", 1).alias("r"), F.regexp_extract(x, r">([ACGTN])$", 1).alias("a")))
    rows = df.withColumn("_t", typed).withColumn("_s", F.upper(F.trim(F.coalesce(F.col(target), F.lit("")))))
    pos = F.transform("_t", lambda x: x["p"])
    rows = rows.withColumns({"_lo": F.array_min(pos), "_hi": F.array_max(pos)})
    one_codon = F.floor((F.col("_lo") - 1) / 3) == F.floor((F.col("_hi") - 1) / 3)

    def base(part: str):
        # the last of several components at one place counts
        own = lambda p: F.filter("_t", lambda x: x["p"] == p)
        between = lambda p: F.when(F.substr("_s", p, F.lit(1)).rlike("^[ACGTN]$"), F.substr("_s", p, F.lit(1)))
        return lambda p: F.when(F.size(own(p)) > 0, F.element_at(F.transform(own(p), lambda x: x[part]), -1)).otherwise(between(p))

    span = F.sequence("_lo", "_hi")
    rows = rows.withColumns({"_alt": F.when(one_codon, F.transform(span, base("a"))), "_ref": F.when(one_codon, F.transform(span, base("r")))})
    known = ~F.exists("_alt", lambda x: x.isNull())
    alt, ref = F.array_join("_alt", ""), F.array_join("_ref", "")
    where = F.concat(F.lit("c."), F.col("_lo").cast("string"), F.when(F.col("_lo") == F.col("_hi"), "").otherwise(F.concat(F.lit("_"), F.col("_hi").cast("string"))))
    return rows.withColumn("composed", F.when(known & (ref != alt), F.concat(where, F.lit("delins"), alt))).drop("_t", "_s", "_lo", "_hi", "_alt", "_ref")


def haplotype_worklist(df: DataFrame, nt_col: str = "raw_hgvs_nt", target: str = "target_sequence") -> DataFrame:
    """(accession, target, component), each once: what ``rewrite_haplotypes`` looks up in its mapping, for an external mapper.  Strings with an
    accession have no target, strings without one need it."""
    acc = F.regexp_extract(trim_key(_col(nt_col)), r"^([^:]+):", 1)
    asked = df.select(acc.alias("accession"), F.when(acc == "", trim_key(_col(target))).otherwise("").alias("target"), F.explode(haplotype_components(_col(nt_col))).alias("component"))
    return asked.filter((F.col("accession") != "") | (F.col("target") != "")).distinct()


def rewrite_haplotypes(df: DataFrame, mapping: DataFrame, nt_col: str = "raw_hgvs_nt", target: str = "target_sequence", orig: str = "orig_raw_hgvs_nt", key: list[str] | None = None) -> DataFrame:
    """Intra-codon haplotypes become one delins; the original string is kept before them in ``orig``.

    ``mapping``: (accession, target, component, mapped_c), with accession null or empty for strings without one, which are
    mapped by their target sequence (null or empty for those with one).  Every component must be mapped to a plain
    substitution, else the row is left as it is; so are rows whose bases between the components are not known.  Rows need no
    ``key``: they are joined by their strings."""
    parts = haplotype_components(F.col(nt_col))
    acc = F.regexp_extract(trim_key(F.col(nt_col)), r"^([^:]+):", 1)
    seq = trim_key(F.col(target))
    names = [c for c in df.columns if c != orig]
    i = names.index(nt_col)
    shaped = lambda d, new: d.select(*map(_col, names[:i]), F.col(nt_col).alias(orig), new.alias(nt_col), *map(_col, names[i + 1 :]))
    whole = settled(df, _is=parts.isNotNull() & ((acc != "") | (seq != "")))
    rest = shaped(whole.filter(~F.coalesce("_is", F.lit(False))), F.col(nt_col))  # most rows: they pass by
    rows = whole.filter("_is").drop("_is")
    # the new string follows from the old one and the target: each such pair is looked up and composed once, however many rows have it
    pairs = rows.select(_col(nt_col), _col(target)).distinct().withColumn(ROW, F.struct(_col(nt_col), _col(target)))
    asked = pairs.select(ROW, acc.alias("_a"), F.when(acc == "", seq).otherwise("").alias("_s"), F.posexplode(parts).alias("_i", "_x"))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    table = mapping.select(blank("accession").alias("_a"), blank("target").alias("_s"), F.col("component").alias("_x"), "mapped_c").dropDuplicates(["_a", "_s", "_x"])
    plain = F.upper(F.regexp_extract(trim_key(F.col("mapped_c")), r"^(?:[^:]+:)?c\.(\d+[ACGTNacgtn]>[ACGTNacgtn])$", 1))
    got = asked.join(table, ["_a", "_s", "_x"], "left").withColumn("_m", F.nullif(plain, F.lit("")))
    mapped = got.groupBy(ROW).agg(F.every(F.col("_m").isNotNull()).alias("_ok"), F.array_sort(F.collect_list(F.struct("_i", "_m"))).alias("_l"))
    found = mapped.filter("_ok").select(F.col(ROW).getField(nt_col).alias(nt_col), F.col(ROW).getField(target).alias(target), F.col("_l._m").alias("_parts"))
    prefix = F.when(acc == "", "").otherwise(F.concat(acc, F.lit(":")))
    made = compose_delins(found, "_parts", target).filter(F.col("composed").isNotNull())
    made = made.select(_col(nt_col).alias("_old"), _col(target).alias("_of"), F.concat(prefix, F.col("composed")).alias("_new"))
    out = rows.join(made, _col(nt_col).eqNullSafe(F.col("_old")) & _col(target).eqNullSafe(F.col("_of")), "left")
    return shaped(out, F.coalesce("_new", F.col(nt_col))).unionByName(rest)
