"""Queries of the annotation joins (C, D12-D14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate as A
from ..operators import mapping as M
from .base import packed, query, slots

#: The variants' own key.
_ROW = ["row_id"]
_STARS = "case when review_status is null then null when review_status = 'practice guideline' then '4' when review_status = 'Reviewed by expert panel' then '3' when review_status like 'criteria%' then '1' when review_status like 'no assertion%' then '0' else '' end"


@query("C5_resolve_allele_ids", f"""select row_id, {packed("coalesce(r1.id, r2.id)")} as allele_ids from {slots('{variants}', s_c='c', s_g='ids')} v
  left join (select distinct 'NM_' || (p_partkey % 300) || '.1:c.' || p_partkey || 'A>G' as hgvs, 'CA' || p_partkey as id from part where p_size < 30) r1 on r1.hgvs = s_c
  left join (select 'CA' || p_partkey as hgvs, 'CA0' || p_partkey as id from part where p_size < 40) r2 on r2.hgvs = s_g group by 1""")
def c5(t):
    registry = t.sql("""select 'NM_' || cast(p_partkey % 300 as string) || '.1:c.' || cast(p_partkey as string) || 'A>G' as hgvs, 'CA' || cast(p_partkey as string) as id from {part} where p_size < 30
      union all select 'CA' || cast(p_partkey as string) as hgvs, 'CA0' || cast(p_partkey as string) as id from {part} where p_size < 40 union all select 'x' as hgvs, '_:CA' as id""")
    return A.resolve_allele_ids(t.variants, registry, "c", "ids", "allele_ids", key=_ROW).select("row_id", "allele_ids")


@query("C6_annotate_clinvar", f"""select row_id, {packed('variation_id')} as variation_id, {packed('allele_id')} as allele_id, {packed('sig')} as significance, {packed('review')} as review, {packed('stars')} as stars
  from {slots('{variants}', s='ids')} v left join (select caid, variation_id, allele_id, case when p_size > 5 then clinical_significance end as sig, case when p_size > 5 then review_status end as review, case when p_size > 5 then {_STARS} end as stars from {{clinvar}}) c on c.caid = s group by 1""")
def c6(t):
    c = t.clinvar
    out = A.annotate_clinvar(t.variants, c.select("caid", "variation_id", "allele_id"), c.filter("p_size > 5").select("allele_id", "clinical_significance", "review_status", F.lit("").alias("last_review_date")), "ids", key=_ROW)
    names = {"variation_id": "variation_id", "allele_id": "allele_id", "clinical_significance": "significance", "review_status": "review", "stars": "stars"}
    return out.select("row_id", *(F.col(f"`clinvar.202601.{k}`").alias(v) for k, v in names.items()))


_FREQ = "select 'CA' || cast(k as string) as caid, chrom, cast(pos as bigint) as pos, ref, alt, cast(p_size as bigint) as allele_count, cast(case when k % 6 = 0 then 0 else 64 end as bigint) as allele_number, cast(null as double) as faf95_max, p_brand as faf95_max_ancestry from {alleles}"


@query("C7_frequency_by_coords", f"""select row_id, {packed('cast(allele_count as varchar)')} as ac, {packed('faf95_max_ancestry')} as ancestry, sum(allele_count / 64.0)::double as af_sum from {slots('{variants}', s_chrom='chroms', s_pos='starts', s_ref='refs', s_alt='alts')} v
  left join (select * from ({_FREQ}) where allele_number > 0) f on f.chrom = s_chrom and cast(f.pos as varchar) = s_pos and f.ref = s_ref and f.alt = s_alt group by 1""")
def c7(t):
    out = A.annotate_frequency(t.variants, t.sql(_FREQ).drop("caid"), coordinates=("chroms", "starts", "refs", "alts"), key=_ROW)
    af = F.aggregate(F.transform(F.split("`gnomad.v4_1.allele_frequency`", r"\|"), lambda x: x.try_cast("double")), F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    return out.select("row_id", F.col("`gnomad.v4_1.allele_count`").alias("ac"), F.col("`gnomad.v4_1.faf95_max_ancestry`").alias("ancestry"), F.when(F.col("`gnomad.v4_1.allele_count`").rlike("[0-9]"), af).alias("af_sum"))


@query("C8_frequency_by_id", f"""select row_id, {packed('cast(allele_count as varchar)')} as ac from {slots('{variants}', s='ids')} v left join (select * from ({_FREQ}) where allele_number > 0 and alt = substr('ACGT', cast(1 + (cast(substr(caid, 3) as bigint) + 1) % 4 as int), 1)) f on f.caid = s group by 1""")
def c8(t):
    freq = t.sql(_FREQ).filter("alt = substr('ACGT', cast(1 + (cast(substr(caid, 3) as bigint) + 1) % 4 as int), 1)").select("caid", "allele_count", "allele_number", "faf95_max", "faf95_max_ancestry")
    df = t.variants.withColumn("padded", F.regexp_replace("ids", "CA", "CA00"))
    return A.annotate_frequency(df, freq, mode="caid", ids_col="padded", key=_ROW).select("row_id", F.col("`gnomad.v4_1.allele_count`").alias("ac"))


@query("C9_id_to_coords", f"""select caid, a.chrom as chrom, a.pos as pos, a.ref as ref, a.alt as alt from (select s as caid, min(struct_pack(chrom := s_chrom, pos := cast(s_pos as bigint), ref := s_ref, alt := s_alt)) as a
  from {slots('{variants}', s='ids', s_chrom='chroms', s_pos='starts', s_ref='refs', s_alt='alts')} v where s <> '' group by 1)""")
def c9(t):
    return A.id_to_coords(t.variants, "ids", {"chrom": "chroms", "pos": "starts", "ref": "refs", "alt": "alts"})


_SPLICE = "select cast(k % 2 as int) as file_rank, cast(k as bigint) as line, case when k % 3 = 0 then 'chr' else '' end || chrom as chrom, cast(pos as bigint) as pos, ref, alt, 'SpliceAI=' || alt || '|G|0.' || cast(10 + p_size as string) || '|0.2|0.3|0.05|1|-2|3|' || cast(p_size as string) as info from {alleles}"


_F4 = "printf('%.4f', {}::double)"


@query("C10_spliceai_exact", f"""select row_id, {packed("case when p_size is not null then " + _F4.format("(10 + p_size) / 100.0") + " end")} as ds_ag, {packed("case when p_size is not null then " + _F4.format("greatest((10 + p_size) / 100.0, 0.3)") + " end")} as ds_max
  from {slots('{variants}', s_chrom='chroms', s_pos='starts', s_ref='refs', s_alt='alts')} v left join {{alleles}} f on f.chrom = s_chrom and cast(f.pos as varchar) = s_pos and f.ref = s_ref and f.alt = s_alt group by 1""")
def c10(t):
    out = A.annotate_spliceai(t.variants, t.sql(_SPLICE), "g", key=_ROW)
    return out.select("row_id", F.col("`spliceai.ds_ag`").alias("ds_ag"), F.col("`spliceai.max_delta_score`").alias("ds_max"))


# all shapes, against lines of right and wrong lengths: ``p_partkey % 7`` chooses a line's alleles
_SHAPED = """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 7 as kind, 'NC_000001.11:g.' || case l_linenumber % 7
    when 0 then cast(l_partkey + 1 as string) || 'del' when 1 then cast(l_partkey + 1 as string) || '_' || cast(l_partkey + 2 as string) || 'del'
    when 2 then cast(l_partkey as string) || '_' || cast(l_partkey + 1 as string) || 'insgt' when 3 then cast(l_partkey as string) || 'delinsTT' when 4 then cast(l_partkey + 1 as string) || '_' || cast(l_partkey + 2 as string) || 'dup'
    when 5 then cast(l_partkey as string) || 'ac>t' else cast(l_partkey as string) || '_' || cast(l_partkey + 1 as string) || 'inv' end as g from {lineitem}"""
_FORMS = "case p_partkey % 7 when 0 then 'AC' when 1 then 'ACG' when 5 then 'AC' else 'A' end as ref, case p_partkey % 7 when 2 then 'AGT' when 3 then 'TT' when 4 then 'AGG' when 5 then 'T' when 6 then 'CGT' else 'A' end as alt"
_FIT = """(kind = 0 and length(ref) = 2 and length(alt) = 1) or (kind = 1 and length(ref) = 3 and length(alt) = 1) or (kind = 2 and length(ref) = 1 and alt = ref || 'GT')
  or (kind = 3 and length(ref) = 1 and alt = 'TT') or (kind = 4 and length(ref) = 1 and length(alt) = 3) or (kind = 5 and ref = 'AC' and alt = 'T')"""


@query("C11_spliceai_shapes", f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when {_FIT} then printf('%.4f', (10 + p.p_size) / 100.0::double) else '' end as ds_ag from ({_SHAPED}) d left join (select p_partkey, p_size, {_FORMS} from part) p on p.p_partkey = d.l_partkey""")
def c11(t):
    lines = t.sql(f"select 0 as file_rank, p_partkey as line, '1' as chrom, p_partkey as pos, {_FORMS}, p_size from {{part}}")
    info = F.concat(F.lit("SpliceAI="), "alt", F.lit("|G|0."), (10 + F.col("p_size")).cast("string"), F.lit("|0|0|0|1|2|3|4,ZZ|G|0.01|0|0|0|1|2|3|4"))
    out = A.annotate_spliceai(t.sql(_SHAPED), lines.withColumn("info", info).drop("p_size"), "g")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("`spliceai.ds_ag`").alias("ds_ag"))


_PADS = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, 100 + l_partkey as p, l_linenumber % 5 as kind from {lineitem}"
_BASE = "substr('ACGTTGCA', cast(1 + (({0}) * 7 + 2) % 8 as int), 1)"
_AT = [_BASE.format(f"p + {i}") if i >= 0 else _BASE.format(f"p - {-i}") for i in (-1, 0, 1)]


@query("H13_hgvs_g_to_vcf", f"""with x as ({_PADS}) select l_orderkey, l_linenumber, l_partkey, l_suppkey, '1' as chrom, case when kind in (0, 3) then p - 1 else p end as pos,
  case kind when 0 then {_AT[0]} || {_AT[1]} || {_AT[2]} when 1 then {_AT[1]} when 2 then {_AT[1]} || {_AT[2]} when 3 then {_AT[0]} else 'A' end as ref,
  case kind when 0 then {_AT[0]} when 1 then {_AT[1]} || 'TT' when 2 then 'GGG' when 3 then {_AT[0]} || {_AT[1]} else 'CC' end as alt from x""")
def h13(t):
    from .expressions import genome

    rows = t.sql(f"""select *, 'NC_000001.11:g.' || cast(p as string) || case kind when 0 then '_' || cast(p + 1 as string) || 'del' when 1 then '_' || cast(p + 1 as string) || 'instt'
      when 2 then '_' || cast(p + 1 as string) || 'delinsGGG' when 3 then 'dup' else 'a>cc' end as g from ({_PADS})""")
    out = A.hgvs_g_to_vcf(rows, chunks=genome(t, ["NC_000001.11"]), size=100)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "chrom", "pos", "ref", "alt")


@query("K8_spliceai_refseq", f"""with x as ({_PADS}), r as (select p_partkey, p_size, 100 + p_partkey - 1 as p0 from part)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when kind in (0, 3) and p_size is not null and (p_partkey % 2 = 0) = (kind = 0) then printf('%.4f', (10 + p_size) / 100.0::double) else '' end as ds_ag
  from x left join r on p_partkey = l_partkey""")
def k8(t):
    """Deletions and duplications by their exact alleles: every other line has the deletion's, the others the duplication's."""
    from .expressions import genome

    rows = t.sql(f"""select *, 'NC_000001.11:g.' || cast(p as string) || case kind when 0 then '_' || cast(p + 1 as string) || 'del' when 3 then 'dup' else 'inv' end as g from ({_PADS})""")
    a, b, c = (_BASE.format(f"p_partkey + {i}") for i in (99, 100, 101))
    lines = t.sql(f"""select 0 as file_rank, p_partkey as line, 'chr1' as chrom, 99 + p_partkey as pos, case when p_partkey % 2 = 0 then {a} || {b} || {c} else {a} end as ref,
      case when p_partkey % 2 = 0 then {a} else {a} || {b} end as alt, p_size from {{part}}""")
    entry = lambda alt, ds: F.concat(alt, F.lit("|G|0."), ds, F.lit("|0|0|0|1|2|3|4"))
    info = F.concat(F.lit("SpliceAI="), entry(F.col("alt"), (10 + F.col("p_size")).cast("string")), F.lit(","), entry(F.lit("N"), F.lit("99")))
    lines = lines.withColumn("info", info).drop("p_size")
    wrong = lines.withColumns({"line": F.col("line") - 1000000, "ref": F.concat(F.lit("N"), F.substr("ref", F.lit(2)))})  # right lengths, other bases
    out = A.annotate_spliceai(rows, wrong.unionByName(lines), "g", chunks=genome(t, ["NC_000001.11"]), size=100)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("`spliceai.ds_ag`").alias("ds_ag"))


@query("C12_annotate_missense", f"""select row_id, {packed("case when p_size is not null then " + _F4.format("p_size") + " end")} as revel, {packed("case when p_size is not null then " + _F4.format("p_size / 2.0") + " end")} as am, {packed('p_brand')} as am_class, case when max(p_size) is not null then printf('%.4f', max(p_size)::double) end as mutpred2
  from {slots('{variants}', s_chrom='chroms', s_pos='starts', s_ref='refs', s_alt='alts')} v left join {{alleles}} f on f.chrom = s_chrom and cast(f.pos as varchar) = s_pos and f.ref = s_ref and f.alt = s_alt group by 1""")
def c12(t):
    a = t.sql("select chrom, cast(pos as bigint) as pos, ref, alt, p_size, p_brand, k as line from {alleles}")
    revel = a.select("chrom", "pos", "ref", "alt", F.col("p_size").cast("string").alias("score"))
    revel = revel.unionByName(revel.withColumn("score", F.lit("1"))).unionByName(revel.withColumn("chrom", F.concat(F.lit("chr"), "chrom")).withColumn("score", F.lit("999")))
    am = a.select("chrom", "pos", "ref", "alt", (F.col("p_size") / 2).cast("string").alias("score"), F.col("p_brand").alias("class"), "line")
    am = am.unionByName(am.withColumn("class", F.lit("later")).withColumn("line", F.col("line") + 10**9))
    db = a.select("chrom", "pos", "ref", "alt", F.concat_ws(";", F.lit("."), F.col("p_size").cast("string"), F.lit("0.5")).alias("mutpred2_score"))
    out = A.annotate_missense(t.variants, revel, am, db, "g", key=_ROW)
    return out.select("row_id", F.col("`revel.score`").alias("revel"), F.col("`alphamissense.score`").alias("am"), F.col("`alphamissense.class`").alias("am_class"), F.col("`mutpred2.score`").alias("mutpred2"))


# three keys: by string, by variation and by allele; the record of a key is the part's
_EVIDENCE = "select p_partkey as record, 'U' || cast(p_partkey % 500 as string) as uuid, p_brand as panel, 'NM_' || cast(p_partkey % 300 as string) || '.1(GENE):c.' || cast(p_partkey as string) || 'A>G' as expression, 'V' || cast(p_partkey as string) as variation_id, 'CA' || cast(p_partkey as string) as caid, p_size from {part}"
_EKEYS = "select row_id, c as hgvs_col, replace(ids, 'CA', 'V') as variation_col, case when row_id % 2 = 0 then ids else replace(ids, 'CA1', 'CA2') end as caid_col from {variants}"
_HIT = """with e as (select * from (@E)), s as (select * from @S),
hits as (select row_id, slot, 0 as rank, 'hgvs' as key, record, uuid, panel from s join e on replace(expression, '(GENE)', '') = s_h where e.p_size < 30
  union all select row_id, slot, 1, 'clinvar', record, uuid, panel from s join e on variation_id = s_v where e.p_size < 35
  union all select row_id, slot, 2, 'caid', record, uuid, panel from s join e on caid = s_i where e.p_size < 40),
once as (select row_id, slot, uuid, min(rank * 1000000 + record) as o from hits group by 1, 2, 3),
one as (select distinct o.row_id, o.slot, o.o, h.panel, h.uuid from once o join hits h on h.row_id = o.row_id and h.slot = o.slot and h.uuid = o.uuid and h.rank * 1000000 + h.record = o.o)
"""
_HIT = _HIT.replace("@E", _EVIDENCE).replace("@S", slots(f"({_EKEYS})", s_h="hgvs_col", s_v="variation_col", s_i="caid_col"))


def evidence_records(t):
    e = t.sql(_EVIDENCE)
    return e.select("record", "uuid", "panel", F.when(F.col("p_size") < 30, F.array("expression")).otherwise(F.array().cast("array<string>")).alias("hgvs"), F.when(F.col("p_size") < 35, F.col("variation_id")).otherwise("").alias("variation_id"), F.when(F.col("p_size") < 40, F.col("caid")).otherwise("").alias("caid"))


def _evidence(t):
    return A.annotate_evidence(t.sql(_EKEYS), evidence_records(t), "hgvs_col", "variation_col", "caid_col", ["panel", "uuid"], key=_ROW)


@query("C13_annotate_evidence", _HIT + f""", merged as (select row_id, slot, string_agg(uuid, ' | ' order by o) as uuids from one group by 1, 2)
select s.row_id, {packed('uuids').replace('order by slot', 'order by s.slot')} as uuids from s left join merged m on m.row_id = s.row_id and m.slot = s.slot group by 1""")
def c13(t):
    return _evidence(t).select("row_id", F.col("`clingen_evidence_repository.uuid`").alias("uuids"))


@query("C14_evidence_warnings", _HIT + """, k as (select s.row_id, s.slot, s_h, s_v, s_i, coalesce(list(distinct h.uuid) filter (key = 'hgvs'), []) as uh, coalesce(list(distinct h.uuid) filter (key = 'clinvar'), []) as uv, coalesce(list(distinct h.uuid) filter (key = 'caid'), []) as ui
  from s left join hits h on h.row_id = s.row_id and h.slot = s.slot group by 1, 2, 3, 4, 5),
w as (select *, cast(len(uh) > 0 as int) + cast(len(uv) > 0 as int) + cast(len(ui) > 0 as int) as n,
  list_sort(list_filter([case when len(uh) = 0 and s_h <> '' then '''hgvs''' end, case when len(uv) = 0 and s_v <> '' then '''clinvar''' end, case when len(ui) = 0 and s_i <> '' then '''caid''' end], lambda x: x is not null)) as missed from k)
select row_id, string_agg(case when n > 1 then concat_ws('; ', case when len(uh) > 0 and len(uv) > 0 and not list_has_any(uh, uv) then 'non-overlapping results for keys ''hgvs'' and ''clinvar''' end,
    case when len(uh) > 0 and len(ui) > 0 and not list_has_any(uh, ui) then 'non-overlapping results for keys ''hgvs'' and ''caid''' end, case when len(uv) > 0 and len(ui) > 0 and not list_has_any(uv, ui) then 'non-overlapping results for keys ''clinvar'' and ''caid''' end)
  when n = 1 and len(missed) > 0 then 'found via ' || case when len(uh) > 0 then '''hgvs''' when len(uv) > 0 then '''clinvar''' else '''caid''' end || ' but not ' || array_to_string(missed, ', ') else '' end, '|' order by slot) as warnings from w group by 1""")
def c14(t):
    return _evidence(t).select("row_id", F.col("`clingen_evidence_repository.warnings`").alias("warnings"))


_CALS = """select 'urn:s:' || cast(n_nationkey as string) as score_set, r_regionkey as ordinal, 'cal' || cast(n_nationkey as string) || '-' || cast(r_regionkey as string) as calibration, r_regionkey = 1 and n_nationkey % 2 = 0 as primary_, r_regionkey % 2 = 0 and n_nationkey % 3 > 0 as own, r_regionkey = 4 as research, r_regionkey as r from {nation} cross join {region}"""
_RANGES = """select 'cal' || cast(n_nationkey as string) || '-' || cast(r_regionkey as string) as calibration, x.ordinal, x.label, case when x.low is null then null else x.low + n_nationkey * 10 end as low, case when x.high is null then null else x.high + r_regionkey * 100 end as high, x.low_in, x.high_in
  from {nation} cross join {region} cross join (select 0 as ordinal, 'abnormal' as label, cast(null as double) as low, cast(1000 as double) as high, true as low_in, false as high_in union all select 1, 'normal', 900, 5000, cast(null as boolean), true union all select 2, 'high', 6000, null, false, null) x"""
_SCORED = "select c_custkey, 'urn:s:' || cast(c_nationkey as string) || '#' || cast(c_custkey as string) as urn, case when c_custkey % 9 = 0 then 'x' else cast(c_acctbal as string) end as score from {customer}"
_PICK = f"""with cals as (select *, case when primary_ then 0 when own then 1 when not research then 2 end as k from ({_CALS})),
main as (select score_set, arg_min(calibration, k * 100 + r) as cal from cals where k is not null group by 1), own as (select score_set, arg_min(calibration, r) as cal from cals where own group by 1), ranges as ({_RANGES}),
rows_ as (select *, split_part(urn, '#', 1) as score_set, try_cast(score as double) as s from ({_SCORED}))"""
_LABEL = "(select arg_min(label, ordinal) from ranges where calibration = {0} and (low is null or s > low or (s = low and coalesce(low_in, true))) and (high is null or s < high or (s = high and coalesce(high_in, false))) and s is not null)"


def _calibrations(t):
    return t.sql(_CALS.replace("primary_", "`primary`").replace(" as own", " as investigator").replace("as research,", "as research_only,"))


_ROLES = {"primary": "a", "investigator_provided": "b"}
_EIGHT = ", ".join(f"coalesce({v}, '') as {k}_urn, coalesce('T' || {v}, '') as {k}_name, case when {v} is not null then 'http://x/score-sets/' || score_set else '' end as {k}_url, coalesce(case when {v} like '%-0' then (select r_name from region where r_regionkey = c_custkey % 7 and c_custkey % 2 = 0) else {_LABEL.format(v)} end, '') as {k}_class" for k, v in _ROLES.items())


@query("C15_annotate_calibration", _PICK + f""", j as (select c_custkey, score_set, s, m.cal as a, o.cal as b from rows_ left join main m using (score_set) left join own o using (score_set)) select c_custkey, {_EIGHT} from j""")
def c15(t):
    """Calibrations whose name ends in 0 have classes without ranges: their rows are classified by assignment."""
    by_class = F.col("calibration").endswith("-0")
    ranges = t.sql(_RANGES).filter(~by_class).select("*", F.lit(None).cast("int").alias("id"), F.lit(True).alias("ranged"))
    cals = _calibrations(t).withColumn("title", F.concat(F.lit("T"), "calibration"))
    classes = cals.filter(by_class).select("calibration").crossJoin(F.broadcast(t.region.select("r_regionkey", "r_name")))
    none = {c: F.lit(None).cast("double") for c in ("low", "high")} | {c: F.lit(None).cast("boolean") for c in ("low_in", "high_in")}
    classes = classes.select("calibration", F.col("r_regionkey").cast("int").alias("ordinal"), F.col("r_name").alias("label"), *(v.alias(c) for c, v in none.items()), F.col("r_regionkey").cast("int").alias("id"), F.lit(False).alias("ranged"))
    rows = t.sql(_SCORED)
    given = rows.filter("c_custkey % 2 = 0").select(F.concat(F.lit("cal"), F.regexp_extract("urn", "s:([0-9]+)#", 1), F.lit("-0")).alias("calibration"), "urn", (F.col("c_custkey") % 7).cast("int").alias("class_id"))
    out = A.annotate_calibration(rows, cals, ranges.unionByName(classes), "urn", "score", "m", "http://x", given)
    short = {"urn": "urn", "name": "name", "url": "url", "functional_class": "class"}
    return out.select("c_custkey", *(F.col(f"`m.{r}_calibration.{c}`").alias(f"{r}_{v}") for r in _ROLES for c, v in short.items()))


@query("C16_classify_by_range", f"with ranges as ({_RANGES}), r as (select c_custkey, 'cal' || c_nationkey || '-' || (c_custkey % 5) as calibration, c_acctbal as s from customer) select c_custkey, coalesce({_LABEL.format('r.calibration')}, '') as label from r")
def c16(t):
    rows = t.sql("select c_custkey, 'cal' || cast(c_nationkey as string) || '-' || cast(c_custkey % 5 as string) as calibration, cast(c_acctbal as string) as score from {customer}")
    return A.classify_by_range(rows, t.sql(_RANGES)).select("c_custkey", "label")


@query("C17_classify_by_assignment", "select o_orderkey, coalesce(r_name, '') as label from orders left join (select c_custkey, n_regionkey from customer join nation on n_nationkey = c_nationkey where c_acctbal > 0) a on a.c_custkey = o_custkey left join region on r_regionkey = n_regionkey and r_regionkey > 0")
def c17(t):
    rows = t.orders.select("o_orderkey", F.lit("c").alias("calibration"), F.col("o_custkey").alias("urn"))
    assigned = t.sql("select 'c' as calibration, c_custkey as urn, n_regionkey as class_id from {customer} join {nation} on n_nationkey = c_nationkey where c_acctbal > 0")
    labels = t.sql("select 'c' as calibration, r_regionkey as class_id, r_name as label from {region} where r_regionkey > 0")
    return A.classify_by_assignment(rows, assigned, labels).select("o_orderkey", "label")


_VEP = "select 'CA' || cast(p_partkey as string) as hgvs, case when p_partkey % 11 = 0 then null when p_size < 20 then 'missense_variant' else 'synonymous_variant' end as consequence from {part} where p_partkey % 4 > 0"
_RECODED = "select 'CA' || cast(p_partkey as string) as hgvs, 'CA' || cast(p_partkey + s.i as string) as genomic from {part} cross join (select 1 as i union all select 2 union all select 3) s"


@query("C18_annotate_consequence", f"""with vep as ({_VEP}), worst as (select r.hgvs, arg_min(v.consequence, case v.consequence when 'missense_variant' then 13 else 22 end) as c from ({_RECODED}) r join vep v on v.hgvs = r.genomic where r.hgvs not in (select hgvs from vep) and v.consequence is not null group by 1),
x as (select row_id, slot, coalesce(v.consequence, w.c, '') as c from {slots('{variants}', s='ids')} z left join vep v on v.hgvs = s left join worst w on w.hgvs = s)
select row_id, case when count(distinct nullif(c, '')) = 1 then max(c) else '' end as consequence, case when count(distinct nullif(c, '')) > 1 then 'Discrepant VEP mutational consequences across DNA candidates: ' || string_agg(c, '|' order by slot) else '' end as error, '2024-01-01' as access_date from x group by 1""")
def c18(t):
    out = A.annotate_consequence(t.variants, t.sql(_VEP), t.sql(_RECODED), ["ids", "g"], access_date=F.lit("2024-01-01"), key=_ROW)
    return out.select("row_id", *(F.col(f"`vep.{c}`").alias(c) for c in ("consequence", "error", "access_date")))


@query("C3_join_targets", "select c_custkey, case when c_mktsegment in ('BUILDING', 'MACHINERY') then c_mktsegment else coalesce(r_name, '') end as segment, coalesce(r_regionkey::varchar, '') as region from customer join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey and r_regionkey <> 2")
def c3(t):
    rows = t.sql("select c_custkey, ' ' || cast(n_regionkey as string) as target, case when c_mktsegment in ('BUILDING', 'MACHINERY') then c_mktsegment else ' ' end as segment from {customer} join {nation} on n_nationkey = c_nationkey")
    targets = t.sql("select cast(r_regionkey as string) as name, r_name as segment, cast(r_regionkey as string) as region from {region} where r_regionkey <> 2")
    return M.join_targets(rows, targets.withColumnRenamed("name", "target"), "target", ["segment"]).select("c_custkey", "segment", "region")


_PRIOR = "select l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as line, 'NM_1.1:c.' || cast(l_partkey as string) || 'A>G' as nt, 'p.A1G' as pro, case when l_linenumber = 1 then '' else 'G' || l_returnflag end as mapped_hgvs_g, '' as mapped_hgvs_c, '' as mapped_hgvs_p, '' as mapping_error from {lineitem} where l_quantity < 5"
_WORK = "select p_partkey, ' NM_1.1:c.' || cast(p_partkey as string) || 'A>G' as nt, 'p.Ala1Gly' as pro from {part}"


@query("C4_reuse_existing", f"with p as (select cast(replace(replace(nt, 'NM_1.1:c.', ''), 'A>G', '') as bigint) as k, arg_min(mapped_hgvs_g, line) as g from ({_PRIOR}) where mapped_hgvs_g <> '' group by 1) select p_partkey, coalesce(g, '') as g, g is not null as reused from part left join p on k = p_partkey")
def c4(t):
    hit, rest = M.reuse_existing(t.sql(_WORK), t.sql(_PRIOR), "line", "nt", "pro")
    return hit.select("p_partkey", F.col("mapped_hgvs_g").alias("g"), F.lit(True).alias("reused")).unionByName(rest.select("p_partkey", F.lit("").alias("g"), F.lit(False).alias("reused")))


_ASSOC = "select 'NP_' || cast(l_suppkey as string) || '.1' as pro_ac, case l_partkey % 3 when 0 then 'NM_' when 1 then 'XM_' else 'ENST' end || cast(l_partkey as string) || '.' || cast(1 + l_partkey % 4 as string) as tx_ac from {lineitem}"
_PROT = "select o_orderkey, case o_orderkey % 4 when 0 then 'NM_' || cast(o_custkey as string) || '.1:p.A1G' when 3 then 'p.A1G' else 'NP_' || cast(1 + o_custkey % 150 as string) || '.1:p.A1G' end as p, case when o_orderkey % 8 = 3 then 'NM_9.9:c.1A>G' else '' end as other from {orders}"


@query("C19_resolve_transcript", f"""with best as (select pro_ac, tx_ac from (select *, row_number() over (partition by pro_ac order by case when tx_ac like 'NM%' then 0 when tx_ac like 'XM%' then 2 else 4 end, -cast(split_part(tx_ac, '.', 2) as int), tx_ac) as r from ({_ASSOC})) where r = 1),
x as (select o_orderkey, p, case when p like 'NM%' then split_part(p, ':', 1) when p like 'NP%' and tx_ac is not null then tx_ac when other <> '' then 'NM_9.9' end as tx from ({_PROT}) left join best on pro_ac = split_part(p, ':', 1))
select o_orderkey, coalesce(tx, '') as transcript, case when tx is null then 'No transcript for ' || p else '' end as transcript_error from x""")
def c19(t):
    return M.resolve_transcript(t.sql(_PROT), t.sql(_ASSOC), "p", ("other",)).select("o_orderkey", "transcript", "transcript_error")


@query("C20_lookup_strand", "select o_orderkey, coalesce((select cast(min(case when p_size % 2 = 0 then 1 else -1 end) as varchar) from part where p_partkey = o_custkey and p_size > 10), '') as strand from orders")
def c20(t):
    aln = t.sql("select cast(p_partkey as string) as tx_ac, case when p_size % 2 = 0 then 1 else -1 end as strand, case when p_size > 10 then 'splign' else 'other' end as method from {part}")
    return M.lookup_strand(t.orders.withColumn("tx", F.col("o_custkey").cast("string")), aln, "tx").select("o_orderkey", "strand")


@query("C21_ensembl_to_refseq", "select o_orderkey, coalesce((select arg_min('NM_' || l_partkey, l_partkey) from lineitem where l_suppkey = o_custkey and l_partkey % 2 = 0), 'ENST' || o_custkey || '.3') as refseq from orders")
def c21(t):
    xrefs = t.sql("select 'ENST' || cast(l_suppkey as string) as ensembl, case when l_partkey % 2 = 0 then 'NM_' else 'XM_' end || cast(l_partkey as string) as xref, l_partkey as ordinal from {lineitem}")
    rows = t.orders.select("o_orderkey", F.concat(F.lit("ENST"), F.col("o_custkey").cast("string"), F.lit(".3")).alias("tx"))
    return M.ensembl_to_refseq(rows, xrefs, "tx").select("o_orderkey", "refseq")


_REG = "select 'NC_1.1:g.' || cast(p_partkey as string) as hgvs, case when p_size > 10 then 'NC_9.9:g.' || cast(p_partkey as string) end as g, case when p_size > 20 then 'NM_1.1:c.' || cast(p_partkey as string) end as c, case when p_size > 30 then 'NP_1.1:p.' || cast(p_partkey as string) end as p, 'CA' || cast(p_partkey as string) as id, p_partkey, p_size from {part} where p_size > 3"


@query("C22_join_mapping_results", f"""select o_orderkey, case when r.id is null then '' else coalesce(r.g, 'NC_1.1:g.' || o_custkey) end as mapped_hgvs_g, coalesce(r.c, 'raw' || o_custkey) as mapped_hgvs_c, coalesce(r.p, '') as mapped_hgvs_p, coalesce(r.id, '') as clingen_allele_id,
  case when r.id is null then 'ClinGen returned no data for ' || chr(39) || 'NC_1.1:g.' || o_custkey || chr(39) else '' end as mapping_error from orders left join ({_REG}) r on r.p_partkey = o_custkey""")
def c22(t):
    rows = t.orders.select("o_orderkey", F.concat(F.lit("raw"), F.col("o_custkey").cast("string")).alias("nt"))
    assays = t.sql("select distinct 'raw' || cast(o_custkey as string) as raw, 'NC_1.1:g.' || cast(o_custkey as string) as assay from {orders}")
    return M.join_accessioned(rows, assays, t.sql(_REG).drop("p_partkey", "p_size"), "nt").drop("nt")


@query("C23_join_mapped_groups", f"""with x as (select o_orderkey, o_custkey, case o_orderkey % 4 when 0 then null when 1 then 'NP_1.1:p.' || o_custkey else 'NC_1.1:g.' || o_custkey end as assay from orders)
select o_orderkey, case when r.id is not null then coalesce(r.g, '') when assay like 'NC%' then assay else '' end as mapped_hgvs_g, coalesce(r.c, '') as mapped_hgvs_c, case when r.id is not null then coalesce(r.p, '') when assay like 'NP%' then assay else '' end as mapped_hgvs_p, coalesce(r.id, '') as clingen_allele_id,
  case when assay is null then 'failed' when r.id is null then 'ClinGen returned no data for ' || chr(39) || assay || chr(39) else '' end as mapping_error from x left join ({_REG}) r on r.hgvs = x.assay""")
def c23(t):
    res = t.sql("select o_orderkey as row, case o_orderkey % 4 when 0 then null when 1 then 'NP_1.1:p.' || cast(o_custkey as string) else 'NC_1.1:g.' || cast(o_custkey as string) end as assay, case when o_orderkey % 4 = 0 then 'failed' else '' end as error from {orders}")
    return M.join_mapped_groups(t.orders.select("o_orderkey"), res, t.sql(_REG).drop("p_partkey", "p_size"), "o_orderkey")


@query("C24_join_reverse_candidates", """with l as (select l_suppkey as k, string_agg('c' || l_partkey, '|' order by l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey, l_partkey) as c from lineitem where l_quantity > 30 group by 1)
select o_orderkey, case when o_orderkey % 2 = 0 then coalesce(c, '') else 'own' end as mapped_hgvs_c, case when o_orderkey % 2 = 0 and c is null then case when o_custkey % 3 = 0 then 'bad' else 'Reverse translation returned no candidate DNA variants for p' || o_custkey end else '' end as error from orders left join l on k = o_custkey""")
def c24(t):
    cand = t.sql("select 'T' as transcript, 'p' || cast(l_suppkey as string) as hgvs_p, struct(l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as o, l_partkey) as ordinal, 'c' || cast(l_partkey as string) as hgvs_c, 'g' as hgvs_g from {lineitem} where l_quantity > 30")
    errs = t.sql("select distinct 'T' as transcript, 'p' || cast(o_custkey as string) as hgvs_p, 'bad' as error from {orders} where o_custkey % 3 = 0")
    rows = t.sql("select o_orderkey, 'T' as transcript, 'p' || cast(o_custkey as string) as hgvs_p, case when o_orderkey % 2 = 0 then 'protein' else 'dna' end as level, 'own' as mapped_hgvs_c, '' as mapped_hgvs_g from {orders}")
    return M.join_reverse_candidates(rows, cand, errs, "hgvs_p").select("o_orderkey", "mapped_hgvs_c", F.col("reverse_translation_error").alias("error"))


_TARGET = "ATGGCCAAGTTTCCCGGGAAACCCTTTGGGATCGATCGGCTAGCATGCATG"


@query("C25_rewrite_haplotypes", f"""with x as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, 1 + l_partkey % 40 as a, 1 + l_partkey % 40 + 1 + l_suppkey % 2 as b, case when l_linenumber % 2 = 0 then 'NM_1.1:' else '' end as acc from lineitem),
y as (select *, acc || 'c.[' || a || substr('{_TARGET}', a, 1) || '>T;' || b || substr('{_TARGET}', b, 1) || '>G]' as nt, acc <> '' and a % 7 = 0 or acc <> '' and b % 7 = 0 as unmapped, case when acc = '' then 3 else 0 end as d from x),
z as (select *, substr('{_TARGET}', a, 1) || substr('{_TARGET}', a + 1 + d, b - a - 1) || substr('{_TARGET}', b, 1) as ref, 'T' || substr('{_TARGET}', a + 1 + d, b - a - 1) || 'G' as alt, (a - 1) // 3 = (b - 1) // 3 as same from y)
select l_orderkey, l_linenumber, l_partkey, l_suppkey, nt as orig_raw_hgvs_nt, case when same and ref <> alt and not unmapped then acc || 'c.' || (a + d) || '_' || (b + d) || 'delins' || alt else nt end as nt from z""")
def c25(t):
    """Strings with an accession keep their places, those of the target sequence move by one codon; places that 7 divides are
    not mapped for the accession."""
    rows = t.sql(f"""select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(1 + l_partkey % 40 as int) as a, cast(2 + l_partkey % 40 + l_suppkey % 2 as int) as b,
      case when l_linenumber % 2 = 0 then 'NM_1.1:' else '' end as acc, '{_TARGET}' as target from {{lineitem}}""")
    base = lambda c: F.substring(F.col("target"), F.col(c), F.lit(1))
    nt = F.concat("acc", F.lit("c.["), F.col("a").cast("string"), base("a"), F.lit(">T;"), F.col("b").cast("string"), base("b"), F.lit(">G]"))
    sites = t.sql(f"select distinct cast(1 + p_partkey % 42 as int) as p, '{_TARGET}' as target from {{part}}").withColumn("r", base("p"))
    parts = sites.select("p", "r", "target", F.explode(F.array(F.lit("T"), F.lit("G"))).alias("x"))
    hgvs = lambda p: F.concat(p.cast("string"), "r", F.lit(">"), "x")
    own = parts.filter("p % 7 > 0").select(F.lit("NM_1.1").alias("accession"), F.lit("").alias("target"), hgvs(F.col("p")).alias("component"), F.concat(F.lit("NM_1.1:c."), hgvs(F.col("p"))).alias("mapped_c"))
    moved = parts.select(F.lit("").alias("accession"), "target", hgvs(F.col("p")).alias("component"), F.concat(F.lit("NM_2.1:c."), hgvs(F.col("p") + 3)).alias("mapped_c"))
    return M.rewrite_haplotypes(rows.withColumn("nt", nt), own.unionByName(moved), "nt", "target").drop("a", "b", "acc", "target")


@query("C26_lookup_worklist", "select distinct l_partkey::varchar as key from lineitem where l_partkey not in (select p_partkey from part where case when p_size > 25 then p_size <= 50 - 0 and p_size * 3 <= 100 else p_size <= 1 end)")
def c26(t):
    keys = t.lineitem.select(F.concat(F.lit(" "), F.col("l_partkey").cast("string")).alias("key"))
    days = F.when(F.col("p_size") > 25, F.col("p_size") * 3).otherwise(F.col("p_size"))
    cache = t.part.select(F.col("p_partkey").cast("string").alias("key"), (F.col("p_size") > 25).alias("found"), F.date_sub(F.lit("2024-06-30").cast("date"), days).alias("fetched_at"))
    return M.lookup_worklist(keys, cache, F.lit("2024-06-30"))


@query("C27_fetch_ref_bases", """with s as (select 'A' || (l_suppkey % 5) as accession, 1 + l_partkey as start, 1 + l_partkey + l_linenumber as stop from lineitem group by 1, 2, 3)
select accession, start, stop, case when stop <= 2000 then (select string_agg(substr('ACGTTGCA', cast(1 + (x * 7 + length(accession)) % 8 as int), 1), '' order by x) from unnest(generate_series(start, stop)) t(x)) end as bases from s""")
def c27(t):
    spans = t.sql("select distinct 'A' || cast(l_suppkey % 5 as string) as accession, 1 + l_partkey as start, 1 + l_partkey + l_linenumber as stop from {lineitem}")
    chunks = t.sql("select distinct 'A' || cast(s_suppkey % 5 as string) as accession from {supplier}").select("accession", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long"))).alias("chunk"))
    seq = F.array_join(F.transform(F.sequence(F.col("chunk") * 100 + 1, F.col("chunk") * 100 + 100), lambda x: F.substring(F.lit("ACGTTGCA"), (1 + (x * 7 + 2) % 8).cast("int"), F.lit(1))), "")
    return M.fetch_ref_bases(spans, chunks.withColumn("seq", seq), 100)


# mapping: strings with an accession, of a target sequence, protein strings, and unusable ones
_MAPPED_IN = """select o_orderkey, case o_orderkey % 8 when 0 then 'raw:' || cast(o_custkey as string) when 1 then 'c.' || cast(o_custkey as string) || 'A>G' when 2 then '_wt' when 3 then ' ' when 4 then 'NC_1.1:g.' || cast(o_custkey as string) else 'c.5A>G' end as raw_hgvs_nt,
  case o_orderkey % 8 when 2 then 'p.A' || cast(o_custkey as string) || 'G' when 3 then 'NA' else '' end as raw_hgvs_pro, case when o_orderkey % 8 = 5 then '' else 'SEQ' end as target_sequence, 'T' || cast(o_custkey % 3 as string) as target_name from {orders}"""


@query("K2_map_variants", f"""with x as (select o.*, o_orderkey % 8 as k, c.o_custkey from ({_MAPPED_IN}) o join orders c using (o_orderkey)),
done as (select o_custkey from orders where o_custkey % 10 = 0 group by 1),
s as (select *, case when target_name = 'T0' and target_sequence = '' then 'TSEQ' else target_sequence end as seq, k = 1 and o_custkey % 10 = 0 as had from x),
a as (select *, case when k = 0 then 'NC_1.1:g.' || o_custkey when k = 4 then raw_hgvs_nt when k = 1 and o_custkey % 3 = 0 then 'NC_1.1:g.' || o_custkey when k = 2 and o_custkey % 5 > 0 then 'NP_1.1:p.' || o_custkey end as assay, k = 1 and o_custkey % 3 = 1 as failed from s)
select o_orderkey, case k when 2 then 'p.Ala' || o_custkey || 'Gly' when 3 then 'NA' else '' end as raw_hgvs_pro, seq as target_sequence,
  case when had then 'G' || o_custkey when r.id is not null then coalesce(r.g, case when k in (0, 4) then assay end, '') when k = 1 and assay is not null then assay else '' end as mapped_hgvs_g,
  case when had then '' when k in (0, 4) then coalesce(r.c, raw_hgvs_nt) else coalesce(r.c, '') end as mapped_hgvs_c,
  case when had then '' when r.id is not null then coalesce(r.p, '') when k = 2 and assay is not null then assay else '' end as mapped_hgvs_p,
  case when had then '' when k = 3 then 'No usable HGVS variant data in this row' when k in (0, 4) and r.id is null then 'ClinGen returned no data for ' || chr(39) || assay || chr(39)
    when k > 4 and seq = '' then 'target_sequence is required for case 2 but column ''target_sequence'' is missing or blank' when failed then 'bad' when k not in (0, 4) and assay is null then 'No HGVS string produced by mapper' when r.id is null then 'ClinGen returned no data for ' || chr(39) || assay || chr(39)
    when k not in (0, 4) and r.g is null and r.c is null and r.p is null and k <> 1 then 'Mapping produced no HGVS output' else '' end as mapping_error,
  '' as mapping_warnings, case when not had and k in (1, 2) and assay is not null then 'd' || o_custkey else '' end as dna_vrs_digest, '' as protein_vrs_digest,
  case when had then '' when k in (0, 4) then case when r.c is not null then '1' else '' end when k in (1, 2) and not (k = 1 and o_custkey % 3 = 2) then '-1' else '' end as strand, case when had then '' else coalesce(r.id, '') end as clingen_allele_id
from a left join ({_REG}) r on r.hgvs = a.assay""")
def k2(t):
    targets = t.sql("select 'T0' as target_name, 'TSEQ' as target_sequence from {region} where r_regionkey = 0")
    assays = t.sql("select distinct 'raw:' || cast(o_custkey as string) as raw, 'NC_1.1:g.' || cast(o_custkey as string) as assay from {orders}")
    dna = t.sql("""select distinct 'SEQ' as target, 'c.' || cast(o_custkey as string) || 'A>G' as nt, '' as pro, case when o_custkey % 3 = 0 then 'NC_1.1:g.' || cast(o_custkey as string) end as assay,
      case when o_custkey % 3 = 1 then 'bad' else '' end as error, 'd' || cast(o_custkey as string) as dna_vrs_digest, cast(null as string) as protein_vrs_digest, -1 as strand from {orders} where o_custkey % 3 < 2""")
    pro = t.sql("""select distinct 'SEQ' as target, '_wt' as nt, 'p.Ala' || cast(o_custkey as string) || 'Gly' as pro, case when o_custkey % 5 > 0 then 'NP_1.1:p.' || cast(o_custkey as string) end as assay,
      '' as error, 'd' || cast(o_custkey as string) as dna_vrs_digest, cast(null as string) as protein_vrs_digest, -1 as strand from {orders}""")
    prior = t.sql("select distinct 'c.' || cast(o_custkey as string) || 'A>G' as raw_hgvs_nt, '' as raw_hgvs_pro, 'G' || cast(o_custkey as string) as mapped_hgvs_g, o_custkey as line from {orders} where o_custkey % 10 = 0")
    aligned = t.sql("select 'NM_1.1' as tx_ac, 1 as strand, 'splign' as method from {region} where r_regionkey = 0")
    out = M.map_variants(t.sql(_MAPPED_IN), assays, dna.unionByName(pro), t.sql(_REG).drop("p_partkey", "p_size"), aligned, targets, prior, drop=("raw_hgvs_nt",))
    return out.drop("target_name")


@query("K4_add_allele_ids", f"""select row_id, case when position('|' in ids) = 0 and row_id % 2 = 0 and o_custkey % 4 > 0 then 'CA7' else {packed('r.id')} end as ids from (select v.*, s_c, slot from {slots('{variants}', s_c='c')} v) z
  left join (select distinct 'NM_' || (p_partkey % 300) || '.1:c.' || p_partkey || 'A>G' as hgvs, 'CA' || p_partkey as id from part where p_size < 30) r on r.hgvs = s_c group by row_id, ids, o_custkey""")
def k4(t):
    registry = t.sql("select 'NM_' || cast(p_partkey % 300 as string) || '.1:c.' || cast(p_partkey as string) || 'A>G' as hgvs, 'CA' || cast(p_partkey as string) as id from {part} where p_size < 30")
    df = t.variants.select("row_id", F.col("c").alias("mapped_hgvs_c"), F.lit("").alias("mapped_hgvs_g"), F.when(F.col("row_id") % 2 == 0, "CA7").otherwise("").alias("clingen_allele_id"), F.when(F.col("o_custkey") % 4 > 0, "c.1A>G").otherwise("").alias("raw_hgvs_nt"))
    df = df.withColumn("clingen_allele_id", F.when(F.col("raw_hgvs_nt") == "", F.regexp_replace("clingen_allele_id", "CA", "PA")).otherwise(F.col("clingen_allele_id")))
    return A.add_allele_ids(df, registry, key=["row_id"]).select("row_id", F.col("dna_clingen_allele_id").alias("ids"))


@query("K9_consequence_keep_existing", f"""with vep as ({_VEP}), worst as (select r.hgvs, arg_min(v.consequence, case v.consequence when 'missense_variant' then 13 else 22 end) as c from ({_RECODED}) r join vep v on v.hgvs = r.genomic where r.hgvs not in (select hgvs from vep) and v.consequence is not null group by 1),
x as (select row_id, o_custkey, slot, coalesce(v.consequence, w.c, '') as c from {slots('{variants}', s='ids')} z left join vep v on v.hgvs = s left join worst w on w.hgvs = s)
select row_id, case when o_custkey % 3 = 0 then 'kept' when count(distinct nullif(c, '')) = 1 then max(c) else '' end as consequence, case when o_custkey % 3 = 0 then '' else '2024-01-01' end as access_date from x group by row_id, o_custkey""")
def k9(t):
    """Rows that have a consequence pass by; the others are annotated."""
    df = t.variants.withColumn("vep.consequence", F.when(F.col("o_custkey") % 3 == 0, "kept").otherwise(" "))
    out = A.annotate_consequence(df, t.sql(_VEP), t.sql(_RECODED), ["ids", "g"], keep_existing=True, access_date=F.lit("2024-01-01"), key=_ROW)
    return out.select("row_id", *(F.col(f"`vep.{c}`").alias(c) for c in ("consequence", "access_date")))
