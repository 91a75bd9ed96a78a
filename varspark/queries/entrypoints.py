"""Queries of the entry points (K) and of the mapping as a table (J1): whole calls with their defaults, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotate as A
from ..operators import mapping as M
from ..operators import slots as S
from ..operators import tables as T
from ..plans.pipeline import pipeline
from .annotations import _EKEYS, _EVIDENCE, _F4, _HIT, _LABEL, _PICK, _RANGES, _ROLES, _ROW, _SCORED, _STARS, _TARGET, _calibrations
from . import expressions  # noqa: F401  registers the chain whose SQL is read below
from .base import ORACLE_SQL, packed, query, slots


@query("K1_table_utilities", """select o_orderkey as id, case when o_orderstatus = 'F' then 'X' else o_orderstatus end as status, o_orderpriority as priority, c_mktsegment as segment, 'status≠priority' as differences
  from orders join customer on c_custkey = o_custkey and c_nationkey % 2 = 0""")
def k1(t):
    """Columns chosen, renamed and merged, rows filtered and replaced, columns ordered, dropped and compared."""
    rows = T.filter_columns(t.orders, omit=["o_totalprice", "o_orderdate"]).withColumn("o_custkey", F.col("o_custkey").cast("string"))
    rows = T.rename_columns(rows, ["o_orderkey:id", "o_custkey:customer", "o_orderstatus:status", "o_orderpriority:priority"])
    extra = t.sql("select ' ' || cast(c_custkey as string) as customer, c_mktsegment as segment from {customer} where c_nationkey % 2 = 0")
    kept = T.filter_rows(T.merge_columns(rows, extra, ["customer"]), ["segment"])
    newer = kept.filter("status = 'F'").withColumn("status", F.lit("X"))
    whole = T.drop_columns(T.replace_rows([kept, newer], ["id"], "id"), ["_place", "customer"])
    return T.compare_columns(T.reorder_columns(whole, ["id", "segment"]), ["status"], ["priority"])


@query("K6_annotate_clinvar", f"""select row_id, {packed('variation_id')} as variation_id, {packed('allele_id')} as allele_id, {packed('sig')} as significance, {packed('review')} as review, {packed('stars')} as stars, {packed('day')} as reviewed
  from {slots('{variants}', s='ids')} v left join (select caid, variation_id, allele_id, case when p_size > 5 then clinical_significance end as sig, case when p_size > 5 then review_status end as review, case when p_size > 5 then {_STARS} end as stars, case when p_size > 5 then 'day ' || p_size end as day from {{clinvar}}) c on c.caid = s group by 1""")
def k6(t):
    """The default column of allele ids, another release, rows without a key."""
    c = t.clinvar
    summary = c.filter("p_size > 5").select("allele_id", "clinical_significance", "review_status", F.concat(F.lit("day "), F.col("p_size").cast("string")).alias("last_review_date"))
    out = A.annotate_clinvar(t.variants.select("row_id", F.col("ids").alias("dna_clingen_allele_id")), c.select("caid", "variation_id", "allele_id"), summary, version="202412")
    names = {"variation_id": "variation_id", "allele_id": "allele_id", "clinical_significance": "significance", "review_status": "review", "stars": "stars", "last_review_date": "reviewed"}
    return out.select("row_id", *(F.col(f"`clinvar.202412.{k}`").alias(v) for k, v in names.items()))


@query("K10_annotate_missense", f"""select row_id, {packed("case when p_size is not null then " + _F4.format("p_size / 2.0") + " end")} as am, {packed('p_brand')} as am_class, 4 as n_columns
  from {slots('{variants}', s_chrom='chroms', s_pos='starts', s_ref='refs', s_alt='alts')} v left join {{alleles}} f on f.chrom = s_chrom and cast(f.pos as varchar) = s_pos and f.ref = s_ref and f.alt = s_alt group by 1""")
def k10(t):
    """One score table: columns exist for that alone."""
    scores = t.sql("select 'chr' || chrom as chrom, cast(pos as bigint) as pos, ref, alt, cast(p_size / 2 as string) as score, p_brand as class, k as line from {alleles}")
    out = A.annotate_missense(t.variants.select("row_id", F.col("g").alias("mapped_hgvs_g")), alphamissense=scores, key=_ROW)
    return out.select("row_id", F.col("`alphamissense.score`").alias("am"), F.col("`alphamissense.class`").alias("am_class"), F.lit(len(out.columns)).alias("n_columns"))


_TWO = _HIT.replace("select row_id, slot, 0 as rank, 'hgvs' as key, record, uuid, panel from s join e on replace(expression, '(GENE)', '') = s_h where e.p_size < 30\n  union all select row_id, slot, 1, 'clinvar',", "select row_id, slot, 1 as rank, 'clinvar' as key,")


@query("K11_annotate_evidence", _TWO + f""", merged as (select row_id, slot, string_agg(uuid, ' | ' order by o) as uuids from one group by 1, 2),
k as (select row_id, slot, count(distinct key) as n, max(key) as key from hits group by 1, 2)
select s.row_id, {packed('uuids').replace('order by slot', 'order by s.slot')} as uuids,
  string_agg(case when k.n = 1 and k.key = 'clinvar' and s_i <> '' then 'found via ''clinvar'' but not ''caid''' when k.n = 1 and k.key = 'caid' and s_v <> '' then 'found via ''caid'' but not ''clinvar'''
    when k.n = 2 and not list_has_any((select list(h.uuid) from hits h where h.row_id = s.row_id and h.slot = s.slot and h.key = 'clinvar'), (select list(h.uuid) from hits h where h.row_id = s.row_id and h.slot = s.slot and h.key = 'caid')) then 'non-overlapping results for keys ''clinvar'' and ''caid''' else '' end, '|' order by s.slot) as warnings
from s left join merged m on m.row_id = s.row_id and m.slot = s.slot left join k on k.row_id = s.row_id and k.slot = s.slot group by 1""")
def k11(t):
    """Two of the three keys."""
    e = t.sql(_EVIDENCE)
    e = e.select("record", "uuid", "panel", F.array("expression").alias("hgvs"), F.when(F.col("p_size") < 35, F.col("variation_id")).otherwise("").alias("variation_id"), F.when(F.col("p_size") < 40, F.col("caid")).otherwise("").alias("caid"))
    out = A.annotate_evidence(t.sql(_EKEYS), e, "hgvs_col", "variation_col", "caid_col", ["panel", "uuid"], keys=("clinvar", "caid"), key=_ROW)
    return out.select("row_id", F.col("`clingen_evidence_repository.uuid`").alias("uuids"), F.col("`clingen_evidence_repository.warnings`").alias("warnings"))


_FOUR = ", ".join(f"coalesce({v}, '') as {k}_urn, coalesce({_LABEL.format(v)}, '') as {k}_class" for k, v in _ROLES.items())


@query("K12_annotate_calibration", _PICK + f""", j as (select c_custkey, s, m.cal as a, o.cal as b from rows_ left join main m using (score_set) left join own o using (score_set)) select c_custkey, {_FOUR} from j""")
def k12(t):
    """As a step of a chain."""
    step = A.calibration_step(_calibrations(t), t.sql(_RANGES), "urn", "score", "m", "http://x")
    out = pipeline(t.sql(_SCORED), [step], key=["c_custkey"])
    return out.select("c_custkey", *(F.col(f"`m.{r}_calibration.{c}`").alias(f"{r}_{v}") for r in _ROLES for c, v in {"urn": "urn", "functional_class": "class"}.items()))


@query("K13_flatten_candidates", f"""select row_id, o_orderstatus, a as mapped_hgvs_g, b as dna_clingen_allele_id, coalesce(variation_id, '') as variation_id, coalesce(allele_id, '') as allele_id
  from {slots('{variants}', a='g', b='ids')} v left join {{clinvar}} c on c.caid = b where trim(replace(g || ids, '|', ' ')) <> '' or g like '%|%' or ids like '%|%'""")
def k13(t):
    """An annotated table: list columns are found by their names."""
    c = t.clinvar
    rows = t.variants.select("row_id", "o_orderstatus", F.col("g").alias("mapped_hgvs_g"), F.col("ids").alias("dna_clingen_allele_id"))
    out = A.annotate_clinvar(rows, c.select("caid", "variation_id", "allele_id"), c.select("allele_id", "clinical_significance", "review_status", F.lit("").alias("last_review_date")), key=_ROW)
    flat = S.flatten_candidates(out)
    return flat.select("row_id", "o_orderstatus", "mapped_hgvs_g", "dna_clingen_allele_id", *(F.col(f"`clinvar.202601.{k}`").alias(k) for k in ("variation_id", "allele_id")))


# two changes of one codon of the target; every third part has none, every seventh component is not mapped
_PAIRS = f"""select p_partkey, 3 * (p_partkey % 13) + 1 as a, 3 * (p_partkey % 13) + 3 as b, p_partkey % 3 as kind, '{_TARGET}' as target_sequence, p_name from {{part}}"""
_CODON = f"substr('{_TARGET}', cast(a as int), 3)"


@query("K14_rewrite_haplotypes", f"""with x as (select *, {_CODON} as codon, case when substr({_CODON}, 3, 1) = 'C' then 'G' else 'C' end as last from (select p_partkey, (3 * (p_partkey % 13) + 1)::int as a, (3 * (p_partkey % 13) + 3)::int as b, p_partkey % 3 as kind, p_name from part)),
y as (select *, case kind when 0 then p_name when 1 then 'c.' || a || substr(codon, 1, 1) || '>T' else 'c.[' || a || substr(codon, 1, 1) || '>T; ' || b || substr(codon, 3, 1) || '>' || last || ']' end as nt from x)
select p_partkey, nt as orig_raw_hgvs_nt, case when kind = 2 and a % 7 > 0 and b % 7 > 0 and substr(codon, 1, 1) || substr(codon, 3, 1) <> 'T' || last then 'c.' || a || '_' || b || 'delinsT' || substr(codon, 2, 1) || last else nt end as raw_hgvs_nt from y""")
def k14(t):
    """Haplotypes of the target sequence among other strings, with the default column names."""
    rows = _haplotypes(t)
    return M.rewrite_haplotypes(rows, _mapping(rows), key=["p_partkey"]).select("p_partkey", "orig_raw_hgvs_nt", "raw_hgvs_nt")


@query("J1_mapping_table", f"""with x as (select distinct (3 * (p_partkey % 13) + 1)::int as a from part where p_partkey % 3 = 2),
y as (select a, substr('{_TARGET}', a, 3) as codon from x)
select '' as accession, '{_TARGET}' as target, a || substr(codon, 1, 1) || '>T' as component from y union select '', '{_TARGET}', (a + 2) || substr(codon, 3, 1) || '>' || case when substr(codon, 3, 1) = 'C' then 'G' else 'C' end from y""")
def j1(t):
    """What an external mapper is asked for: the components of all haplotypes, once each."""
    return M.haplotype_worklist(_haplotypes(t))


def _haplotypes(t):
    rows = t.sql(f"""select *, {_CODON} as codon from ({_PAIRS})""")
    base = lambda i: F.substring("codon", i, 1)
    last = F.when(base(3) == "C", "G").otherwise("C")
    a, b = F.col("a").cast("string"), F.col("b").cast("string")
    pair = F.concat(F.lit("c.["), a, base(1), F.lit(">T; "), b, base(3), F.lit(">"), last, F.lit("]"))
    nt = F.when(F.col("kind") == 0, F.col("p_name")).when(F.col("kind") == 1, F.concat(F.lit("c."), a, base(1), F.lit(">T"))).otherwise(pair)
    return rows.select("p_partkey", nt.alias("raw_hgvs_nt"), "target_sequence")


def _mapping(rows):
    asked = M.haplotype_worklist(rows)
    place = F.regexp_extract("component", r"^(\d+)", 1).cast("int")
    return asked.filter(place % 7 > 0).withColumn("mapped_c", F.concat(F.lit("NM_2.1:c."), "component"))


_SCORED_ROWS = "select *, 'urn:s:' || cast(row_id % 25 as string) || '#' || cast(row_id as string) as urn, cast(row_id % 1000 as string) as score from {variants}"


@query("K15_all_annotators", f"""select row_id, k.ac, k.variation_id, k.revel, c.ds_ag, c.ds_max, e.uuids, v.consequence, v.error, coalesce(m.cal, '') as calibration
  from ({ORACLE_SQL['K15_pipeline']}) k join ({ORACLE_SQL['C10_spliceai_exact']}) c using (row_id) join ({ORACLE_SQL['C13_annotate_evidence']}) e using (row_id) join ({ORACLE_SQL['C18_annotate_consequence']}) v using (row_id)
  left join ({_PICK} select * from main) m on m.score_set = 'urn:s:' || (row_id % 25)""")
def k15_all(t):
    """All annotators over one long layer: coordinates, frequency, clinical, missense, splice, evidence, consequence and calibration columns."""
    from ..operators import coordinates as C
    from .annotations import _FREQ, _RECODED, _SPLICE, _VEP, evidence_records

    c = t.clinvar
    summary = c.select("allele_id", "clinical_significance", "review_status", F.lit("").alias("last_review_date"))
    revel = t.sql("select chrom, cast(pos as bigint) as pos, ref, alt, cast(p_size as string) as score from {alleles}")
    keys = t.sql(_EKEYS)
    rows = t.sql(_SCORED_ROWS).select("row_id", "ids", F.col("g").alias("mapped_hgvs_g"), F.col("c").alias("mapped_hgvs_c"), F.lit("").alias("mapped_hgvs_p"), "urn", "score")
    steps = [
        *C.coordinate_steps(), A.frequency_step(t.sql(_FREQ).drop("caid")), A.clinvar_step(c.select("caid", "variation_id", "allele_id"), summary, "ids"), A.missense_step(revel=revel), A.spliceai_step(t.sql(_SPLICE)),
        A.evidence_step(evidence_records(t), "hgvs_col", "variation_col", "caid_col", ["panel", "uuid"]), A.consequence_step(t.sql(_VEP), t.sql(_RECODED), ["ids", "mapped_hgvs_g"], access_date=F.lit("2024-01-01")),
        A.calibration_step(_calibrations(t), t.sql(_RANGES), "urn", "score", "m", "http://x"),
    ]
    out = pipeline(rows.join(keys, "row_id"), steps, by_lists=True)
    names = {"gnomad.v4_1.allele_count": "ac", "clinvar.202601.variation_id": "variation_id", "revel.score": "revel", "spliceai.ds_ag": "ds_ag", "spliceai.max_delta_score": "ds_max", "clingen_evidence_repository.uuid": "uuids", "vep.consequence": "consequence", "vep.error": "error", "m.primary_calibration.urn": "calibration"}
    return out.select("row_id", *(F.col(f"`{k}`").alias(v) for k, v in names.items()))
