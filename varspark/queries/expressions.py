"""Queries of the column expressions (H), frequency preparation (D12-D14), streams (I) and chains (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import annotate as A
from ..operators import coordinates as C
from ..operators import frequency as Q
from ..operators import mapping as M
from ..operators.slots import explode_slots
from ..staging import scratch
from .base import accession, packed, query, slots
from .annotations import _FREQ, _TARGET

_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_COLS = _KEY.split(", ")
_P = "cast(l_partkey as string)"


def _lines(t, text: str):
    return t.sql(f"select {_KEY}, {text} as x from {{lineitem}}")


@query("H1_trim_key", "select c_custkey, c_mktsegment as value, c_custkey % 3 = 0 as blank from customer")
def h1(t):
    pad = F.concat(F.lit(" \t"), F.col("c_mktsegment"), F.lit("\n "))
    return t.customer.select("c_custkey", X.trim_key(pad).alias("value"), X.is_blank(F.when(F.col("c_custkey") % 3 == 0, " \t\n").otherwise(pad)).alias("blank"))


_PROTEIN = f"case l_linenumber % 5 when 0 then 'p.A' || {_P} || 'T' when 1 then 'NP_1.1:p.R' || {_P} || '=' when 2 then 'p.W' || {_P} || '*' when 3 then 'p.(K' || {_P} || 'fs*7)' else 'p.Ala' || {_P} || 'Thr' end"


@query("H2_normalize_protein", f"select {_KEY}, case l_linenumber % 5 when 0 then 'p.Ala' || l_partkey || 'Thr' when 1 then 'NP_1.1:p.Arg' || l_partkey || 'Arg' when 2 then 'p.Trp' || l_partkey || 'Ter' when 3 then 'p.Lys' || l_partkey || 'fs*7' else 'p.Ala' || l_partkey || 'Thr' end as value from lineitem")
def h2(t):
    return _lines(t, _PROTEIN).select(*_COLS, X.normalize_protein(F.col("x")).alias("value"))


_NT = f"case l_linenumber % 6 when 0 then 'NM_1.1:c.' || {_P} || 'A>G' when 1 then 'NC_1.1:g.' || {_P} || '_' || cast(l_partkey + 2 as string) || 'delinsTT' when 2 then 'c.' || {_P} || 'del' when 3 then 'g.' || {_P} || 'dupA' when 4 then 'c.' || {_P} || '+1_' || cast(l_partkey + 1 as string) || '-1insGG' else 'junk' end"


@query("H3_parse_nucleotide", f"""select {_KEY}, case when l_linenumber % 6 = 5 then null when l_linenumber % 6 = 4 then l_partkey || '+1' else l_partkey::varchar end as start,
  case l_linenumber % 6 when 1 then (l_partkey + 2)::varchar when 4 then (l_partkey + 1) || '-1' when 5 then null else l_partkey::varchar end as stop,
  case l_linenumber % 6 when 0 then 'A' when 3 then 'A' when 5 then null else '' end as ref, case l_linenumber % 6 when 0 then 'G' when 1 then 'TT' when 2 then '' when 3 then 'AA' when 4 then 'GG' end as alt from lineitem""")
def h3(t):
    return _lines(t, _NT).select(*_COLS, X.parse_nucleotide(F.col("x")).alias("v")).select(*_COLS, "v.*")


_REAL = slots("{variants}", s_g="g", s_c="c", s_chrom="chroms", s_pos="starts", s_ref="refs", s_alt="alts")


@query("H4_add_coordinates", f"""select row_id, {packed('s_chrom')} as mapped_hgvs_g_chromosome, {packed('s_pos')} as mapped_hgvs_g_start, {packed('s_ref')} as mapped_hgvs_g_ref, {packed('s_alt')} as mapped_hgvs_g_alt,
  {packed("case when s_c <> '' then split_part(s_c, ':', 1) else '' end")} as mapped_hgvs_c_transcript, 'false' as touches_intronic_region from {_REAL} group by row_id""")
def h4(t):
    df = t.variants.select("row_id", F.col("g").alias("mapped_hgvs_g"), F.col("c").alias("mapped_hgvs_c"), F.lit("").alias("mapped_hgvs_p"))
    out = C.add_coordinates(df, key=["row_id"])
    return out.select("row_id", *(f"mapped_hgvs_g_{c}" for c in ("chromosome", "start", "ref", "alt")), "mapped_hgvs_c_transcript", "touches_intronic_region")


_PRO = f"case l_linenumber % 5 when 0 then 'NP_1.1:p.Pro' || {_P} || 'Leu' when 1 then 'p.(Pro' || {_P} || '=)' when 2 then 'p.Pro' || {_P} || '_Leu' || cast(l_partkey + 4 as string) || 'del' when 3 then 'p.Pro' || {_P} || 'Ter' else 'x' end"


@query("H5_parse_protein", f"""select {_KEY}, case when l_linenumber % 5 < 4 then l_partkey::varchar end as start, case when l_linenumber % 5 = 2 then (l_partkey + 4)::varchar when l_linenumber % 5 < 4 then l_partkey::varchar end as stop,
  case when l_linenumber % 5 = 2 then 'P_L' when l_linenumber % 5 < 4 then 'P' end as ref, case l_linenumber % 5 when 0 then 'L' when 1 then 'P' when 2 then '' when 3 then '*' end as alt from lineitem""")
def h5(t):
    return _lines(t, _PRO).select(*_COLS, X.parse_protein(F.col("x")).alias("v")).select(*_COLS, "v.*")


_SEQ = "substr('ACGTTGCA', cast(1 + ({x} * 7 + 2) % 8 as int), 1)"


def _chunks(t):
    """Reference bases for five accessions, as many chunks as the customers of orders reach."""
    last = t.orders.agg(F.max("o_custkey")).first()[0] or 0
    return _sequences(t.sql("select distinct 'A' || cast(s_suppkey % 5 as string) as accession from {supplier}"), last // 100 + 5)


def genome(t, accessions: list[str]):
    """Reference bases for accessions, as many chunks as the parts reach."""
    names = F.explode(F.array(*map(F.lit, accessions))).alias("accession")
    return _sequences(t.region.filter("r_regionkey = 0").select(names), t.part.agg(F.max("p_partkey")).first()[0] // 100 + 5)


def _sequences(acc, most: int):
    acc = acc.select("accession", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most).cast("long"))).alias("chunk"))
    base = lambda x: F.substring(F.lit("ACGTTGCA"), (1 + (x * 7 + 2) % 8).cast("int"), F.lit(1))
    return acc.withColumn("seq", F.array_join(F.transform(F.sequence(F.col("chunk") * 100 + 1, F.col("chunk") * 100 + 100), base), ""))


_REF = f"(select string_agg({_SEQ}, '' order by x) from unnest(generate_series({{a}}, {{b}})) t(x))"


@query("H6_genomic_haplotype", f"""with r as (select o_orderkey as id, 'A' || (o_custkey % 5) as accession, 1 + o_custkey as start, 3 + o_custkey + o_orderkey % 3 as stop from orders)
select id, accession, start, stop, {_REF.format(x='x', a='start', b='stop')} as ref, 'A' || {_REF.format(x='x', a='start + 1', b='stop - 1')} || 'C' as alt from r""")
def h6(t):
    rows = t.sql("select o_orderkey as id, 'A' || cast(o_custkey % 5 as string) as accession, array(cast(3 + o_custkey + o_orderkey % 3 as string) || 'T>C', cast(1 + o_custkey as string) || 'G>A') as components from {orders}")
    return C.genomic_haplotype(rows, _chunks(t), 100)


@query("H7_chromosome_of", "select p_partkey, case when p_partkey % 30 between 1 and 22 then (p_partkey % 30)::varchar when p_partkey % 30 = 23 then 'X' when p_partkey % 30 = 24 then 'Y' else '' end as chrom from part")
def h7(t):
    acc = F.concat(F.lit("NC_"), F.lpad((F.col("p_partkey") % 30).cast("string"), 6, "0"), F.lit("."), (F.col("p_partkey") % 20).cast("string"))
    return t.part.select("p_partkey", X.chromosome_of(acc).alias("chrom"))


@query("H8_nc_to_chrom", "select p_partkey, (1 + p_partkey % 22)::varchar as chrom, null::varchar as old from part")
def h8(t):
    df = t.sql(f"select p_partkey, {accession('p_partkey')} as a from {{part}}")
    return df.select("p_partkey", X.nc_to_chrom(F.col("a")).alias("chrom"), X.nc_to_chrom(F.col("a"), "grch37").alias("old"))


@query("H9_intron_flags", f"select {_KEY}, l_linenumber % 3 < 2 as touches, l_linenumber % 3 = 0 as spans from lineitem")
def h9(t):
    df = t.lineitem
    p, q = F.col("l_partkey").cast("string"), (F.col("l_partkey") + 1).cast("string")
    k = F.col("l_linenumber") % 3
    start = F.when(k < 2, F.concat(p, F.lit("+1"))).otherwise(p)
    stop = F.when(k == 0, F.concat(q, F.lit("-5"))).when(k == 1, F.concat(p, F.lit("+9"))).otherwise(q)
    return df.select(*_COLS, X.touches_intron(start, stop).alias("touches"), X.spans_intron(start, stop).alias("spans"))


@query("H10_codes", "select p_partkey, case p_partkey % 4 when 0 then 'A' when 1 then '*' when 2 then 'U' else 'XYZ' end as one, case p_partkey % 4 when 0 then 'Ala' when 1 then 'Ter' when 2 then 'Sec' else 'xyz' end as three, reverse(translate('ACGT' || p_partkey, 'ACGT', 'TGCA')) as rc from part")
def h10(t):
    k = F.col("p_partkey") % 4
    three = F.when(k == 0, "ALA").when(k == 1, "ter").when(k == 2, "Sec").otherwise("xyz")
    one = F.when(k == 0, "A").when(k == 1, "*").when(k == 2, "u").otherwise("xyz")
    return t.part.select("p_partkey", X.aa3to1(three).alias("one"), X.aa1to3(one).alias("three"), X.reverse_complement(F.concat(F.lit("ACGT"), F.col("p_partkey").cast("string"))).alias("rc"))


_DELETIONS = "select o_orderkey, 'A' || cast(o_custkey % 5 as string) as accession, 1 + o_custkey as start, 1 + o_custkey + o_orderkey % 3 as stop, case when o_orderkey % 4 = 0 then 'G' else '' end as alt, case when o_orderkey % 2 = 0 then 'T' else '' end as ref, case when o_orderkey % 4 = 0 then 'sub' else 'del' end as kind from {orders}"


@query("H11_vcf_anchor", f"""select o_orderkey, accession, stop, case when alt = '' and start > 1 then start - 1 else start end as start, case when alt = '' and start > 1 then {_REF.format(x='x', a='start - 1', b='stop')} else ref end as ref,
  case when alt = '' and start > 1 then {_REF.format(x='x', a='start - 1', b='start - 1')} else alt end as alt from ({_DELETIONS})""")
def h11(t):
    return C.vcf_anchor(t.sql(_DELETIONS).drop("kind"), _chunks(t), 100)


@query("H12_fill_missing_ref", f"select o_orderkey, case when ref = '' and kind = 'del' then {_REF.format(x='x', a='start', b='stop')} else ref end as ref from ({_DELETIONS})")
def h12(t):
    return C.fill_missing_ref(t.sql(_DELETIONS), _chunks(t), 100).select("o_orderkey", "ref")


@query("H14_snv_of", f"select row_id, slot - 1 as slot, case when s_g <> '' then s_chrom end as chrom, case when s_g <> '' then s_pos::bigint end as pos, case when s_g <> '' then s_ref end as ref, case when s_g <> '' then s_alt end as alt from {_REAL}")
def h14(t):
    long = explode_slots(t.variants.withColumn("_row_id", F.col("row_id")), g="g")
    return long.select(F.col("_row_id").alias("row_id"), F.col("_slot").cast("long").alias("slot"), X.snv_of(F.col("g")).alias("v")).select("row_id", "slot", "v.*")


@query("H15_normalize_caid", "select p_partkey, case when p_partkey % 2 = 0 then 'CA' || p_partkey else 'x-' || p_partkey end as caid from part")
def h15(t):
    p = F.col("p_partkey").cast("string")
    return t.part.select("p_partkey", X.normalize_caid(F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("CA00"), p)).otherwise(F.concat(F.lit("x-"), p))).alias("caid"))


@query("H16_allele_key", "select k, shift, 'chr' || chrom || ':' || pos || ':' || ref || ':' || alt as key from {alleles}")
def h16(t):
    return t.alleles.select("k", "shift", X.allele_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")).alias("key"))


@query("H17_stars", "select caid, case when review_status = 'practice guideline' then '4' when review_status = 'Reviewed by expert panel' then '3' when review_status like 'criteria%' then '1' when review_status like 'no assertion%' then '0' else '' end as stars from {clinvar}")
def h17(t):
    return t.clinvar.select("caid", X.stars(F.col("review_status")).alias("stars"))


@query("H18_dash_to_blank", "select p_partkey, case when p_size % 2 = 0 then '' else p_brand end as v from part")
def h18(t):
    return t.part.select("p_partkey", X.dash_to_blank(F.when(F.col("p_size") % 2 == 0, " - ").otherwise(F.col("p_brand"))).alias("v"))


@query("H19_strip_gene_symbol", f"select {_KEY}, 'NM_' || l_partkey || '.1:c.1A>G' as v from lineitem")
def h19(t):
    return _lines(t, f"'NM_' || {_P} || '.1' || case when l_linenumber % 2 = 0 then '(GENE)' else '' end || ':c.1A>G'").select(*_COLS, X.strip_gene_symbol(F.col("x")).alias("v"))


@query("H20_hgvs_expressions", f"select {_KEY}, case when l_linenumber % 2 = 0 then 'a:' || l_partkey || '+b:1' else 'b:1' end as v from lineitem")
def h20(t):
    return _lines(t, f"case when l_linenumber % 2 = 0 then 'a:' else 'a' end || {_P} || ', b:1,, c'").select(*_COLS, F.array_join(X.hgvs_expressions(F.col("x")), "+").alias("v"))


@query("H21_haplotype_components", f"select {_KEY}, case l_linenumber % 3 when 0 then l_partkey || 'A>G,' || (l_partkey + 1) || 'C>T' end as v from lineitem")
def h21(t):
    text = f"case l_linenumber % 3 when 0 then 'NM_1.1:c.[' || {_P} || 'a>g; ' || cast(l_partkey + 1 as string) || 'C>T]' when 1 then 'c.[' || {_P} || 'A>G]' else 'c.[' || {_P} || '+1A>G;5C>T]' end"
    return _lines(t, text).select(*_COLS, F.array_join(X.haplotype_components(F.col("x")), ",").alias("v"))


@query("H22_compose_delins", f"""with x as (select {_KEY}, 1 + l_partkey % 40 as a, 3 + l_partkey % 40 as b from lineitem)
select {_KEY}, case when (a - 1) // 3 = (b - 1) // 3 then 'c.' || a || '_' || b || 'delinsA' || substr('{_TARGET}', a + 1, 1) || 'C' end as composed from x""")
def h22(t):
    a, b = (1 + F.col("l_partkey") % 40).cast("string"), (3 + F.col("l_partkey") % 40).cast("string")
    df = t.lineitem.select(*_COLS, F.array(F.concat(b, F.lit("G>C")), F.concat(a, F.lit("T>A"))).alias("parts"), F.lit(_TARGET).alias("target"))
    return M.compose_delins(df, "parts", "target").select(*_COLS, "composed")


@query("H23_registry_id", "select p_partkey, case p_partkey % 3 when 0 then 'CA' || p_partkey when 1 then null else 'PA' || p_partkey end as id, case p_partkey % 3 when 0 then 'CA' when 2 then 'PA' else 'unknown' end as type from part")
def h23(t):
    p, k = F.col("p_partkey").cast("string"), F.col("p_partkey") % 3
    at = F.when(k == 0, F.concat(F.lit("http://x/allele/CA"), p)).when(k == 1, F.concat(F.lit("_:PA"), p))
    i = X.registry_id(at, F.when(k == 2, F.concat(F.lit("PA"), p)))
    return t.part.select("p_partkey", i.alias("id"), F.coalesce(X.allele_type(i), F.lit("unknown")).alias("type"))


@query("H26_registry_records", """select 'CA' || p_partkey as id, (p_partkey * 2)::varchar as clinvar_allele, null::varchar as clinvar_variation, 'chr' || (1 + p_partkey % 22) as chrom, p_partkey + 10 as pos, 'A' as ref, 'G' as alt, 'NC_1.1:g.' || p_partkey as g,
  case when p_size % 2 = 0 then 'NM_1.1:c.' || p_partkey || 'A>G' else 'NM_2.2:c.5A>G' end as c, case when p_size % 2 = 0 then 'NP_1.1:p.X' else 'NP_2.2:p.Y' end as p from part""")
def h26(t):
    from ..sources.io import REGISTRY, registry_records

    return registry_records(t.part.select(F.from_json(registry_json(), REGISTRY).alias("r")).select("r.*"), "NM_1.1")


def registry_json():
    """A registry document of each part."""
    p = F.col("p_partkey").cast("string")
    even = F.col("p_size") % 2 == 0
    return F.concat(
        F.lit('{"@id":"http://x/CA'), p, F.lit('","externalRecords":{"ClinVarAlleles":[{"alleleId":"'), (F.col("p_partkey") * 2).cast("string"), F.lit('"}]},"genomicAlleles":[{"referenceGenome":"GRCh37","chromosome":"9","coordinates":[{"end":1,"referenceAllele":"T","allele":"C"}],"hgvs":["NC_0.0:g.0"]},{"referenceGenome":"GRCh38","chromosome":"'),
        (1 + F.col("p_partkey") % 22).cast("string"), F.lit('","coordinates":[{"start":1,"end":'), (F.col("p_partkey") + 10).cast("string"), F.lit(',"referenceAllele":"A","allele":"G"}],"hgvs":["CM1:g.1","NC_1.1:g.'), p,
        F.lit('"]}],"transcriptAlleles":[{"hgvs":["'), F.when(even, "NM_1.1").otherwise("NM_3.3"), F.lit(":c."), p, F.lit('A>G"],"proteinEffect":{"hgvs":"NP_1.1:p.X"}},{"hgvs":["NM_2.2:c.5A>G"],"MANE":{"nucleotide":{"RefSeq":{"hgvs":"NM_2.2:c.5A>G"}},"protein":{"RefSeq":{"hgvs":"NP_2.2:p.Y"}}}}]}'),
    )


@query("H27_accession_of", "select l_suppkey, tx, split_part(tx, ':', 1) as accession, tx like 'NM%' or tx like 'ENST%' as transcript, tx like 'NP%' as protein from (select distinct l_suppkey, case l_partkey % 3 when 0 then 'NM_' when 1 then 'NP_' else 'ENST' end || l_suppkey || ':x' as tx from lineitem)")
def h27(t):
    df = t.sql("select distinct l_suppkey, case l_partkey % 3 when 0 then 'NM_' when 1 then 'NP_' else 'ENST' end || cast(l_suppkey as string) || ':x' as tx from {lineitem}")
    a = X.accession_of(F.col("tx"))
    return df.select("l_suppkey", "tx", a.alias("accession"), X.is_transcript(a).alias("transcript"), X.is_protein(a).alias("protein"))


@query("H28_score_set_of", "select p_partkey, case when p_size % 3 > 0 then 'urn:a#b' || p_partkey end as s from part")
def h28(t):
    return t.part.select("p_partkey", X.score_set_of(F.concat(F.lit("urn:a"), F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("#b"), F.col("p_partkey").cast("string"), F.lit("#5"))).otherwise(""))).alias("s"))


@query("H29_fmt4", "select p_partkey, p_size, printf('%.4f', p_size / 100.0::double) as v from part")
def h29(t):
    return t.part.select("p_partkey", "p_size", X.fmt4(F.col("p_size") / 100.0).alias("v"))


@query("H30_spliceai_info", "select p_partkey, case when p_size % 3 = 0 then p_size / 100.0::double end as ds_ag from part")
def h30(t):
    info = F.concat(F.lit("SpliceAI="), F.when(F.col("p_size") % 3 == 0, "T").otherwise("C"), F.lit("|G|"), (F.col("p_size") / 100.0).cast("string"), F.lit("|0|0|0|1|2|3|4,G|G|0.99|0|0|0|1|2|3|4"))
    return t.part.select("p_partkey", X.spliceai_info(info, F.lit("T"))["ds_ag"].alias("ds_ag"))


def _sites(t):
    return t.sql("""select p_partkey as k, named_struct('freq', named_struct('all', named_struct('ac', p_size, 'an', 100)), 'fafmax', named_struct('faf95_max', p_size / 1000.0D, 'faf95_max_gen_anc', p_brand)) as joint,
      named_struct('filters', case when p_size % 2 = 0 then array() when p_size % 5 = 0 then null else array('RF') end) as exome, named_struct('filters', case when p_size % 3 = 0 then array() else array('AC0') end) as genome,
      named_struct('transcript_consequences', array(named_struct('gene_symbol', p_type), named_struct('gene_symbol', 'G' || cast(p_size as string)))) as vep from {part}""")


@query("D12_pass_filter", "select p_partkey as k from part where p_size % 2 = 0 or p_size % 3 = 0")
def d12(t):
    return Q.pass_filter(_sites(t)).select("k")


@query("D13_gene_filter", "select p_partkey as k from part where p_size in (3, 7, 20)")
def d13(t):
    return Q.gene_filter(_sites(t), ["G3", "G7", "G20"]).select("k")


@query("D14_project_frequency", "select p_partkey as k, p_size::bigint as allele_count, 100::bigint as allele_number, p_size / 1000.0::double as faf95_max, p_brand as faf95_max_ancestry from part")
def d14(t):
    return Q.project_frequency(_sites(t), ["k"])


@query("K7_prepare_frequency", "select p_partkey as k, p_size::bigint as allele_count from part where p_size in (3, 7, 20) and (p_size % 2 = 0 or p_size % 3 = 0)")
def k7(t):
    return Q.prepare_frequency(_sites(t), ["k"], ["G3", "G7", "G20"]).select("k", "allele_count")


# deletions, duplications, inversions, haplotypes and substitutions of one accession
_REFSEQ = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, 10 + l_partkey as p, l_linenumber % 6 as kind from {lineitem}"
_B = [_SEQ.format(x=f"(p + {i})") for i in (-1, 0, 1, 2)]
_INV = f"reverse(translate({_B[1]} || {_B[2]}, 'ACGT', 'TGCA'))"


@query("K5_coordinates_refseq", f"""with x as ({_REFSEQ}) select {_KEY}, '1' as chromosome, case when kind = 0 then p - 1 when kind = 1 then p - 1 else p end::varchar as start, case when kind in (0, 2, 4) then p + 1 when kind = 3 then p + 2 else p end::varchar as stop,
  case kind when 0 then {_B[0]} || {_B[1]} || {_B[2]} when 1 then {_B[0]} || 'T' when 2 then {_B[1]} || {_B[2]} when 3 then 'T' || {_B[2]} || 'G' when 4 then {_B[1]} || {_B[2]} else 'A' end as ref,
  case kind when 0 then {_B[0]} when 1 then {_B[0]} when 2 then {_INV} when 3 then 'A' || {_B[2]} || 'C' when 4 then 'dup' else 'G' end as alt from x""")
def k5(t):
    p = lambda i=0: f"cast(p + {i} as string)"
    rows = t.sql(f"""select *, 'NC_000001.11:g.' || case kind when 0 then {p()} || '_' || {p(1)} || 'del' when 1 then {p()} || 'delT' when 2 then {p()} || '_' || {p(1)} || 'inv'
      when 3 then '[' || {p()} || 'T>A;' || {p(2)} || 'G>C]' when 4 then {p()} || '_' || {p(1)} || 'dup' else {p()} || 'A>G' end as mapped_hgvs_g, '' as mapped_hgvs_c, '' as mapped_hgvs_p from ({_REFSEQ})""")
    out = C.add_coordinates(rows, chunks=genome(t, ["NC_000001.11"]), size=100, by_lists=True)
    return out.select(*_COLS, *(F.col(f"mapped_hgvs_g_{c}").alias(c) for c in ("chromosome", "start", "stop", "ref", "alt")))


_LEVELS = """select o_orderkey, case o_orderkey % 4 when 0 then 'NM_' || cast(o_custkey as string) || '.1:p.A1G' when 2 then 'NP_' || cast(o_custkey % 7 as string) || '.1:p.A1G' else '' end as mapped_hgvs_p,
  case when o_orderkey % 2 = 0 then '' else 'NM_5.1:c.7+1G>T|' end as mapped_hgvs_c, '' as mapped_hgvs_g, case when o_orderkey % 3 = 0 then 'old' else '' end as reverse_translation_error from {orders}"""
_CAND = "select l_suppkey, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as o, l_partkey from {lineitem} where l_quantity > 30"


@query("K3_reverse_translate", f"""with l as (select l_suppkey as k, count(*) as n, string_agg('NM_' || l_suppkey || '.1:c.' || l_partkey || 'A>G', '|' order by o, l_partkey) as c, string_agg('NC_000002.12:g.' || l_partkey || 'del', '|' order by o, l_partkey) as g,
    string_agg(l_partkey::varchar, '|' order by o, l_partkey) as places, string_agg('false', '|' order by o, l_partkey) as no, string_agg('2', '|' order by o, l_partkey) as chrom, string_agg('NM_' || l_suppkey || '.1', '|' order by o, l_partkey) as tx, repeat('|', count(*)::int - 1) as bars from ({_CAND}) group by 1),
x as (select *, case when k4 = 0 then k2 when k4 = 2 and k2 % 7 in (1, 2) then k2 % 7 end as s from (select *, o_orderkey % 4 as k4, (select any_value(o_custkey) from orders o where o.o_orderkey = z.o_orderkey) as k2 from ({_LEVELS}) z))
select o_orderkey, mapped_hgvs_p, case when k4 in (0, 2) then 'protein' else 'dna' end as assayed_variant_level, case when k4 in (0, 2) then coalesce(c, '') else mapped_hgvs_c end as mapped_hgvs_c, coalesce(g, '') as mapped_hgvs_g,
  coalesce(chrom, '') as mapped_hgvs_g_chromosome, coalesce(places, '') as mapped_hgvs_g_start, coalesce(bars, '') as mapped_hgvs_g_alt, case when k4 in (0, 2) then coalesce(tx, '') else 'NM_5.1|' end as mapped_hgvs_c_transcript,
  case when k4 in (0, 2) then coalesce(places, '') else '7+1|' end as mapped_hgvs_c_start, case when k4 in (0, 2) then coalesce(no, '') else 'true|' end as touches_intronic_region, case when k4 in (0, 2) then coalesce(no, '') else 'false|' end as spans_intron,
  concat_ws('; ', nullif(reverse_translation_error, ''), case when k4 in (0, 2) and s is null then 'Unable to resolve transcript accession for protein reverse translation' when k4 in (0, 2) and k2 % 5 = 0 and k4 = 0 then 'slow' when k4 in (0, 2) and c is null then 'Reverse translation returned no candidate DNA variants' end) as error, '' as warnings
from x left join l on k = s""")
def k3(t):
    from ..operators.reverse import reverse_translate

    # of a protein, the best transcript is the first by class; both candidates of a row share its p. string
    assoc = t.sql("select 'NP_' || cast(r_regionkey as string) || '.1' as pro_ac, 'NM_' || cast(r_regionkey as string) || '.1' as tx_ac from {region} where r_regionkey in (1, 2) union all select 'NP_1.1', 'ENST9.1' from {region}")
    tx, hgvs = "'NM_' || cast(l_suppkey as string) || '.1'", "cast(l_partkey as string)"
    one = f"select {tx} as transcript, 'NM_' || cast(l_suppkey as string) || '.1:p.A1G' as hgvs_p, struct(o, l_partkey) as ordinal, {tx} || ':c.' || {hgvs} || 'A>G' as hgvs_c, 'NC_000002.12:g.' || {hgvs} || 'del' as hgvs_g, l_suppkey from ({_CAND})"
    cand = t.sql(one)
    by_protein = cand.filter("l_suppkey in (1, 2)").withColumn("hgvs_p", F.concat(F.lit("NP_"), F.col("l_suppkey").cast("string"), F.lit(".1:p.A1G")))
    errs = t.sql("select distinct 'NM_' || cast(o_custkey as string) || '.1' as transcript, 'NM_' || cast(o_custkey as string) || '.1:p.A1G' as hgvs_p, 'slow' as error from {orders} where o_custkey % 5 = 0")
    out = reverse_translate(t.sql(_LEVELS), assoc, cand.unionByName(by_protein).drop("l_suppkey"), errs, by_lists=True)
    names = ["mapped_hgvs_p", "assayed_variant_level", "mapped_hgvs_c", "mapped_hgvs_g", *(f"mapped_hgvs_g_{c}" for c in ("chromosome", "start", "alt")), "mapped_hgvs_c_transcript", "mapped_hgvs_c_start", "touches_intronic_region", "spans_intron"]
    return out.select("o_orderkey", *names, F.col("reverse_translation_error").alias("error"), F.col("reverse_translation_warnings").alias("warnings"))


@query("K15_pipeline", f"""select row_id, {packed('cast(allele_count as varchar)')} as ac, {packed('variation_id')} as variation_id, {packed("case when f.p_size is not null then printf('%.4f', f.p_size::double) end")} as revel
  from {slots('{variants}', s='ids', s_chrom='chroms', s_pos='starts', s_ref='refs', s_alt='alts')} v left join {{clinvar}} c on c.caid = s
  left join (select a.*, case when k % 6 = 0 then null else p_size end as allele_count from {{alleles}} a) f on f.chrom = s_chrom and cast(f.pos as varchar) = s_pos and f.ref = s_ref and f.alt = s_alt group by 1""")
def k15(t):
    """Coordinates of candidate lists, then frequency, clinical and missense columns, over one long layer."""
    from ..plans.pipeline import pipeline

    c = t.clinvar
    bridge = c.select("caid", "variation_id", "allele_id")
    summary = c.select("allele_id", "clinical_significance", "review_status", F.lit("").alias("last_review_date"))
    revel = t.sql("select chrom, cast(pos as bigint) as pos, ref, alt, cast(p_size as string) as score from {alleles}")
    freq = t.sql(_FREQ).drop("caid")
    start = t.variants.select("row_id", "ids", F.col("g").alias("mapped_hgvs_g"), F.col("c").alias("mapped_hgvs_c"), F.lit("").alias("mapped_hgvs_p"))
    out = pipeline(start, [*C.coordinate_steps(), A.frequency_step(freq), A.clinvar_step(bridge, summary, "ids"), A.missense_step(revel=revel)], key=["row_id"])
    return out.select("row_id", F.col("`gnomad.v4_1.allele_count`").alias("ac"), F.col("`clinvar.202601.variation_id`").alias("variation_id"), F.col("`revel.score`").alias("revel"))


@query("I1_annotate_stream", "select event_id, coalesce(p_brand, '') as brand from events left join part on p_partkey = user_id")
def i1(t):
    from ..streaming.files import annotate_stream

    sink = scratch(t.spark, "stream")
    part = t.part.select(F.col("p_partkey").alias("user_id"), "p_brand")
    stages = [lambda d: d.join(part, "user_id", "left").select("event_id", F.coalesce("p_brand", F.lit("")).alias("brand"))]
    source = scratch(t.spark, "incoming")
    t.events.select("event_id", "user_id").write.parquet(source)
    annotate_stream(t.spark, source, "event_id long, user_id long", sink, stages, scratch(t.spark, "state")).awaitTermination()
    return t.spark.read.schema("event_id long, brand string").parquet(f"{sink}/*")


@query("I2_worklist_stream", "select distinct user_id::varchar as key from events where user_id not in (select p_partkey from part where p_size > 10)")
def i2(t):
    from ..streaming.files import worklist_stream

    sink, source = scratch(t.spark, "worklist"), scratch(t.spark, "incoming")
    cache = lambda: t.part.filter("p_size > 10").select(F.col("p_partkey").cast("string").alias("key"), F.lit(True).alias("found"), F.lit("2024-06-01").alias("fetched_at"))
    t.events.select(F.col("user_id").cast("string").alias("key")).repartition(4).write.parquet(source)
    worklist_stream(t.spark, source, "key string", cache, F.lit("2024-06-30"), sink, scratch(t.spark, "state"), max_files=1).awaitTermination()
    return t.spark.read.schema("key string").parquet(f"{sink}/*")
