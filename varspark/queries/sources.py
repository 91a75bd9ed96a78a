"""Queries of the readers and sinks (A, F2): tables are written as the files that a reader expects, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.slots import ROW
from ..sources import io
from ..staging import scratch
from .base import query
from .expressions import registry_json

_TEXTS = "select cast(o_orderkey as string) as id, case o_orderkey % 4 when 0 then 'say \"' || o_orderpriority || '\"' when 1 then o_orderpriority || ', tab' when 2 then '' end as note from {orders}"
_SAME = "select o_orderkey::varchar as id, case o_orderkey % 4 when 0 then 'say \"' || o_orderpriority || '\"' when 1 then o_orderpriority || ', tab' else '' end as note from orders"


def _tsv(t, df: DataFrame, name: str) -> str:
    path = scratch(t.spark, name)
    df.write.csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="")
    return path


def _lines(t, df: DataFrame, name: str) -> str:
    path = scratch(t.spark, name)
    df.write.text(path)
    return path


@query("A1_read_table", _SAME)
def a1(t):
    return io.read_table(t.spark, _tsv(t, t.sql(_TEXTS), "table"), "\t")


@query("A2_write_table", _SAME)
def a2(t):
    path = scratch(t.spark, "written")
    io.write_table(t.sql(_TEXTS), path, ",")
    return io.read_table(t.spark, path, ",")


@query("F2_sink", "select mode, o_orderkey::varchar as id from orders, (select unnest(['no', 'index', 'groups']) as mode)")
def f2(t):
    """The three modes hold the same rows; their order is tested on files."""
    rows, out = t.sql(_TEXTS).withColumn(ROW, F.col("id").cast("long")), None
    for mode in ("no", "index", "groups"):
        path = scratch(t.spark, mode)
        io.write_table(rows, path, ",", preserve_order=mode)
        one = io.read_table(t.spark, path, ",").select(F.lit(mode).alias("mode"), "id")
        out = one if out is None else out.unionByName(one)
    return out


@query("A6_read_spliceai_vcf", "select p_partkey % 2 as file_rank, case when p_size > 25 then 'chr' else '' end || (1 + p_partkey % 22) as chrom, p_partkey as pos, 'A' as ref, 'G' as alt, 'SpliceAI=G|X|0.' || p_size as info from part")
def a6(t):
    line = "concat_ws('\t', case when p_size > 25 then 'chr' else '' end || cast(1 + p_partkey % 22 as string), cast(p_partkey as string), '.', 'A', 'G', '.', '.', 'SpliceAI=G|X|0.' || cast(p_size as string))"
    rows = t.sql(f"select p_partkey % 2 as f, {line} as value from {{part}} union all select 0, '##about' from {{region}} union all select 1, '#CHROM\tPOS' from {{region}}")
    paths = [_lines(t, rows.filter(F.col("f") == i).select("value"), "vcf") for i in (0, 1)]
    return io.read_spliceai_vcf(t.spark, paths).select(F.col("file_rank").cast("long").alias("file_rank"), "chrom", "pos", "ref", "alt", "info")


@query("A7_read_revel", "select (1 + p_partkey % 22)::varchar as chrom, p_partkey as pos, 'A' as ref, 'C' as alt, p_size::varchar as score from part")
def a7(t):
    rows = t.sql("select concat_ws('\t', cast(1 + p_partkey % 22 as string), cast(p_partkey as string), 'A', 'C', cast(p_size as string)) as value from {part}")
    return io.read_revel(t.spark, _lines(t, rows, "revel"))


@query("A8_read_alphamissense", "select 'chr' || (1 + p_partkey % 22) as chrom, p_partkey as pos, p_size::varchar as score, p_brand as class from part")
def a8(t):
    line = "concat_ws('\t', 'chr' || cast(1 + p_partkey % 22 as string), cast(p_partkey as string), 'A', 'G', 'hg38', 'P', 'T', 'V', cast(p_size as string), p_brand)"
    rows = t.sql(f"select {line} as value from {{part}} union all select '# about' from {{region}}")
    return io.read_alphamissense(t.spark, _lines(t, rows, "missense")).select("chrom", "pos", "score", "class")


@query("A9_read_dbnsfp", "select (1 + p_partkey % 22)::varchar as chrom, p_partkey as pos, 'A' as ref, 'G' as alt, p_size || ';.' as mutpred2_score from part")
def a9(t):
    rows = t.sql("select cast(1 + p_partkey % 22 as string) as `#chr`, p_partkey as `pos(1-based)`, 'A' as ref, 'G' as alt, p_brand as other, cast(p_size as string) || ';.' as MutPred2_score from {part}")
    return io.read_dbnsfp(t.spark, _tsv(t, rows, "dbnsfp"))


@query("A10_read_evidence", "select 'U' || p_partkey as Uuid, p_brand as Panel, case when p_size % 2 = 0 then p_type else '' end as Note from part")
def a10(t):
    rows = t.sql("select ' U' || cast(p_partkey as string) as Uuid, p_brand || ' ' as Panel, case when p_size % 2 = 0 then p_type end as Note from {part}")
    out = io.read_evidence(t.spark, _tsv(t, rows, "evidence"))
    return out.select("Uuid", "Panel", "Note")


_REGISTRY = "select 'CA' || p_partkey as id, (p_partkey * 2)::varchar as clinvar_allele, 'chr' || (1 + p_partkey % 22) as chrom, p_partkey + 10 as pos from part"


@query("A11_read_registry", _REGISTRY)
def a11(t):
    path = _lines(t, t.part.select(registry_json().alias("value")), "registry")
    return io.read_registry(t.spark, path, "NM_1.1").select("id", "clinvar_allele", "chrom", "pos")


@query("H24_registry_clinvar_ids", "select 'CA' || p_partkey as id, (p_partkey * 2)::varchar as clinvar_allele, null::varchar as clinvar_variation from part")
def h24(t):
    return _records(t).select("id", "clinvar_allele", "clinvar_variation")


@query("H25_registry_coords", "select 'CA' || p_partkey as id, 'chr' || (1 + p_partkey % 22) as chrom, p_partkey + 10 as pos, 'A' as ref, 'G' as alt from part")
def h25(t):
    return _records(t).select("id", "chrom", "pos", "ref", "alt")


def _records(t) -> DataFrame:
    return io.registry_records(t.part.select(F.from_json(registry_json(), io.REGISTRY).alias("r")).select("r.*"), "NM_1.1")


_FREQUENCIES = "select cast(1 + p_partkey % 22 as string) as chrom, p_partkey as pos, 'A' as ref, 'G' as alt, p_size as allele_count from {part}"


@query("A12_read_frequency_table", "select 'CA' || p_partkey as caid, p_size as allele_count from part")
def a12(t):
    path = scratch(t.spark, "frequency")
    t.sql("select 'CA' || cast(p_partkey as string) as CAID, p_size as allele_count from {part}").write.parquet(path)
    return io.read_frequency_table(t.spark, path)


@query("A12_frequency_table_by_allele", "select (1 + p_partkey % 22)::varchar as chrom, p_partkey as pos, 'A' as ref, 'G' as alt, p_size as allele_count from part")
def a12_alleles(t):
    path = scratch(t.spark, "frequency")
    t.sql("select named_struct('contig', 'chr' || cast(1 + p_partkey % 22 as string), 'position', p_partkey) as locus, array('A', 'G') as alleles, p_size as allele_count from {part}").write.parquet(path)
    return io.read_frequency_table(t.spark, path)


@query("A15_write_frequency_cache", "select (1 + p_partkey % 22)::varchar as chrom, p_partkey as pos, 'A' as ref, 'G' as alt, p_size as allele_count from part")
def a15(t):
    path = scratch(t.spark, "cache")
    io.write_frequency_cache(t.sql(_FREQUENCIES), path)
    return io.read_frequency_cache(t.spark, path)


@query("A13_read_calibrations", """select 's' || n_nationkey as score_set, r_regionkey as ordinal, 'u' || n_nationkey || '-' || r_regionkey as calibration, n_name as title, r_regionkey = 1 as "primary", n_nationkey % 2 = 0 as investigator,
  'L' || r_regionkey as label, case when r_regionkey > 0 then r_regionkey / 2.0::double end as low, r_regionkey > 0 as ranged, case when r_regionkey = 0 then n_nationkey end as class_id
  from nation, region""")
def a13(t):
    base = t.sql("select n_nationkey as n, n_name, r_regionkey as r from {nation} cross join {region}")
    low = F.when(F.col("r") > 0, F.array(F.col("r") / 2.0, F.lit(None).cast("double")))
    urn = F.concat(F.lit("u"), F.col("n").cast("string"), F.lit("-"), F.col("r").cast("string"))
    one = F.struct(urn.alias("urn"), F.col("n_name").alias("title"), (F.col("r") == 1).alias("primary"), (F.col("n") % 2 == 0).alias("investigatorProvided"), F.array(F.struct(F.lit(1).alias("id"), F.concat(F.lit("L"), F.col("r").cast("string")).alias("label"), low.alias("range"))).alias("functionalClassifications"))
    sets = base.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("r", one.alias("c")))).alias("l"))
    doc = sets.select(F.to_json(F.struct(F.concat(F.lit("s"), F.col("n").cast("string")).alias("score_set"), F.col("l.c").alias("calibrations"))).alias("value"))
    cals, ranges = io.read_calibrations(t.spark, _lines(t, doc, "calibrations"))
    entry = lambda i, v: F.struct(i.cast("int").alias("functionalClassificationId"), F.array(F.struct(v.alias("urn"))).alias("variants"))
    given = base.filter("r = 0").select(F.to_json(F.struct(urn.alias("calibration"), F.array(entry(F.lit(99), F.lit("v")), entry(F.lit(None), F.lit("v")), entry(F.col("n"), F.lit("v"))).alias("classes"))).alias("value"))
    ids = io.read_assignments(t.spark, _lines(t, given, "assignments")).select("calibration", F.col("class_id").cast("long").alias("class_id"))
    out = cals.join(ranges.select("calibration", "label", "low", "ranged"), "calibration").join(ids, "calibration", "left")
    return out.select("score_set", F.col("ordinal").cast("long").alias("ordinal"), "calibration", "title", "primary", "investigator", "label", "low", "ranged", "class_id")
