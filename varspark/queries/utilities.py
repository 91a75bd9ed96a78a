"""Queries of the table utilities, order, slots and ranks (A, B, D, E, F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import expr as X
from ..operators import mapping as M
from ..operators import rank as R
from ..operators import slots as S
from ..operators import tables as T
from .base import packed, query, slots

_ORDERED = "select *, row_number() over (order by o_orderkey) - 1 as rid from orders"
# columns with blanks, tabs and nulls
_MESSY = """select c_custkey, case c_custkey % 4 when 0 then ' ' when 1 then null when 2 then c_mktsegment else '  ' || c_mktsegment || ' ' end as a,
  case c_custkey % 3 when 0 then '' when 1 then c_mktsegment else lower(c_mktsegment) end as b, c_name from {customer}"""
_M = f"({_MESSY})"
_BLANK = "trim(coalesce({}, '')) = ''"


@query("A3_slice_rows", f"select o_orderkey, rid::bigint as rid from ({_ORDERED}) where rid >= 100 and rid < 5100")
def a3(t):
    return T.slice_rows(T.with_row_id(t.orders.select("o_orderkey"), ["o_orderkey"]), 100, 5000).select("o_orderkey", F.col("_row_id").alias("rid"))


@query("A4_with_row_id", f"select o_orderkey, o_totalprice, rid::bigint as rid from ({_ORDERED})")
def a4(t):
    return T.with_row_id(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"]).withColumnRenamed("_row_id", "rid")


@query("A5_clinvar_summary", """select allele_id, arg_max(sig, l_key) as sig from (
  select cast(l_partkey as varchar) as allele_id, case when l_linenumber % 3 = 0 then '' else l_returnflag end as sig, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as l_key, l_linestatus from lineitem) where l_linestatus = 'O' group by allele_id""")
def a5(t):
    from ..sources.io import clinvar_rules

    raw = t.sql("""select cast(l_partkey as string) as AlleleID, case when l_linenumber % 3 = 0 then '-' else l_returnflag end as ClinicalSignificance, '' as ReviewStatus, '' as LastEvaluated,
      case when l_linestatus = 'O' then 'GRCh38' else 'GRCh37' end as Assembly, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as line from {lineitem}""")
    return clinvar_rules(raw, "line").select("allele_id", F.col("clinical_significance").alias("sig"))


@query("A7_prepare_revel", """select chrom, pos, ref, alt, score from (select cast(1 + p_partkey % 22 as varchar) as chrom, cast(1000 + p_partkey as bigint) as pos, substr('ACGT', cast(1 + p_partkey % 4 as int), 1) as ref,
  substr('ACGT', cast(1 + (p_partkey + 1) % 4 as int), 1) as alt, cast(p_size as varchar) as score, p_partkey % 7 = 0 as off from part) where not off""")
def a7(t):
    from ..sources.io import prepare_revel

    rows = t.sql("""select cast(1 + p_partkey % 22 as string) as chr, 'x' as hg19_pos, case when p_partkey % 7 = 0 then '.' else cast(1000 + p_partkey as string) end as grch38_pos,
      substr('ACGT', cast(1 + p_partkey % 4 as int), 1) as ref, substr('ACGT', cast(1 + (p_partkey + 1) % 4 as int), 1) as alt, 'A' as aaref, 'B' as aaalt, cast(p_size as string) as REVEL, 'e' as id from {part}""")
    return prepare_revel(rows)


@query("A14_read_targets", "select n_name, cast(arg_max(c_custkey, c_custkey) as varchar) as sequence from customer join nation on c_nationkey = n_nationkey group by n_name")
def a14(t):
    rows = t.sql("select ' ' || n_name as n_name, cast(c_custkey as string) as sequence, c_custkey as line from {customer} join {nation} on c_nationkey = n_nationkey union all select ' ' as n_name, 'x' as sequence, 0 as line")
    return M.read_targets(rows, "n_name", "line").select("n_name", "sequence")


@query("B1_filter_columns", "select o_orderkey, o_orderstatus, o_orderpriority from orders")
def b1(t):
    return T.filter_columns(T.filter_columns(t.orders, omit=["o_totalprice", "o_orderdate"]), keep=["o_orderpriority", "o_orderkey", "o_orderstatus"])


@query("B2_rename_columns", "select o_orderpriority as priority, o_orderkey as id from orders")
def b2(t):
    return T.rename_columns(t.orders, ["o_orderpriority:priority", "o_orderkey:id", "o_orderkey:other"], reorder=True)


@query("B3_reorder_columns", "select n_name, n_regionkey, n_nationkey from nation")
def b3(t):
    return T.reorder_columns(t.nation, ["n_name", "n_regionkey"])


@query("B4_drop_columns", "select n_nationkey, n_name from nation")
def b4(t):
    return T.drop_columns(t.nation, ["n_regionkey"])


@query("B5_filter_rows", f"select c_custkey, 'any' as mode from {_M} where not {_BLANK.format('a')} or not {_BLANK.format('b')} union all select c_custkey, 'all blank' from {_M} where {_BLANK.format('a')} and {_BLANK.format('b')}")
def b5(t):
    df = t.sql(_MESSY)
    one = T.filter_rows(df, ["a", "b"]).select("c_custkey", F.lit("any").alias("mode"))
    return one.unionByName(T.filter_rows(df, ["a", "b"], "all", "blank").select("c_custkey", F.lit("all blank").alias("mode")))


@query("B6_compare_columns", f"""select c_custkey, concat_ws('; ', case when trim(coalesce(a, '')) <> trim(coalesce(b, '')) then 'a≠b' end, case when trim(coalesce(b, '')) <> trim(c_name) then 'b≠c_name' end) as differences
  from {_M} where trim(coalesce(a, '')) <> trim(coalesce(b, '')) or trim(coalesce(b, '')) <> trim(c_name)""")
def b6(t):
    return T.compare_columns(t.sql(_MESSY), ["a", "b"], ["b", "c_name"]).select("c_custkey", "differences")


_NT = "case l_linenumber % 4 when 0 then 'NM_1.1:c.' || l_partkey || 'A>G' when 1 then 'c.' || l_partkey || 'A>G' when 2 then '_wt' else '' end"
_HGVS = f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, {_NT} as nt, case when l_suppkey % 2 = 0 then 'p.Ala1Gly' else 'NA' end as pro from {{lineitem}}"


@query("B7_classify_input", f"select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(case when nt not in ('', '_wt') then case when nt like '%:%' then 1 else 2 end when pro <> 'NA' then 3 end as int) as kind from ({_HGVS})")
def b7(t):
    return t.sql(_HGVS).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", M.classify_input(F.col("nt"), F.col("pro")).alias("kind"))


_LEVEL = """select o_orderkey, case o_orderkey % 5 when 0 then 'protein' when 1 then 'DNA' when 2 then 'other' else '' end as level, case when o_custkey % 3 = 0 then 'g' else '' end as g,
  case when o_custkey % 4 = 0 then 'c' else '' end as c, case when o_custkey % 2 = 0 then 'p' else '' end as p from {orders}"""


@query("B8_classify_assay_level", f"""select o_orderkey, case when level = 'protein' or (level = '' and c = '' and g = '' and p <> '') then 'protein' when c <> '' or g <> '' then 'dna' else level end as level from ({_LEVEL})""")
def b8(t):
    return t.sql(_LEVEL).select("o_orderkey", M.classify_assay_level(*(F.col(c) for c in ("level", "g", "c", "p"))).alias("level"))


@query("B9_first_non_blank", f"select o_orderkey, coalesce(nullif(c, ''), nullif(g, ''), nullif(p, ''), '') as first from ({_LEVEL})")
def b9(t):
    return t.sql(_LEVEL).select("o_orderkey", X.first_non_blank(F.col("c"), F.col("g"), F.col("p")).alias("first"))


_IDS = "select o_orderkey, case o_orderkey % 4 when 0 then 'CA1' when 1 then 'PA1' when 2 then '_:CA1' else '' end as id, case when o_custkey % 2 = 0 then 'c.1A>G' else '' end as nt from {orders}"


@query("B10_validate_id_prefix", f"select o_orderkey, o_orderkey + 2 as line, id, case when nt = '' then 'PA' else 'CA' end as wanted from ({_IDS}) where (id = 'CA1' and nt = '') or (id = 'PA1' and nt <> '')")
def b10(t):
    return M.bad_id_prefix(t.sql(_IDS), "id", "nt", "o_orderkey")


@query("B11_append_error", "select o_orderkey, case when o_orderkey % 3 = 0 then 'bad' when o_orderkey % 3 = 1 then 'is bad here' else 'old; bad' end as error from orders")
def b11(t):
    old = F.when(F.col("o_orderkey") % 3 == 0, " ").when(F.col("o_orderkey") % 3 == 1, "is bad here").otherwise("old")
    return t.orders.select("o_orderkey", X.append_error(old, F.lit("bad")).alias("error"))


@query("B12_ensure_outcome", f"select o_orderkey, case when g = '' and c = '' and p = '' and level = '' then 'Mapping produced no HGVS output' else level end as level from ({_LEVEL})")
def b12(t):
    return M.ensure_outcome(t.sql(_LEVEL), ["g", "c", "p"], "level").select("o_orderkey", "level")


@query("B13_keep_existing", f"select o_orderkey, case when g = '' then c else g end as value from ({_LEVEL})")
def b13(t):
    return t.sql(_LEVEL).select("o_orderkey", M.keep_existing(F.col("c"), F.col("g")).alias("value"))


@query("B14_has_candidates", f"select o_orderkey, g <> '' or c <> '' as has from ({_LEVEL})")
def b14(t):
    df = t.sql(_LEVEL)
    return df.select("o_orderkey", S.has_candidates(df, ["g", "c"]).alias("has"))


@query("B15_detect_list_columns", "select unnest(['mapped_hgvs_g', 'spliceai.max', 'mapped_hgvs_c_start']) as name, count(*)::bigint as n from orders group by 1")
def b15(t):
    o = t.orders
    df = o.select(*(F.lit("x").alias(c) for c in ("mapped_hgvs_g", "vep.consequence", "spliceai.max", "mapped_hgvs_c_start", "mapped_hgvs_g_chromosome")))
    return o.select(F.explode(F.array(*map(F.lit, S.detect_list_columns(df)))).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


@query("C1_merge_columns", """select b.l_orderkey, b.l_partkey, b.l_suppkey, b.l_linenumber, coalesce(p.p_brand, '') as brand, coalesce(p.p_type, '') as l_returnflag from lineitem b left join (
  select p_partkey, arg_max(p_brand, o) as p_brand, arg_max(p_type, o) as p_type from (select p_partkey, p_brand, p_type, p_partkey as o from part where p_size <= 25 union all select p_partkey, p_name, p_type, p_partkey + 1000000 from part where p_size < 5) group by 1) p on p.p_partkey = b.l_partkey""")
def c1(t):
    extra = t.sql("select ' ' || cast(p_partkey as string) as key, p_brand, p_type, p_partkey as o from {part} where p_size <= 25 union all select cast(p_partkey as string) as key, p_name, p_type, p_partkey + 1000000 from {part} where p_size < 5")
    base = t.lineitem.withColumn("key", F.col("l_partkey").cast("string"))
    out = T.merge_columns(base, extra, ["key"], ["key"], ["p_brand", "p_type"], {"p_brand": "brand", "p_type": "l_returnflag"}, order="o")
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "brand", "l_returnflag")


@query("C2_replace_rows", """select c_custkey, arg_max(v, f) as v, min(f * 10000000 + c_custkey)::bigint as place from (select 0 as f, c_custkey, c_name as v from customer where c_custkey % 3 > 0
  union all select 1, c_custkey, c_mktsegment from customer where c_custkey % 2 = 0) group by 1""")
def c2(t):
    a = t.sql("select c_custkey, c_name as v from {customer} where c_custkey % 3 > 0")
    b = t.sql("select c_custkey, c_mktsegment as v from {customer} where c_custkey % 2 = 0")
    out = T.replace_rows([a, b], ["c_custkey"], "c_custkey")
    return out.select("c_custkey", "v", (F.col("_place._file") * F.lit(10000000) + F.col("_place.c_custkey")).cast("long").alias("place"))


@query("D9_first_last_wins", "select l_partkey, arg_min(l_returnflag, o) as first, arg_max(l_returnflag, o) as last from (select *, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as o from lineitem) group by 1")
def d9(t):
    rows = t.sql("select l_partkey, l_returnflag, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as o from {lineitem}")
    first = T.first_wins(rows, ["l_partkey"], "o").select("l_partkey", F.col("l_returnflag").alias("first"))
    return first.join(T.last_wins(rows, ["l_partkey"], "o").select("l_partkey", F.col("l_returnflag").alias("last")), "l_partkey")


_SCORES = "select case when l_suppkey % 3 = 0 then 'chr' else '' end || cast(1 + l_partkey % 22 as string) as chrom, l_partkey as pos, 'A' as ref, 'G' as alt, case when l_linenumber % 5 = 0 then '.' else cast(l_quantity as string) end as score, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey as line, l_returnflag || l_linestatus as class from {lineitem}"


@query("D1_max_score", f"""select replace(chrom, 'chr', '') as chrom, pos, ref, alt, coalesce(max(s) filter (chrom not like 'chr%'), max(s)) as score from (select *, try_cast(score as double) as s from ({_SCORES})) where s is not null group by 1, 2, 3, 4""")
def d1(t):
    return R.max_score(t.sql(_SCORES))


@query("D2_max_of_list", "select p_partkey, case when p_size % 4 = 0 then null else greatest(p_size, p_size % 7) / 100.0::double end as score from part")
def d2(t):
    text = F.when(F.col("p_size") % 4 == 0, ".;;NA").otherwise(F.concat_ws(";", (F.col("p_size") / 100.0).cast("string"), F.lit("."), (F.col("p_size") % 7 / 100.0).cast("string"), F.lit("x")))
    return t.part.select("p_partkey", X.max_of_list(text).alias("score"))


@query("D3_argmax", f"select pos, s as score, class from (select *, row_number() over (partition by pos order by s desc, line) as r from (select *, try_cast(score as double) as s from ({_SCORES})) where s is not null) where r = 1")
def d3(t):
    return R.argmax(t.sql(_SCORES).select("pos", R.number(F.col("score")).alias("score"), "line", "class"), ["pos"], "score", "line", "class")


@query("D4_field_max", "select p_partkey, cast(greatest(p_size, 10) as double) / 100 as ds_ag, 0.2::double as ds_al, cast(greatest(p_size - 30, -5) as double) as dp_ag, greatest(greatest(p_size, 10)::double / 100, 0.4) as max from part")
def d4(t):
    size = F.col("p_size")
    entry = lambda a, dp: F.concat_ws("|", F.lit("A"), F.lit("G1"), a, F.lit("0.2"), F.lit("0.3"), F.lit("0.4"), dp, F.lit("6"), F.lit("7"), F.lit("8"))
    info = F.concat(F.lit("X=1;SpliceAI="), entry((size / 100).cast("string"), (size - 30).cast("string")), F.lit(","), entry(F.lit("0.1"), F.lit("-5")), F.lit(",bad|1;Y=2"))
    # a small file has few row groups: its rows are dealt out before they are parsed
    rows = t.part.repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return rows.select("p_partkey", X.spliceai_info(info).alias("i")).select("p_partkey", "i.ds_ag", "i.ds_al", "i.dp_ag", "i.max")


_TYPES = "select user_id, case event_type when 'click' then 'missense_variant' when 'view' then 'synonymous_variant' when 'purchase' then 'stop_gained' else '' end as term, event_id from {events}"


@query("D5_consensus", f"select user_id, case when count(distinct nullif(term, '')) = 1 then max(nullif(term, '')) else '' end as value, count(distinct nullif(term, '')) > 1 as differs from ({_TYPES}) group by 1")
def d5(t):
    return t.sql(_TYPES).groupBy("user_id").agg(F.collect_set("term").alias("s")).select("user_id", R.consensus(F.col("s")).alias("c")).select("user_id", "c.*")


@query("D6_most_severe", f"select user_id, arg_min(term, case term when 'stop_gained' then 4 when 'missense_variant' then 13 when 'synonymous_variant' then 22 end) as term from ({_TYPES}) group by 1")
def d6(t):
    return R.most_severe(t.sql(_TYPES), ["user_id"], "term")


@query("D7_ordered_distinct_concat", "select l_orderkey, string_agg(l_returnflag, ' | ' order by f) as flags from (select l_orderkey, l_returnflag, min(l_linenumber * 10000000 + l_partkey * 1000 + l_suppkey) as f from lineitem group by 1, 2) group by 1")
def d7(t):
    order = F.col("l_linenumber") * 10000000 + F.col("l_partkey") * 1000 + F.col("l_suppkey")
    return t.lineitem.groupBy("l_orderkey").agg(R.ordered_distinct_concat(order, F.col("l_returnflag")).alias("flags"))


_AC = "select p_partkey, cast(p_size as bigint) as ac, cast(case when p_partkey % 5 = 0 then 0 else 50 + p_partkey % 10 end as bigint) as an from {part}"


@query("D8_frequency", f"select p_partkey, ac / an as af, least(ac / an, 1 - ac / an) as maf from ({_AC}) where an > 0")
def d8(t):
    return t.sql(_AC).select("p_partkey", R.frequency(F.col("ac"), F.col("an")).alias("f")).filter("f is not null").select("p_partkey", "f.*")


@query("D10_repack_slots", "with cand as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_partkey % 5 = 0 then '' else 'CA' || l_partkey::varchar end as key from lineitem) select l_orderkey, string_agg(key, '|' order by l_linenumber, l_partkey, l_suppkey) as ids from cand group by 1")
def d10(t):
    key = F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("CA"), F.col("l_partkey").cast("string")))
    long = t.lineitem.select(F.col("l_orderkey").alias(S.ROW), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias(S.SLOT), key.alias("key"))
    return S.pack_slots(long, {"ids": "key"}).withColumnRenamed(S.ROW, "l_orderkey")


@query("D11_run_report", f"select count(*)::bigint as n_rows, count_if(g <> '')::bigint as annotated, count_if(level = 'other')::bigint as errors from ({_LEVEL})")
def d11(t):
    return T.run_report(t.sql(_LEVEL), annotated=F.col("g") != "", errors=F.col("level") == "other")


@query("D15_distinct_keys", "select distinct l_partkey::varchar as key from lineitem")
def d15(t):
    return T.distinct_keys(t.lineitem.select(F.col("l_partkey").cast("string").alias("k")), "k")


@query("E1_contiguous_runs", """select o_orderkey, sum(n) over (order by o_orderkey rows unbounded preceding)::bigint as run, sum(m) over (partition by o_orderstatus order by o_orderkey rows unbounded preceding)::bigint as run_within
  from (select *, case when o_orderpriority is distinct from lag(o_orderpriority) over (order by o_orderkey) or row_number() over (order by o_orderkey) = 1 then 1 else 0 end as n,
    case when o_orderpriority is distinct from lag(o_orderpriority) over (partition by o_orderstatus order by o_orderkey) then 1 else 0 end as m from orders)""")
def e1(t):
    df = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus")
    whole = T.contiguous_runs(df, "o_orderpriority", "o_orderkey").select("o_orderkey", "run")
    within = T.contiguous_runs(df, "o_orderpriority", "o_orderkey", ["o_orderstatus"]).select("o_orderkey", F.col("run").alias("run_within"))
    return whole.join(within, "o_orderkey")


_GROUPS = "select o_orderkey, case when o_orderkey % 3 = 0 then '' else o_orderpriority end as target, o_orderstatus as seq from {orders}"


@query("E2_group_rows", f"select case when target = '' then seq else target end as group_key, arg_min(seq, o_orderkey) as first_sequence, count(distinct seq) > 1 as sequences_differ, count(*)::bigint as n_rows from ({_GROUPS}) group by 1")
def e2(t):
    return T.group_rows(t.sql(_GROUPS), "target", "seq", "o_orderkey")


_TX = "select l_suppkey, case l_partkey % 4 when 0 then 'NM_' when 1 then 'NR_' when 2 then 'ENST' else 'ZZ_' end || cast(l_partkey as string) || '.' || cast(1 + l_partkey % 3 as string) as tx from {lineitem}"
_TXRANK = "case when tx like 'NM%' then 0 when tx like 'NR%' then 1 when tx like 'ENST%' then 4 else 6 end"


@query("E3_rank_pick", f"select l_suppkey, tx from (select *, row_number() over (partition by l_suppkey order by {_TXRANK}, -cast(split_part(tx, '.', 2) as int), tx) as r from ({_TX})) where r = 1")
def e3(t):
    return R.rank_pick(t.sql(_TX), ["l_suppkey"], [X.transcript_sort_key(F.col("tx"))], "tx")


@query("F1_ordered", "select o_orderkey, row_number() over (order by o_orderkey)::bigint as place from orders")
def f1(t):
    return T.with_row_id(t.orders.select("o_orderkey").repartition(7), ["o_orderkey"]).orderBy("_row_id").select("o_orderkey", (F.col("_row_id") + 1).alias("place"))


@query("F3_sort_by_locus", "select p_partkey, row_number() over (order by 1 + p_partkey % 22, p_partkey)::bigint - 1 as place from part")
def f3(t):
    from ..sources.io import chrom_rank

    rows = t.part.select("p_partkey", chrom_rank((1 + F.col("p_partkey") % 22).cast("string")).alias("r"))
    return T.with_row_id(rows, ["r", "p_partkey"]).select("p_partkey", F.col("_row_id").alias("place"))


@query("G1_split_slots", "select row_id, cast(len(string_split(ids, '|')) as int) as n, array_to_string([trim(x) for x in string_split(ids, '|')], ',') as joined from {variants} v")
def g1(t):
    return t.variants.select("row_id", F.size(X.split_slots(F.col("ids"))).alias("n"), F.array_join(X.split_slots(F.col("ids")), ",").alias("joined"))


@query("G2_split_values", "select row_id, array_to_string([x for x in string_split(ids, '|') if x <> ''], ',') as joined from {variants} v")
def g2(t):
    return t.variants.select("row_id", F.array_join(X.split_values(F.col("ids")), ",").alias("joined"))


_RAGGED = "select row_id, ids, case when row_id % 2 = 0 then starts else refs || '|x|y' end as other from {variants}"


@query("G3_zip_slots", f"select row_id, slot - 1 as slot, a, b from {slots('(' + _RAGGED + ')', a='ids', b='other')}")
def g3(t):
    long = S.explode_slots(t.sql(_RAGGED).withColumn(S.ROW, F.col("row_id")), a="ids", b="other")
    return long.select(F.col(S.ROW).alias("row_id"), F.col(S.SLOT).cast("long").alias("slot"), "a", "b")


@query("G4_flatten_candidates", f"select row_id, a as mapped_hgvs_g, b as mapped_hgvs_c, o_orderstatus from {slots('{variants}', a='g', b='c')} where trim(replace(g || c, '|', ' ')) <> '' or g like '%|%' or c like '%|%'")
def g4(t):
    df = t.variants.select("row_id", F.col("g").alias("mapped_hgvs_g"), F.col("c").alias("mapped_hgvs_c"), "o_orderstatus")
    return S.flatten_candidates(df)


@query("G5_pack_candidates", "select row_id, ids, g from {variants} v")
def g5(t):
    long = S.explode_slots(t.variants.select(F.col("row_id").alias(S.ROW), "ids", "g"), a="ids", b="g")
    return S.pack_slots(long, {"ids": "a", "g": "b"}).select(F.col(S.ROW).alias("row_id"), "ids", "g")


@query("G6_any_slot", f"select row_id, bool_or(s = '') as any_blank, {packed('cast(s = chr(65) as varchar)')} as is_a from {slots('{variants}', s='refs')} group by 1")
def g6(t):
    refs = F.col("refs")
    return t.variants.select("row_id", X.any_slot(refs, lambda x: x == "").alias("any_blank"), X.join_slots(F.transform(X.split_slots(refs), lambda x: x == "A")).alias("is_a"))
