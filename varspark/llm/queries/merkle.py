from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import table
from ..merkle import lower_cased, manifest


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", tampered, "text", lower_cased("text"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLE_SQL = {
    "op13_merkle_manifest": r"""
with recursive crc_table as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, i::bigint)) as t),
fields as (
  select doc_id, source, doc_id::varchar as a, source as b, lang as c, n_chars::varchar as d, text as e,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as f,
    xor(list_reduce(list_transform(range(length(doc_id::varchar)), lambda i: ascii((doc_id::varchar)[i + 1])::bigint), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 5 = 0 as tampered
  from documents cross join crc_table),
said as (
  select doc_id, source, coalesce(tampered, false) as tampered,
    coalesce(strlen(a) || ':' || a, '-') || coalesce(strlen(b) || ':' || b, '-') || coalesce(strlen(c) || ':' || c, '-') || coalesce(strlen(d) || ':' || d, '-') as head,
    coalesce(strlen(e) || ':' || e, '-') as body, coalesce(strlen(f) || ':' || f, '-') as other from fields),
leaf as (
  select doc_id, source, sha256(head || body) as leaf, case when tampered then sha256(head || other) else sha256(head || body) end as folded,
    row_number() over (partition by source order by doc_id nulls first, sha256(head || body)) - 1 as idx, count(*) over (partition by source) as n from said),
tree as (
  select source, 0 as level, idx, n, leaf as digest, true as own from leaf
  union all
  select source, level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by idx)), true from tree where n > 1 group by source, level, n, idx // 16),
subs as (
  select source, digest as subroot, row_number() over (order by source nulls first) - 1 as no, count(*) over () as groups from tree where n = 1),
top as (
  select 0 as level, no as idx, groups as n, subroot as digest from subs
  union all
  select level + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by idx)) from top where n > 1 group by level, n, idx // 16),
root as (select digest as root from top where n = 1),
pieces as (
  select t.source, t.level, t.idx, t.n, string_agg(s.digest, '' order by s.idx) filter (s.idx < t.idx) as l, string_agg(s.digest, '' order by s.idx) filter (s.idx > t.idx) as r
  from tree t join tree s on s.source is not distinct from t.source and s.level = t.level and s.idx // 16 = t.idx // 16 where t.n > 1 group by all),
top_pieces as (
  select t.level, t.idx, t.n, string_agg(s.digest, '' order by s.idx) filter (s.idx < t.idx) as l, string_agg(s.digest, '' order by s.idx) filter (s.idx > t.idx) as r
  from top t join top s on s.level = t.level and s.idx // 16 = t.idx // 16 where t.n > 1 group by all),
climb as (
  select doc_id, leaf, source, 0 as level, idx, n, folded, '' as proof from leaf
  union all
  select doc_id, leaf, c.source, c.level + 1, c.idx // 16, (c.n + 15) // 16, sha256(coalesce(l, '') || folded || coalesce(r, '')), proof || coalesce(l, '') || coalesce(r, '')
  from climb c join pieces p on p.source is not distinct from c.source and p.level = c.level and p.idx = c.idx where c.n > 1),
second as (
  select doc_id, leaf, subroot, 0 as level, no as idx, groups as n, folded, proof from climb c join subs s on s.source is not distinct from c.source where c.n = 1
  union all
  select doc_id, leaf, subroot, c.level + 1, c.idx // 16, (c.n + 15) // 16, sha256(coalesce(l, '') || folded || coalesce(r, '')), proof || coalesce(l, '') || coalesce(r, '')
  from second c join top_pieces p on p.level = c.level and p.idx = c.idx where c.n > 1)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, folded as folded_root, folded = root as verified
from second cross join root where n = 1"""
}
