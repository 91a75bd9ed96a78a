from pyspark.sql import DataFrame, SparkSession

from ..common import table
from ..resample import resample


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = resample(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("kept.doc_id", "n_features", "weight", "score", "rank")


QUERIES = {"op12_importance_resampling": op12_importance_resampling}
ORACLE_SQL = {
    "op12_importance_resampling": r"""
with words as (
  select true as own, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents
  union all
  select false, null, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark),
crc_table as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end, i::bigint)) as t),
distinct_words as (select w, hex(encode(w)) as x from (select distinct w from words)),
bytes as (
  select w, list_transform(range(length(x) // 2), lambda i: (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1) as b from distinct_words),
hashed as (
  select w, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::bigint), 4294967295::bigint) % 10000 as bucket from bytes cross join crc_table),
features as (select own, doc_id, bucket from words join hashed using (w)),
counts as (select bucket, count(*) filter (own) as s, count(*) filter (not own) as t from features group by bucket),
totals as (select coalesce(sum(s), 0)::double as ss, coalesce(sum(t), 0)::double as tt from counts),
gain as (select bucket, floor(1000 * ln((t + 1)::double * (ss + 10000) / ((s + 1)::double * (tt + 10000))))::bigint as g from counts cross join totals),
weighed as (select doc_id, count(*) as n, floor(sum(g)::double / count(*))::bigint as weight from features join gain using (bucket) where own group by doc_id),
scored as (
  select d.doc_id, coalesce(n, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
    coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id)[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from documents d left join weighed using (doc_id)),
drawn as (
  select doc_id, row_number() over (order by score desc, doc_id) as r from scored where n_features >= 20),
size as (select 10 * count(*) // 100 as most from drawn)
select s.doc_id, n_features, weight, score, case when r <= most then r end::bigint as rank
from scored s left join drawn using (doc_id) cross join size"""
}
