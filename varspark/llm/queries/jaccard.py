from pyspark.sql import DataFrame, SparkSession

from ..common import table
from ..jaccard import similar_documents


def op6_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op6_partition_jaccard": op6_partition_jaccard}
ORACLE_SQL = {
    "op6_partition_jaccard": r"""
with recursive words as (
  select doc_id, string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || e'\t\n\x0b\x0c\r', 'abcdefghijklmnopqrstuvwxyz' || '     ')), ' +') as w from documents),
sets as (
  select doc_id, case when w = [''] then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as s from words),
items as (select doc_id, unnest(s) as x, len(s) as n from sets),
pairs as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as shared
  from items a join items b on a.x = b.x and a.doc_id < b.doc_id and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n) group by 1, 2),
links as (select a, b from pairs where 100 * shared >= 80 * (na + nb - shared)),
both_ways as (select a, b from links union all select b, a from links),
reach as (select doc_id as a, doc_id as b from sets union select r.a, l.b from reach r join both_ways l on l.a = r.b)
select s.doc_id, len(s.s)::bigint as n_shingles, r.c as component_id
from sets s join (select a, min(b) as c from reach group by a) r on r.a = s.doc_id"""
}
