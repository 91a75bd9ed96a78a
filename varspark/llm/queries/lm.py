from pyspark.sql import DataFrame, SparkSession

from ..common import table
from ..lm import backoff_scores


def op10_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents")).drop("mean_log_score")


QUERIES = {"op10_stupid_backoff": op10_stupid_backoff}
ORACLE_SQL = {
    "op10_stupid_backoff": r"""
with texts as (
  select doc_id, string_split_regex(trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || e'\t\n\x0b\x0c\r', 'abcdefghijklmnopqrstuvwxyz' || '     ')), ' +') as w from documents),
seq as (select doc_id, unnest(w) as w, generate_subscripts(w, 1) as i from texts where w <> ['']),
grams as (select doc_id, i, w, lag(w) over d as p, lag(w, 2) over d as q from seq window d as (partition by doc_id order by i)),
uni as (select w, count(*) as n from seq group by w),
bi as (select p, w, count(*) as n from grams where p is not null group by p, w),
tri as (select q, p, w, count(*) as n from grams where q is not null group by q, p, w),
total as (select count(*) as n from seq),
found as (
  select a.doc_id, a.q is not null as three, a.p is not null as two, coalesce(c.n, 0) >= 2 as c3, coalesce(b.n, 0) >= 2 as c2,
    c.n / x.n as s3, b.n / v.n as s2, u.n / t.n as s1
  from grams a join uni u on u.w = a.w left join bi b on b.p = a.p and b.w = a.w left join uni v on v.w = a.p
    left join tri c on c.q = a.q and c.p = a.p and c.w = a.w left join bi x on x.p = a.q and x.w = a.p cross join total t),
terms as (
  select doc_id, (three and not c3) or (two and not three and not c2) as backed,
    round(ln(case when three and c3 then s3 when three and c2 then 0.4::double * s2 when two and not three and c2 then s2
      when three then 0.4::double * 0.4::double * s1 when two then 0.4::double * s1 else s1 end) * 1e6)::bigint as m
  from found)
select d.doc_id, count(m)::bigint as n_words, count_if(coalesce(backed, false))::bigint as n_backoff, coalesce(sum(m), 0)::double / 1e6 as log_score
from (select distinct doc_id from documents) d left join terms using (doc_id) group by d.doc_id"""
}
