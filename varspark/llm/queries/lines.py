from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import stage, table
from ..linededup import apply_bitmaps, keep_bitmaps


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = apply_bitmaps(docs, stage(keep_bitmaps(docs), "line-bitmaps"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op9_line_dedup": op9_line_dedup}
ORACLE_SQL = {
    "op9_line_dedup": r"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
lines as (
  select doc_id, pos, line, translate(trim(line, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from docs)),
first as (select key, min(doc_id) as holder from lines where length(key) >= 10 group by key having count(distinct doc_id) > 1),
marked as (select l.*, f.holder is not null and f.holder <> l.doc_id as gone from lines l left join first f on f.key = l.key and length(l.key) >= 10)
select doc_id, count(*)::bigint as n_lines, count_if(gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from marked group by doc_id"""
}
