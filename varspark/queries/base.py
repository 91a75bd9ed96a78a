"""Inputs of the queries, derived from the driver's tables by SQL that both engines run."""

from __future__ import annotations

import os
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..functions.expr import GRCH38

TABLES = "region nation customer supplier part orders lineitem events documents".split()
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

_K = "(1 + ({o} * 7 + {i} * 31) % 2000)"


def _base(k: str, shift: str = "0") -> str:
    return f"substr('ACGT', cast(1 + ({k} + {shift}) % 4 as int), 1)"


def accession(k: str) -> str:
    """NC accession of chromosome 1 + k % 22."""
    versions = " ".join(f"when {i} then {v}" for i, v in enumerate(GRCH38[:22]))
    return f"'NC_' || lpad(cast(1 + {k} % 22 as string), 6, '0') || '.' || cast(case {k} % 22 {versions} end as string)"


def _listed(make, o: str = "o_orderkey") -> str:
    """A candidate list of 1 to 3 slots, about a fifth of them empty."""
    slots = [f"case when ({o} + {i}) % 5 = 0 then '' else {make(_K.format(o=o, i=i))} end" for i in (1, 2, 3)]
    return f"{slots[0]} || case when {o} % 3 > 0 then '|' || {slots[1]} else '' end || case when {o} % 3 > 1 then '|' || {slots[2]} else '' end"


def _alt(k: str) -> str:
    return _base(k, "1 + o_orderkey % 2")


INPUTS = {
    "variants": f"""select o_orderkey as row_id, o_custkey, o_orderpriority, o_orderstatus,
      {_listed(lambda k: f"'CA' || cast({k} as string)")} as ids,
      {_listed(lambda k: f"{accession(k)} || ':g.' || cast(1000 + {k} as string) || {_base(k)} || '>' || {_alt(k)}")} as g,
      {_listed(lambda k: f"'NM_' || cast({k} % 300 as string) || '.1:c.' || cast({k} as string) || 'A>G'")} as c,
      {_listed(lambda k: f"cast(1 + {k} % 22 as string)")} as chroms,
      {_listed(lambda k: f"cast(1000 + {k} as string)")} as starts,
      {_listed(_base)} as refs,
      {_listed(_alt)} as alts
    from {{orders}}""",
    # alleles of all parts: two alternatives each
    "alleles": f"""select p_partkey as k, s.shift, cast(1 + p_partkey % 22 as string) as chrom, 1000 + p_partkey as pos,
      {_base("p_partkey")} as ref, {_base("p_partkey", "s.shift")} as alt, p_size, p_type, p_brand, p_retailprice
    from {{part}} cross join (select 1 as shift union all select 2 as shift) s""",
    "clinvar": """select 'CA' || cast(p_partkey as string) as caid, cast(p_partkey * 3 as string) as variation_id, cast(p_partkey * 5 as string) as allele_id, p_size,
      case when p_size > 10 then p_brand end as clinical_significance,
      case p_partkey % 6 when 0 then 'practice guideline' when 1 then 'Reviewed by expert panel' when 2 then 'criteria provided, single submitter'
        when 3 then 'no assertion provided' when 4 then 'criteria provided, conflicting classifications of x' else 'other' end as review_status
    from {part}""",
    "lines": "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus from {lineitem}",
}


class Tables:
    """The driver's tables, and inputs made of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))
        if name in INPUTS:
            return self.sql(INPUTS[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        used = {n: getattr(self, n) for n in [*TABLES, *INPUTS] if "{" + n + "}" in text}
        return self.spark.sql(text, **used)


def plain(text: str) -> str:
    """The same SQL for DuckDB: inputs become subqueries."""
    for _ in range(2):
        for n in INPUTS:
            text = text.replace("{" + n + "}", f"({INPUTS[n]})")
    for n in TABLES:
        text = text.replace("{" + n + "}", n)
    return text


def query(name: str, sql: str | None):
    """Registers a query under ``name`` with its SQL."""

    def put(f):
        QUERIES[name] = partial(_run, f)
        if sql is not None:
            ORACLE_SQL[name] = plain(sql)
        return f

    return put


def _run(f, spark: SparkSession, sf_dir: str) -> DataFrame:
    return f(Tables(spark, sf_dir))


def slots(view: str, **lists: str) -> str:
    """DuckDB: one row for each slot of aligned lists."""
    n = ", ".join(f"len(string_split({c}, '|'))" for c in lists.values())
    n = f"greatest({n})" if len(lists) > 1 else n
    cols = ", ".join(f"coalesce(trim(string_split({c}, '|')[i]), '') as {k}" for k, c in lists.items())
    return f"(select v.*, i as slot, {cols} from {view} v, unnest(generate_series(1, {n})) t(i))"


def packed(expr: str) -> str:
    return f"string_agg(coalesce({expr}, ''), '|' order by slot)"
