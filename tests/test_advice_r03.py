"""Costly steps run once for what they are given."""

from varspark import staging
from varspark.functions import expr as X
from varspark.operators import mapping as M
from varspark.queries import queries

DATA = "/root/testdata/sf0.001"


def test_splice_entries_are_parsed_once(spark):
    rows = spark.createDataFrame([("SpliceAI=A|G|0.1|0.2|0.3|0.4|5|6|7|8,A|G|0.5|0.1|0.1|0.1|1|1|1|9,bad|1",), ("X=1",), (None,)], "info string")
    out = rows.select(X.spliceai_info(rows.info).alias("i")).select("i.*")
    got = [tuple(r) for r in out.collect()]
    assert got == [(0.5, 0.2, 0.3, 0.4, 5.0, 6.0, 7.0, 9.0, 0.5), (None,) * 9, (None,) * 9]
    plan = queries()["D4_field_max"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SpliceAI=([") == 1


def test_haplotypes_are_composed_by_string(spark):
    """Rows without a key are not written to be numbered: equal strings share one composition, null targets too."""
    text = "NM_1.1:c.[4A>T;6C>G]"
    rows = spark.createDataFrame([(1, text, "ATGAAC"), (1, text, "ATGAAC"), (2, text, None), (3, "c.4A>T", "ATGAAC")], "k int, raw_hgvs_nt string, target_sequence string")
    mapping = spark.createDataFrame([("NM_1.1", None, c, f"NM_1.1:c.{c}") for c in ("4A>T", "6C>G")], "accession string, target string, component string, mapped_c string")
    before = len(staging._staged)
    got = sorted((r.k, r.raw_hgvs_nt) for r in M.rewrite_haplotypes(rows, mapping).collect())
    assert len(staging._staged) == before
    assert got == [(1, "NM_1.1:c.4_6delinsTAG")] * 2 + [(2, text), (3, "c.4A>T")]
