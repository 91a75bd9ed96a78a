"""Rows that share their lists share one annotation."""

import pytest

from varspark import staging
from varspark.operators import annotate as A
from varspark.operators import slots as S
from varspark.operators.coordinates import coordinate_steps
from varspark.plans.pipeline import pipeline
from varspark.queries import queries

DATA = "/root/testdata/sf0.001"


def test_annotation_by_lists_equals_annotation_by_row(spark):
    """Equal rows, null and empty lists, lists of unequal length, a column that is made anew and a step on the wide rows alone."""
    g = ["NC_000001.11:g.5A>T|", None, "", " NC_000002.12:g.7_8del | x |NC_000001.11:g.5A>T", "NC_000001.11:g.5A>T|"]
    c = ["NM_1.1:c.5+1A>T", "", None, None, "NM_1.1:c.5+1A>T"]
    rows = spark.createDataFrame([(i, a, b, "", "CA1|CA2", "old", f"urn:{i}#1|2", "3") for i, (a, b) in enumerate(zip(g, c))] * 2, "k int, mapped_hgvs_g string, mapped_hgvs_c string, mapped_hgvs_p string, ids string, mapped_hgvs_g_start string, urn string, score string")
    bridge = spark.createDataFrame([("CA1", "v1", "a1")], "caid string, variation_id string, allele_id string")
    summary = spark.createDataFrame([("a1", "benign", "practice guideline", "d")], "allele_id string, clinical_significance string, review_status string, last_review_date string")
    cals = spark.createDataFrame([("urn:0", 0, "cal", True, False, False)], "score_set string, ordinal int, calibration string, primary boolean, investigator boolean, research_only boolean")
    ranges = spark.createDataFrame([("cal", 0, "low", 0.0, 9.0, True, False)], "calibration string, ordinal int, label string, low double, high double, low_in boolean, high_in boolean")
    steps = [*coordinate_steps(), A.clinvar_step(bridge, summary, "ids"), A.calibration_step(cals, ranges, "urn", "score", "m", "http://x")]
    want = pipeline(rows, steps)
    before = len(staging._staged)
    got = pipeline(rows, steps, by_lists=True)
    asked = [p for p in staging._staged[before:] if "/rows-" in p]
    assert [spark.read.parquet(p).count() for p in asked] == [3]  # a null list is an empty one; urn is no list of the layer
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert got.filter("k = 0").select("`m.primary_calibration.functional_class`", "`clinvar.202601.stars`").distinct().collect() == [("low", "4|")]


def test_a_step_without_lists_of_its_own_needs_no_long_layer(spark):
    step = S.Step({"x": "a"}, lambda long: long, {}, after=lambda df: df.withColumn("b", df.a))
    out = S.annotate(spark.createDataFrame([(1, "x|y")], "k int, a string"), step, key=["k"])
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.collect() == [(1, "x|y", "x|y")]


@pytest.mark.parametrize("name, table", [("K5_coordinates_refseq", "lineitem"), ("K15_all_annotators", "orders"), ("K3_reverse_translate", "orders")])
def test_queries_annotate_each_combination_once(spark, name, table):
    before = len(staging._staged)
    queries()[name](spark, DATA)
    asked = [p for p in staging._staged[before:] if "/rows-" in p]
    assert len(asked) == 1
    assert spark.read.parquet(asked[0]).count() < spark.read.parquet(f"{DATA}/{table}.parquet").count()


def test_slots_are_packed_in_their_order_without_a_comparator(spark):
    """By number, not by text; array_sort calls a comparator that makes an ordering each time."""
    long = spark.createDataFrame([(1, i, None if i == 3 else f"v{i}") for i in (10, 3, 2, 11)] + [(2, 0, "x")], f"{S.ROW} int, {S.SLOT} int, v string")
    out = S.pack_slots(long, {"out": "v"})
    assert sorted(map(tuple, out.collect())) == [(1, "v2||v10|v11"), (2, "x")]
    assert "array_sort" not in out._jdf.queryExecution().optimizedPlan().toString()
