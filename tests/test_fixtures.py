"""Cases with known results: blanks, ragged lists, ties, errors, text sources."""

import pytest
from pyspark.sql import functions as F

from varspark.functions import expr as X
from varspark.operators import annotate as A
from varspark.operators import mapping as M
from varspark.operators import rank as R
from varspark.operators import slots as S
from varspark.operators import tables as T
from varspark.sources import io


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_split_slots_keeps_blanks(spark):
    assert value(spark, X.split_slots(F.lit("a||c"))) == ["a", "", "c"]
    assert value(spark, X.split_slots(F.lit(None).cast("string"))) == [""]


@pytest.mark.parametrize("text,want", [("p.A300T", "p.Ala300Thr"), ("p.A300=", "p.Ala300Ala"), ("p.A300*", "p.Ala300Ter"), ("p.A300-", "p.Ala300del"), ("p.A300fs*7", "p.Ala300fs*7"), ("p.Ala3Thr", "p.Ala3Thr"), ("_wt", "_wt")])
def test_normalize_protein(spark, text, want):
    assert value(spark, X.normalize_protein(F.lit(text))) == want


@pytest.mark.parametrize("nt,pro,want", [("NM_1.1:c.1A>G", "", 1), ("c.1A>G", "", 2), ("", "p.A1G", 3), ("_wt", "NA", None), (None, None, None)])
def test_classify_input(spark, nt, pro, want):
    assert value(spark, M.classify_input(F.lit(nt).cast("string"), F.lit(pro).cast("string"))) == want


def test_parse_protein(spark):
    for text, want in {"p.Pro656Leu": ("656", "656", "P", "L"), "p.Pro656Ter": ("656", "656", "P", "*"), "p.Pro656del": ("656", "656", "P", ""), "p.Pro656_Leu660del": ("656", "660", "P_L", "")}.items():
        assert tuple(value(spark, X.parse_protein(F.lit(text)))) == want


def test_stars(spark):
    assert [value(spark, X.stars(F.lit(s))) for s in ("reviewed by expert panel", "unknown", "")] == ["3", "", ""]


def test_spliceai_fields(spark):
    info = "SpliceAI=T|ONE|0.01|0.62|0.07|0.33|-4|15|2|9,T|TWO|0.44|0.21|0.08|0.02|7|-1|30|6"
    v = value(spark, X.spliceai_info(F.lit(info)))
    assert tuple(v) == (0.44, 0.62, 0.08, 0.33, 7, 15, 30, 9, 0.62)
    assert value(spark, X.spliceai_info(F.lit(info), F.lit("C"))) is None
    assert value(spark, X.spliceai_info(F.lit(info), F.lit(None).cast("string")))["ds_ag"] == 0.44


def test_flatten_ragged(spark):
    df = spark.createDataFrame([("g.1A>T|g.2A>T", "c.1A>T||c.3A>T", "CA123||CA125", 1), ("", "", "", 2)], "mapped_hgvs_g string, mapped_hgvs_c string, dna_clingen_allele_id string, k int")
    out = S.flatten_candidates(df)
    assert rows(out, *out.columns) == [("", "c.3A>T", "CA125", 1), ("g.1A>T", "c.1A>T", "CA123", 1), ("g.2A>T", "", "", 1)]
    with pytest.raises(ValueError):
        S.flatten_candidates(df.select("k"))


def test_flatten_and_pack_are_inverse(spark):
    df = spark.createDataFrame([(1, "a||b", "x"), (2, "", ""), (3, "|", "y|z")], "_row_id int, a string, b string")
    long = S.explode_slots(df, a1="a", b1="b")
    assert rows(S.pack_slots(long, {"a": "a1"}), "_row_id", "a") == [(1, "a||b"), (2, ""), (3, "|")]


def test_clinvar_slots(spark):
    df = spark.createDataFrame([(1, "CA_A|CA_B"), (2, "CA_NO|CA_B"), (3, ""), (4, None)], "k int, ids string")
    bridge = spark.createDataFrame([("CA_A", "401", "12345"), ("CA_B", "402", "99999")], "caid string, variation_id string, allele_id string")
    summary = spark.createDataFrame([("12345", "Pathogenic", "reviewed by expert panel", ""), ("99999", "Benign", "criteria provided, multiple submitters, no conflicts", "")], "allele_id string, clinical_significance string, review_status string, last_review_date string")
    out = A.annotate_clinvar(df, bridge, summary, "ids")
    assert rows(out, "k", "`clinvar.202601.variation_id`", "`clinvar.202601.clinical_significance`", "`clinvar.202601.stars`") == [(1, "401|402", "Pathogenic|Benign", "3|2"), (2, "|402", "|Benign", "|2"), (3, "", "", ""), (4, "", "", "")]


def test_frequency_by_id(spark):
    df = spark.createDataFrame([(1, "CA001|CA2|CA3")], "k int, ids string")
    freq = spark.createDataFrame([("CA2", 10, 100, 0.09, "x"), ("CA3", 5, 100, None, None), ("CA1", 5, 0, 0.1, "y")], "caid string, allele_count long, allele_number long, faf95_max double, faf95_max_ancestry string")
    out = A.annotate_frequency(df, freq, "caid", ids_col="ids")
    assert rows(out, "`gnomad.v4_1.allele_frequency`", "`gnomad.v4_1.faf95_max`") == [("|0.1|0.05", "|0.09|")]


def test_consequence_rules(spark):
    vep = spark.createDataFrame([("h1", "missense_variant"), ("h2", "synonymous_variant"), ("h3", None), ("r1", "synonymous_variant"), ("r2", "missense_variant")], "hgvs string, consequence string")
    recoded = spark.createDataFrame([("h4", "r1"), ("h4", "r2"), ("h3", "r2")], "hgvs string, genomic string")
    df = spark.createDataFrame([(1, "h1|h1"), (2, "h2|h3"), (3, "h1|h2|h3"), (4, "h4"), (5, "")], "k int, c string")
    out = A.annotate_consequence(df, vep, recoded, ["c"])
    got = {r[0]: (r[1], r[2]) for r in rows(out, "k", "`vep.consequence`", "`vep.error`")}
    assert got[1] == ("missense_variant", "") and got[2] == ("synonymous_variant", "") and got[4] == ("missense_variant", "") and got[5] == ("", "")
    assert got[3][0] == "" and got[3][1].endswith("missense_variant|synonymous_variant|")


def test_evidence_by_three_keys(spark):
    df = spark.createDataFrame([(1, "NM_1.1:c.1A>G", "V2", ""), (2, "NM_1.1:c.1A>G", "", "CA9")], "k int, c string, v string, i string")
    e = spark.createDataFrame([(1, ["NM_1.1(G):c.1A>G"], "", "", "u1", "Benign"), (2, [], "V2", "", "u2", "Benign")], "record long, hgvs array<string>, variation_id string, caid string, uuid string, assertion string")
    out = A.annotate_evidence(df, e, "c", "v", "i", ["uuid", "assertion"])
    got = {r[0]: r[1:] for r in rows(out, "k", "`clingen_evidence_repository.uuid`", "`clingen_evidence_repository.assertion`", "`clingen_evidence_repository.warnings`")}
    assert got[1] == ("u1 | u2", "Benign", "non-overlapping results for keys 'hgvs' and 'clinvar'")
    assert got[2] == ("u1", "Benign", "found via 'hgvs' but not 'caid'")


def test_ranges_with_open_bounds(spark):
    ranges = spark.createDataFrame([("c", 0, "low", None, 0.5, None, None), ("c", 1, "high", 0.5, None, None, None)], "calibration string, ordinal int, label string, low double, high double, low_in boolean, high_in boolean")
    s = spark.createDataFrame([("c", "0.2"), ("c", "0.5"), ("c", "x"), ("c", "NaN"), ("c", ""), ("d", "1")], "calibration string, score string")
    assert rows(A.classify_by_range(s, ranges), "calibration", "score", "label") == [("c", "", ""), ("c", "0.2", "low"), ("c", "0.5", "high"), ("c", "NaN", ""), ("c", "x", ""), ("d", "1", "")]


def test_haplotypes(spark):
    df = spark.createDataFrame([(1, "c.[7C>A;9T>C]", "AAACCCCGTTTT"), (2, "c.[7C>A;10T>C]", "AAACCCCGTTTT"), (3, "c.7C>A", "AAACCCCGTTTT"), (4, None, None), (5, "NM_7.1:c.[7c>a;8G>T]", ""), (6, "NM_7.1:c.[7C>A;9T>C]", ""), (7, "NM_7.1:c.[7C>A;12T>A]", ""), (8, "c.[7C>A;9T>C]", "")], "k int, nt string, target string")
    own = [("", "AAACCCCGTTTT", x, f"NM_1.1:c.{x}") for x in ("7C>A", "9T>C", "10T>C")]
    mapping = spark.createDataFrame([*own, ("NM_7.1", None, "7C>A", "NM_7.1:c.7C>A"), ("NM_7.1", "", "8G>T", "NM_7.1:c.8G>T"), ("NM_7.1", "", "9T>C", "NM_7.1:c.9T>C"), ("NM_7.1", "", "12T>A", "NM_7.1:c.12+1T>A")], "accession string, target string, component string, mapped_c string")
    out = M.rewrite_haplotypes(df, mapping, "nt", "target")
    assert out.columns == ["k", "orig_raw_hgvs_nt", "nt", "target"]
    got = dict(rows(out, "k", "nt"))
    # 6: the base between is not known; 7: a component is not mapped to a plain substitution; 8: no target sequence
    assert got == {1: "c.7_9delinsAGC", 2: "c.[7C>A;10T>C]", 3: "c.7C>A", 4: None, 5: "NM_7.1:c.7_8delinsAT", 6: "NM_7.1:c.[7C>A;9T>C]", 7: "NM_7.1:c.[7C>A;12T>A]", 8: "c.[7C>A;9T>C]"}
    assert dict(rows(out, "k", "orig_raw_hgvs_nt")) == dict(rows(df, "k", "nt"))


def test_upsert_and_errors(spark):
    a = spark.createDataFrame([(1, "1", "old"), (2, "2", "kept")], "o int, k string, v string")
    b = spark.createDataFrame([(1, "1", "new"), (2, "3", "added")], "o int, k string, v string")
    out = T.replace_rows([a, b], ["k"], "o").orderBy("_place")
    assert [(r.k, r.v) for r in out.collect()] == [("1", "new"), ("2", "kept"), ("3", "added")]
    with pytest.raises(ValueError):
        T.replace_rows([a, b.drop("v")], ["k"], "o")
    with pytest.raises(ValueError):
        T.filter_columns(a, keep=["nope"])
    with pytest.raises(ValueError):
        T.reorder_columns(a, [])


def test_merge_misses_are_blank(spark):
    base = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    extra = spark.createDataFrame([(" 1 ", "1.5", 1), ("3", "9", 2)], "key string, score string, o int")
    assert sorted(r.score for r in T.merge_columns(base, extra, ["id"], ["key"], ["score"], order="o").collect()) == ["", "", "1.5"]


ORDERS = "/root/testdata/sf0.1/orders.parquet"
SETTINGS = [{}, {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}, {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}]


@pytest.fixture(params=SETTINGS, ids=["default", "64 small", "64 apart"])
def settings(spark, request):
    before = {k: spark.conf.get(k) for k in request.param}
    for k, v in request.param.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_dense_ids_of_wide_rows(spark, settings):
    df = spark.read.parquet(ORDERS)
    for d in (df, df.groupBy("o_orderkey").agg(*(F.first(c).alias(c) for c in df.columns if c != "o_orderkey"))):
        ids = T.with_row_id(d, ["o_orderkey"])
        n = df.count()
        got = ids.agg(F.count("*"), F.countDistinct("_row_id"), F.min("_row_id"), F.max("_row_id"), F.countDistinct("o_orderkey")).first()
        assert tuple(got) == (n, n, 0, n - 1, n)
        pairs = ids.select("_row_id", "o_orderkey").toPandas().sort_values("_row_id")
        assert pairs["o_orderkey"].is_monotonic_increasing
    assert T.with_row_id(df.limit(0), ["o_orderkey"]).count() == 0


def test_runs_over_partitions(spark, settings):
    d = spark.read.parquet(ORDERS).select("o_orderkey", "o_orderpriority", "o_orderstatus").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 11 > 0, F.substring("o_orderpriority", 1, 1)))
    for within in (None, ["o_orderstatus"]):
        got = T.contiguous_runs(d, "o_orderpriority", "o_orderkey", within).toPandas().sort_values([*(within or []), "o_orderkey"])
        keys = got["o_orderpriority"].fillna("")
        for _, g in got.assign(k=keys).groupby("o_orderstatus") if within else [(0, got.assign(k=keys))]:
            want = (g["k"] != g["k"].shift()).cumsum()
            assert (g["run"] == want).all()
    assert T.contiguous_runs(d.limit(0), "o_orderpriority", "o_orderkey").count() == 0


def test_calibration_behind_a_shuffle(spark, settings):
    df = spark.read.parquet(ORDERS).groupBy("o_orderkey").agg(F.first("o_orderdate").alias("o_orderdate"), F.first("o_custkey").alias("c"))
    df = df.select("*", F.concat(F.lit("s"), (F.col("o_orderkey") % 50).cast("string"), F.lit("#"), F.col("o_orderkey").cast("string")).alias("urn"), (F.col("o_orderkey") % 1000).cast("string").alias("score"))
    cals = spark.createDataFrame([(f"s{i}", 0, f"c{i}", f"t{i}", i % 2 == 0, True, False) for i in range(50)], "score_set string, ordinal int, calibration string, title string, `primary` boolean, investigator boolean, research_only boolean")
    ranges = spark.createDataFrame([(f"c{i}", k, "low" if k == 0 else "high", None if k == 0 else 10.0 * i, 10.0 * i if k == 0 else None, None, None) for i in range(50) for k in (0, 1)], "calibration string, ordinal int, label string, low double, high double, low_in boolean, high_in boolean")
    out = A.annotate_calibration(df, cals, ranges, "urn", "score", "m", "http://x")
    i = F.col("o_orderkey") % 50
    want = F.when(F.col("o_orderkey") % 1000 < 10 * i, "low").otherwise("high")
    ok = (F.col("`m.primary_calibration.functional_class`") == want) & (F.col("`m.investigator_provided_calibration.functional_class`") == want) & (F.col("`m.primary_calibration.name`") == F.concat(F.lit("t"), i.cast("string")))
    assert out.count() == df.count() and out.filter(~ok).count() == 0


def test_steps_behind_a_shuffle(spark, settings):
    """Rows without a key: ids are staged, so that both branches of a step see the same."""
    df = spark.read.parquet(ORDERS).groupBy("o_orderkey").agg(F.first("o_comment" if "o_comment" in spark.read.parquet(ORDERS).columns else "o_orderpriority").alias("x"))
    df = df.select("o_orderkey", "x", *(F.concat(F.lit(p), F.col("o_orderkey").cast("string"), F.lit("||"), F.lit(p), (F.col("o_orderkey") + 1).cast("string")).alias(n) for n, p in (("h", "H:"), ("v", "V"), ("i", "C"))))
    e = spark.read.parquet(ORDERS).select(F.col("o_orderkey").alias("record"), F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("uuid"), F.array(F.concat(F.lit("H:"), F.col("o_orderkey").cast("string"))).alias("hgvs"), F.lit("").alias("variation_id"), F.lit("").alias("caid"))
    out = A.annotate_evidence(df, e, "h", "v", "i", ["uuid"])
    keys = e.select("record")
    next_ = F.when(F.col("record").isNotNull(), F.concat(F.lit("u"), (F.col("o_orderkey") + 1).cast("string"))).otherwise("")
    want = out.join(keys, F.col("record") == F.col("o_orderkey") + 1, "left").withColumn("want", F.concat(F.lit("u"), F.col("o_orderkey").cast("string"), F.lit("||"), next_))
    assert out.count() == df.count() and want.filter("`clingen_evidence_repository.uuid` <> want").count() == 0


def test_blank_keys_are_dealt_out(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        long = spark.range(100_000).select(F.col("id").alias("_row_id"), F.lit(0).alias("_slot"), F.lit("").alias("k"))
        table = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
        n = S.lookup(long, table, ["k"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(n) == 64 and max(r["count"] for r in n) < 2500
    finally:
        for k, v in {"spark.sql.adaptive.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": before, "spark.sql.shuffle.partitions": "4"}.items():
            spark.conf.set(k, v)


def test_chain_equals_single_annotations(spark):
    df = spark.createDataFrame([(1, "CA1||CA2", "NC_000001.11:g.5A>G|", "NM_1.1:c.7del"), (2, None, "", "a|b|c|d"), (3, "CA2", "x", "")], "k int, ids string, g string, c string")
    bridge = spark.createDataFrame([("CA1", "401", "1"), ("CA2", "402", "2")], "caid string, variation_id string, allele_id string")
    summary = spark.createDataFrame([("1", "Benign", "practice guideline", "")], "allele_id string, clinical_significance string, review_status string, last_review_date string")
    revel = spark.createDataFrame([("1", 5, "A", "G", "0.5")], "chrom string, pos long, ref string, alt string, score string")
    from varspark.operators import coordinates as C
    from varspark.plans.pipeline import pipeline

    steps = [*C.coordinate_steps("g", "c", "ids"), A.clinvar_step(bridge, summary, "ids"), A.missense_step(revel=revel, g_col="g")]
    chained = pipeline(df, steps, key=["k"])
    single = C.add_coordinates(df, "g", "c", "ids")
    single = A.annotate_missense(A.annotate_clinvar(single, bridge, summary, "ids"), revel=revel, g_col="g")
    assert chained.columns == single.columns
    assert sorted(map(str, chained.collect())) == sorted(map(str, single.collect()))
    assert rows(chained, "k", "g_start", "`revel.score`") == [(1, "5|", "0.5000|"), (2, "", ""), (3, "", "")]


def test_argmax_keeps_the_first_of_ties(spark):
    df = spark.createDataFrame([("a", 0.5, 1, "x"), ("a", 0.5, 2, "y"), ("a", float("nan"), 3, "z")], "k string, s double, line long, c string")
    out = R.argmax(df, ["k"], "s", "line", "c")
    assert rows(out, "k", "s", "c") == [("a", 0.5, "x")]


def test_text_sources(spark, tmp_path):
    p = tmp_path / "in.tsv"
    p.write_text('a\tb\n1\t"say ""hi"""\n\t2\n')
    df = io.read_table(spark, str(p))
    assert rows(df, "a", "b") == [("", "2"), ("1", 'say "hi"')]
    io.write_table(df, str(tmp_path / "out.tsv"), single=True)
    assert rows(io.read_table(spark, str(tmp_path / "out.tsv"), "\t"), "a", "b") == rows(df, "a", "b")
    s = tmp_path / "sum.txt"
    s.write_text("#AlleleID\tClinicalSignificance\tReviewStatus\tLastEvaluated\tAssembly\n1\tBenign\t-\t-\tGRCh38\n1\tPathogenic\tx\t-\tGRCh38\n2\tBenign\t-\t-\tGRCh37\n\tB\t-\t-\tGRCh38\n")
    assert rows(io.read_clinvar_summary(spark, str(s)), "allele_id", "clinical_significance", "review_status") == [("1", "Pathogenic", "x")]
    v = tmp_path / "a.vcf"
    v.write_text("##x\n#CHROM\tPOS\n1\t5\t.\tA\tG\t.\t.\tSpliceAI=G|X|0.1|0|0|0|1|2|3|4\n")
    assert rows(io.read_spliceai_vcf(spark, [str(v)]), "file_rank", "chrom", "pos") == [(0, "1", 5)]
    d = tmp_path / "db.tsv"
    d.write_text("#chr\tpos(1-based)\tref\talt\tMutPred2_score\n1\t5\tA\tG\t0.1;0.2\n")
    assert rows(io.read_dbnsfp(spark, str(d)), "chrom", "pos", "mutpred2_score") == [("1", 5, "0.1;0.2")]
    c = tmp_path / "cal.json"
    c.write_text('{"score_set":"s","calibrations":[{"urn":"u","title":"t","primary":true,"functionalClassifications":[{"id":1,"label":"low","range":[null,0.5]}]}]}')
    cals, ranges = io.read_calibrations(spark, str(c))
    out = A.annotate_calibration(spark.createDataFrame([("s#1", "0.2")], "urn string, score string"), cals, ranges, "urn", "score", "m", "http://x")
    assert rows(out, *(f"`m.primary_calibration.{k}`" for k in ("urn", "name", "url", "functional_class"))) == [("u", "t", "http://x/score-sets/s", "low")]
    g = tmp_path / "given.json"
    g.write_text('{"calibration":"u","classes":[{"functionalClassificationId":1,"variants":[{"urn":"s#1"},{"urn":null}]},{"functionalClassificationId":null,"variants":[{"urn":"s#2"}]},{"functionalClassificationId":2,"variants":[{"urn":"s#1"}]}]}\n')
    assert rows(io.read_assignments(spark, str(g)), "calibration", "urn", "class_id") == [("u", "s#1", 2)]
    c.write_text('{"score_set":"s","calibrations":[{"urn":"u","title":"t","primary":true,"functionalClassifications":[{"id":1,"label":"one"},{"id":2,"label":"two"}]}]}')
    cals, ranges = io.read_calibrations(spark, str(c))
    given = io.read_assignments(spark, str(g))
    out = A.annotate_calibration(spark.createDataFrame([("s#1", "0.2"), ("s#2", "0.2"), (None, None)], "urn string, score string"), cals, ranges, "urn", "score", "m", "http://x", given)
    assert rows(out.filter("urn is not null"), "urn", "`m.primary_calibration.functional_class`", "`m.investigator_provided_calibration.urn`") == [("s#1", "two", ""), ("s#2", "", "")]
    am = tmp_path / "am.tsv"
    am.write_text("# x\n#CHROM\tPOS\nchr1\t5\tA\tG\thg38\tP1\tT1\tV\t0.25\tbenign\n")
    assert rows(io.read_alphamissense(spark, str(am)), "chrom", "pos", "score", "class") == [("chr1", 5, "0.25", "benign")]
    e = tmp_path / "repo.tsv"
    e.write_text('Uuid\tNote\n u1 \t"two words"\nu2\t\n')
    assert rows(io.read_evidence(spark, str(e)).na.fill(""), "Uuid", "Note") == [("u1", "two words"), ("u2", "")]
    e.write_text('Uuid\tNote\nu1\t"two\nlines"\n')
    assert rows(io.read_evidence(spark, str(e), multiline=True), "Uuid", "Note") == [("u1", "two\nlines")]
    r = tmp_path / "registry.json"
    r.write_text('{"@id":"http://x/CA5","genomicAlleles":[{"referenceGenome":"GRCh38","chromosome":"3","coordinates":[{"start":6,"end":7,"referenceAllele":"A","allele":"C"}],"hgvs":["NC_000003.12:g.7A>C"]}],"externalRecords":{"ClinVarVariations":[{"variationId":"9"}]}}\n{"@id":"_:CA"}\n')
    assert rows(io.read_registry(spark, str(r)).na.fill("").na.fill(0), "id", "chrom", "pos", "g", "clinvar_variation") == [("", "", 0, "", ""), ("CA5", "chr3", 7, "NC_000003.12:g.7A>C", "9")]
    f = spark.createDataFrame([("CA1", 3)], "CAID string, ac long")
    f.write.parquet(str(tmp_path / "caid"))
    assert rows(io.read_frequency_table(spark, str(tmp_path / "caid")), "caid", "ac") == [("CA1", 3)]
    d.write_text("#chr\tpos(1-based)\tref\talt\n1\t5\tA\tG\n")
    with pytest.warns(UserWarning, match="MutPred2_score"):
        assert io.read_dbnsfp(spark, str(d)) is None


def test_sink_orders(spark, tmp_path):
    df = spark.range(50).select(F.col("id").alias("_row_id"), (F.col("id") * 2).cast("string").alias("v")).repartition(5)
    for mode in ("no", "index", "groups"):
        io.write_table(df, str(tmp_path / mode), ",", preserve_order=mode, single=True)
    text = ["v", *(str(2 * i) for i in range(50))]
    one = lambda mode: next((tmp_path / mode).glob("part*")).read_text().split()
    assert one("index") == text and one("groups") == text and sorted(one("no")) == sorted(text)
    with pytest.raises(ValueError):
        io.write_table(df, str(tmp_path / "x"), preserve_order="other")
    with pytest.raises(ValueError):
        io.write_table(df.drop("_row_id"), str(tmp_path / "x"), preserve_order="index")


def test_protein_forms(spark):
    for text, want in {"NP_1.1:p.Leu5=": ("5", "5", "L", "L"), "p.(Leu5_Pro7dup)": ("5", "7", "L_P", "L_PL_P"), "p.Leu5fs": ("5", "5", "L", "fs"), "p.Leu5": ("5", "5", "L", None), "p.Leu5_Pro7insAla": ("5", "7", None, None), "p.Leu5delinsPro": ("5", "5", "L", "P"), "p.?": (None,) * 4, None: (None,) * 4}.items():
        assert tuple(value(spark, X.parse_protein(F.lit(text).cast("string")))) == want


def test_only_stages_where_folders_are_shared(spark, monkeypatch):
    from varspark import staging

    class Other:
        master = "spark://x"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Other
        conf = spark.conf

    monkeypatch.setattr(type(spark.conf), "get", lambda self, k, d=None: d)
    with pytest.raises(RuntimeError):
        staging.shared_dir(Session)



def test_frequency_cache(spark, tmp_path):
    df = spark.createDataFrame([("1", 5, "A", "G", 1), ("2", 6, "A", "G", 2)], "chrom string, pos long, ref string, alt string, allele_count long")
    io.write_frequency_cache(df, str(tmp_path / "f"))
    assert io.read_frequency_table(spark, str(tmp_path / "f")).count() == 2
    with pytest.raises(Exception):
        io.write_frequency_cache(df, str(tmp_path / "f"))


def test_frequency_cache_is_read_by_block(spark, tmp_path):
    path = str(tmp_path / "f")
    n = 40
    freq = spark.range(n * 3).select(F.concat(F.lit("chr"), (F.col("id") % 3 + 1).cast("string")).alias("chrom"), (F.floor(F.col("id") / 3) * (1 << 20) + 7).alias("pos"), F.lit("A").alias("ref"), F.lit("G").alias("alt"), F.lit(5).cast("long").alias("allele_count"), F.lit(10).cast("long").alias("allele_number"), F.lit(0.5).alias("faf95_max"), F.lit("x").alias("faf95_max_ancestry"))
    io.write_frequency_cache(freq.withColumn("chrom", F.regexp_replace("chrom", "chr", "")), path)
    rows = spark.createDataFrame([(1, "chr2|3", f"{7 + (1 << 20)}|9"), (2, "", ""), (3, None, "x"), (4, "9", "7")], "k int, c string, p string").withColumns({"r": F.lit("A|A"), "a": F.lit("G|G")})
    scan = io.read_frequency_cache(spark, path, A.wanted_places(rows, "c", "p"))
    assert {(r.chrom, r.pos) for r in scan.collect()} == {("2", 7 + (1 << 20)), ("3", 7)}
    files = scan._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get("numFiles").get().value()
    assert files == 2 and io.read_frequency_cache(spark, path).count() == 3 * n
    got = {r.k: r["gnomad.v4_1.allele_count"] for r in A.annotate_frequency_from_cache(rows, path, coordinates=("c", "p", "r", "a"), key=["k"]).collect()}
    assert got == {1: "5|", 2: "", 3: "", 4: ""} or {k: v.rstrip("|") for k, v in got.items()} == {1: "5", 2: "", 3: "", 4: ""}
    assert io.read_frequency_cache(spark, path, A.wanted_places(rows.limit(0), "c", "p")).count() == 0


@pytest.mark.parametrize("prepared", [False, True])
def test_bases_across_chunks(spark, prepared):
    """Short and long spans against the whole sequence; one exchange a side for short ones."""
    seq = "".join("ACGT"[(i * i + i // 3) % 4] for i in range(437))
    chunks = spark.createDataFrame([(a, k, seq[50 * k : 50 * k + 50]) for a in "xy" for k in range(9) if (a, k) != ("y", 4)], "accession string, chunk long, seq string")
    spans = [("x", s, s + n) for s in (1, 2, 49, 50, 51, 100, 380, 437) for n in (0, 1, 19, 20, 21, 49, 50, 120)] + [("y", 195, 200), ("y", 195, 201), ("y", 150, 260), ("z", 1, 2), (None, 1, 2), ("x", None, 2), ("x", 5, 4), ("x", 0, 3)]
    df = spark.createDataFrame(spans, "accession string, start long, stop long")
    table = M.overlapping(chunks, 50, 20) if prepared else chunks
    for extra in (df, df.select(F.monotonically_increasing_id().alias(S.ROW), F.lit(0).alias(S.SLOT), "*")):  # long spans with and without a slot's number
        got = {(r.accession, r.start, r.stop): r.bases for r in M.bases_of(extra, "accession", F.col("start"), F.col("stop"), table, 50, 20).collect()}
        assert len(got) == len(set(spans))
        for (a, s, e), b in got.items():
            whole = a in ("x", "y") and s is not None and 1 <= s <= e <= len(seq) and not (a == "y" and s <= 250 and e > 200)
            assert b == (seq[s - 1 : e] if whole else None), (a, s, e)


def test_blank_names_meet_no_key(spark):
    """Blank keys of the mapping joins spread over all partitions."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(64_000).select("id", F.when(F.col("id") % 10 == 0, F.concat(F.lit("t"), (F.col("id") % 7).cast("string"))).otherwise(" ").alias("name"), F.lit("").alias("seq"))
        targets = spark.createDataFrame([(f"t{i}", f"S{i}") for i in range(7)], "name string, seq string")
        joined = M.join_targets(rows, targets, "name", ["seq"])
        sizes = [r["count"] for r in joined.filter(F.trim("name") == "").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 32 and max(sizes) < 1.3 * sum(sizes) / 32
        assert joined.filter("seq = concat('S', substring(name, 2, 1))").count() == 6400
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_worklist_state_over_many_batches(spark, tmp_path):
    """Each key once over many batches, and a stopped stream goes on where it was."""
    from varspark.streaming.files import worklist_stream

    source, sink, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    cache = lambda: spark.createDataFrame([("k3", True, "2024-06-01")], "key string, found boolean, fetched_at string")
    for part in range(2):
        for i in range(6):
            keys = [(f" k{(7 * part + i * 2 + j) % 15} ",) for j in range(5)] + [("",), (None,)]
            spark.createDataFrame(keys, "key string").coalesce(1).write.mode("append").parquet(source)
        worklist_stream(spark, source, "key string", cache, F.lit("2024-06-30"), sink, state, max_files=1).awaitTermination()
    asked = [r.key for r in spark.read.schema("key string, batch int").parquet(sink).collect()]
    assert len(asked) == len(set(asked)) and set(asked) == {f"k{i}" for i in range(15)} - {"k3"}
    assert spark.read.schema("key string, batch int").parquet(sink).select("batch").distinct().count() > 3


def test_prefix_violation_names_the_line(spark):
    df = spark.createDataFrame([(0, "CA1", "c.1A>G"), (1, "PA1", "c.1A>G")], "row int, id string, nt string")
    with pytest.raises(ValueError, match="row 3"):
        M.validate_id_prefix(df, "id", "nt", "row")


def test_earlier_results_of_several_tables(spark):
    first = spark.createDataFrame([(5, "c.1A>G", "", "G1"), (6, "c.2A>G", "", "")], "line int, nt string, pro string, mapped_hgvs_g string")
    bare = spark.createDataFrame([(1, "c.1A>G", "wrong")], "line int, nt string, mapped_hgvs_g string")  # no pro: passed over
    last = spark.createDataFrame([("c.1A>G", "", "late", "c", 1), ("c.2A>G", "", "G2", "c", 2)], "nt string, pro string, mapped_hgvs_g string, mapped_hgvs_c string, line int")
    mapped = ("mapped_hgvs_g", "mapped_hgvs_c")
    old = M.earlier_results([bare, first, last], "line", ["nt", "pro"], mapped)
    hit, rest = M.reuse_existing(spark.createDataFrame([(" c.1A>G", ""), ("c.2A>G", None), ("c.3A>G", "")], "nt string, pro string"), old, "_order", "nt", "pro", mapped=mapped)
    assert rows(hit, "nt", *mapped) == [(" c.1A>G", "G1", ""), ("c.2A>G", "G2", "c")] and rest.count() == 1
    assert M.earlier_results([bare], "line", ["nt", "pro"], mapped) is None


def test_short_spans_take_one_exchange_a_side(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chunks = spark.range(50).select(F.lit("x").alias("accession"), F.col("id").alias("chunk"), F.repeat(F.lit("A"), 200).alias("seq"), F.lit(100).alias("overlap"))
        df = spark.range(1000).select(F.concat(F.lit("x"), F.lit("")).alias("accession"), (F.col("id") + 1).alias("a"), (F.col("id") + 5).alias("b"))
        found = M.bases_of(df, "accession", F.col("a"), F.col("b"), chunks, 100)
        plan = found._jdf.queryExecution().optimizedPlan().children().head()  # the short spans' branch of the union
        assert found.filter("bases = 'AAAAA'").count() == 1000
        assert plan.toString().count("Join") == 1 and "Aggregate" not in plan.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fmt4_is_the_format(spark):
    import random

    rng = random.Random(3)
    values = [0.0, -0.0, 0.00005, -0.00005, -0.00004, 0.12345, 0.99995, 1e8, -1e8, 1e12, 123456.78905, -0.0001, -0.00011, 2.5e-5, 1.00005, float("inf"), float("-inf"), float("nan"), None, 1e-300]
    values += [rng.uniform(-1, 1) for _ in range(3000)] + [rng.randint(-10**6, 10**6) / 10**rng.randint(1, 6) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", X.fmt4(F.col("v")).alias("a"), F.format_string("%.4f", "v").alias("b")).collect()
    assert all(r.a == (None if r.v is None else r.b) for r in got)


def test_casts_without_exceptions(spark):
    values = ["5", " 7 ", "+3", "-2", "", " ", ".", "x", "1.5", "1e3", "NaN", "-inf", "Infinity", "12345678901234567890123", "0x1", "1d", None, "\t4\n"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for ours, kind in ((X.to_long, "long"), (X.to_double, "double")):
        for r in df.select("v", ours(F.col("v")).alias("a"), F.col("v").try_cast(kind).alias("b")).collect():
            assert str(r.a) == str(r.b), (kind, r.v)
