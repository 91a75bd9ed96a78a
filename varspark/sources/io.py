"""Sources and sinks: delimited tables with text columns, score files, registry and calibration documents."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import CHROMOSOMES, dash_to_blank, registry_id, to_long, trim_key
from ..operators.tables import ROW, last_wins


def separator(path: str) -> str:
    return "\t" if path.removesuffix(".gz").endswith((".tsv", ".txt")) else ","


def read_table(spark: SparkSession, path: str, sep: str | None = None, multiline: bool = False) -> DataFrame:
    """A delimited table with a header: all columns text, empty cells empty (never null), doubled quotes read.  Files are split
    among tasks unless cells may hold line breaks (``multiline``)."""
    df = spark.read.csv(path, sep=sep or separator(path), header=True, quote='"', escape='"', multiLine=multiline, inferSchema=False)
    if not df.columns:
        raise ValueError(f"{path} has no header")
    return df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns))


def write_table(df: DataFrame, path: str, sep: str | None = None, preserve_order: str = "groups", single: bool = False) -> None:
    """Writes text; in one file only if ``single``.  ``preserve_order``: "no" writes rows as they come, "index" and "groups" in
    the order of their ids, for which a row id must be there; groups keep the place of their rows."""
    if preserve_order not in ("no", "index", "groups"):
        raise ValueError("preserve_order is no, index or groups")
    if preserve_order == "index" and ROW not in df.columns:
        raise ValueError(f"no column {ROW} to order by")
    out = df.orderBy(ROW) if preserve_order != "no" and ROW in df.columns else df
    out = out.drop(ROW).coalesce(1) if single else out.drop(ROW)
    out.write.csv(path, sep=sep or separator(path), header=True, quote='"', escape='"', emptyValue="", nullValue="", mode="errorifexists")


def read_in_order(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """Rows with the sort key of their place: file, block, line of the scan."""
    df = spark.read.csv(path, sep=sep or separator(path), header=True, quote='"', escape='"', inferSchema=False)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return df.select("*", place.alias("_place"))


def clinvar_rules(raw: DataFrame, order: str) -> DataFrame:
    """Rows of a variant summary: an id, on GRCh38 or no assembly; dashes are blanks; the last row of an id counts."""
    rows = raw.filter((trim_key(F.col("AlleleID")) != "") & trim_key(F.col("Assembly")).isin("GRCh38", ""))
    rows = rows.select(trim_key(F.col("AlleleID")).alias("allele_id"), dash_to_blank(F.col("ClinicalSignificance")).alias("clinical_significance"), dash_to_blank(F.col("ReviewStatus")).alias("review_status"), dash_to_blank(F.col("LastEvaluated")).alias("last_review_date"), F.col(order).alias("_line"))
    return last_wins(rows, ["allele_id"], "_line").drop("_line")


def read_clinvar_summary(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    return clinvar_rules(df.withColumnRenamed("#AlleleID", "AlleleID").withColumn("_line", F.monotonically_increasing_id()), "_line")


_VCF = "chrom string, pos long, id string, ref string, alt string, qual string, filter string, info string"


def read_spliceai_vcf(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Score lines of several files, in the order of the files (file_rank)."""
    out = None
    for i, p in enumerate(paths):
        one = spark.read.csv(p, sep="\t", comment="#", schema=_VCF).filter(F.col("info").isNotNull())
        one = one.select(F.lit(i).alias("file_rank"), F.monotonically_increasing_id().alias("line"), "chrom", "pos", "ref", "alt", "info")
        out = one if out is None else out.unionByName(one)
    return out


def chrom_rank(c: Column) -> Column:
    """Chromosomes in version order: 1, 2, ..., 22, X, Y, others."""
    bare = F.regexp_replace(c, "^chr", "")
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for i, n in enumerate(CHROMOSOMES, 1) for x in (n, i))), bare), F.lit(99))


def prepare_revel(rows: DataFrame) -> DataFrame:
    """Columns 1, 3, 4, 5 and 8 of rows with a position on GRCh38, sorted by chromosome and position."""
    c = rows.columns
    ok = ~trim_key(F.col(c[2])).isin("", ".")
    out = rows.filter(ok).select(F.col(c[0]).alias("chrom"), to_long(F.col(c[2])).alias("pos"), F.col(c[3]).alias("ref"), F.col(c[4]).alias("alt"), F.col(c[7]).alias("score"))
    return out.repartitionByRange(chrom_rank(F.col("chrom")), "pos").sortWithinPartitions(chrom_rank(F.col("chrom")), "pos")


def read_revel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, pos long, ref string, alt string, score string")


def read_alphamissense(spark: SparkSession, path: str) -> DataFrame:
    names = "chrom string, pos long, ref string, alt string, genome string, uniprot string, transcript string, protein string, score string, class string"
    return spark.read.csv(path, sep="\t", comment="#", schema=names).withColumn("line", F.monotonically_increasing_id())


def read_dbnsfp(spark: SparkSession, path: str) -> DataFrame | None:
    """(chrom, pos, ref, alt, mutpred2_score) by the header's names; nothing if one of them is missing."""
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    df = df.withColumnRenamed(df.columns[0], df.columns[0].lstrip("#"))
    names = {"chr": "chrom", "pos(1-based)": "pos", "ref": "ref", "alt": "alt", "MutPred2_score": "mutpred2_score"}
    missing = [c for c in names if c not in df.columns]
    if missing:
        warnings.warn(f"{path} has no column {', '.join(missing)}: no scores are read", stacklevel=2)
        return None
    return df.select(*((to_long(F.col(f"`{c}`")) if n == "pos" else F.col(f"`{c}`")).alias(n) for c, n in names.items()))


def read_evidence(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Records of an evidence repository with trimmed cells, and their place as ``record``."""
    df = spark.read.csv(path, sep="\t", header=True, multiLine=multiline, quote='"', escape='"', inferSchema=False)
    return df.select(*(trim_key(F.col(f"`{c}`")).alias(c) for c in df.columns)).withColumn("record", F.monotonically_increasing_id())


REGISTRY = """`@id` string, id string, externalRecords struct<ClinVarAlleles:array<struct<alleleId:string>>,ClinVarVariations:array<struct<variationId:string>>>,
genomicAlleles array<struct<referenceGenome:string,chromosome:string,coordinates:array<struct<start:long,`end`:long,referenceAllele:string,allele:string>>,hgvs:array<string>>>,
transcriptAlleles array<struct<hgvs:array<string>,MANE:struct<nucleotide:struct<RefSeq:struct<hgvs:string>>,protein:struct<RefSeq:struct<hgvs:string>>>,proteinEffect:struct<hgvs:string>>>,
aminoAcidAlleles array<struct<hgvs:array<string>>>"""


def registry_records(raw: DataFrame, transcript: str | None = None) -> DataFrame:
    """(id, clinvar_allele, clinvar_variation, chrom, pos, ref, alt, g, c, p) of registry documents."""
    grch38 = F.filter("genomicAlleles", lambda a: a["referenceGenome"] == "GRCh38")
    placed = F.filter(grch38, lambda a: F.exists(a["coordinates"], lambda x: (F.coalesce(x["referenceAllele"], F.lit("")) != "") & (F.coalesce(x["allele"], F.lit("")) != "")))
    a0 = F.get(placed, F.lit(0))
    x0 = F.get(F.filter(a0["coordinates"], lambda x: (F.coalesce(x["referenceAllele"], F.lit("")) != "") & (F.coalesce(x["allele"], F.lit("")) != "")), F.lit(0))
    g = F.get(F.filter(F.flatten(F.transform(grch38, lambda a: F.coalesce(a["hgvs"], F.array().cast("array<string>")))), lambda h: h.startswith("NC_")), F.lit(0))
    own = F.get(F.filter("transcriptAlleles", lambda a: F.exists(a["hgvs"], lambda h: F.substring_index(h, ":", 1) == F.lit(transcript or ""))), F.lit(0))
    mane = F.get(F.filter("transcriptAlleles", lambda a: a["MANE"].isNotNull()), F.lit(0))["MANE"]
    c = F.coalesce(F.get(F.filter(own["hgvs"], lambda h: F.substring_index(h, ":", 1) == F.lit(transcript or "")), F.lit(0)), mane["nucleotide"]["RefSeq"]["hgvs"])
    p = F.coalesce(own["proteinEffect"]["hgvs"], mane["protein"]["RefSeq"]["hgvs"], F.get(F.flatten(F.transform("aminoAcidAlleles", lambda a: a["hgvs"])), F.lit(0)))
    return raw.select(
        registry_id(F.col("`@id`"), F.col("id")).alias("id"),
        F.get(F.col("externalRecords.ClinVarAlleles"), F.lit(0))["alleleId"].alias("clinvar_allele"),
        F.get(F.col("externalRecords.ClinVarVariations"), F.lit(0))["variationId"].alias("clinvar_variation"),
        F.concat(F.lit("chr"), a0["chromosome"]).alias("chrom"), x0["end"].alias("pos"), x0["referenceAllele"].alias("ref"), x0["allele"].alias("alt"), g.alias("g"), c.alias("c"), p.alias("p"),
    )


def read_registry(spark: SparkSession, path: str, transcript: str | None = None) -> DataFrame:
    return registry_records(spark.read.schema(REGISTRY).json(path), transcript)


def read_frequency_table(spark: SparkSession, path: str) -> DataFrame:
    """A frequency table by ``caid`` (in either case) if it has that column, else by allele."""
    df = spark.read.parquet(path)
    if {"chrom", "block"} <= set(df.columns):
        return read_frequency_cache(spark, path)
    caid = next((c for c in df.columns if c.lower() == "caid"), None)
    if caid:
        return df.withColumnRenamed(caid, "caid")
    if "locus" in df.columns:
        df = df.select("*", F.regexp_replace("locus.contig", "^chr", "").alias("chrom"), F.col("locus.position").alias("pos"), F.get("alleles", F.lit(0)).alias("ref"), F.get("alleles", F.lit(1)).alias("alt")).drop("locus", "alleles")
    return df


#: Positions of one folder of a frequency cache, and folders that a reader names one by one at most (all of a human genome are about 3,100).
CACHE_BLOCK, MOST_BLOCKS = 1 << 20, 8192


def _block(pos: Column) -> Column:
    return F.floor(pos / CACHE_BLOCK).cast("long")


def write_frequency_cache(df: DataFrame, path: str, refresh: bool = False) -> None:
    """By chromosome and block of positions, sorted by position within files: readers open the blocks they need only."""
    out = df.withColumn("block", _block(F.col("pos"))).repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")
    out.write.partitionBy("chrom", "block").parquet(path, mode="overwrite" if refresh else "errorifexists")


def read_frequency_cache(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """A frequency cache; with ``wanted`` (chrom, pos) only the blocks that hold one of these places, by partition pruning.  The driver gets
    the wanted blocks' names, up to ``MOST_BLOCKS``; of a table that needs more everything is read."""
    df = spark.read.parquet(path)
    df = df.withColumn("chrom", F.col("chrom").cast("string"))
    if wanted is None or "block" not in df.columns:
        return df.drop("block")
    blocks = wanted.select(F.regexp_replace(F.col("chrom").cast("string"), "^chr", "").alias("chrom"), _block(F.col("pos")).alias("block")).filter("chrom <> '' and block is not null").distinct()
    found = blocks.limit(MOST_BLOCKS + 1).collect()
    if len(found) > MOST_BLOCKS:
        return df.drop("block")
    by: dict[str, list[int]] = {}
    for r in found:
        by.setdefault(r.chrom, []).append(r.block)
    some = F.lit(False)
    for chrom, numbers in by.items():
        some = some | (F.col("chrom").isin(chrom, f"chr{chrom}") & F.col("block").isin(sorted(numbers)))
    return df.filter(some).drop("block")


CALIBRATIONS = "score_set string, calibrations array<struct<urn:string,title:string,`primary`:boolean,investigatorProvided:boolean,researchUseOnly:boolean,functionalClassifications:array<struct<id:int,label:string,range:array<double>,inclusiveLowerBound:boolean,inclusiveUpperBound:boolean>>>>"


def read_calibrations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(calibrations, ranges) as the calibration joins take them."""
    one = spark.read.schema(CALIBRATIONS).json(path).select("score_set", F.posexplode("calibrations").alias("ordinal", "c"))
    flags = {"primary": "primary", "investigator": "investigatorProvided", "research_only": "researchUseOnly"}
    cals = one.select("score_set", "ordinal", F.col("c.urn").alias("calibration"), "c.title", *(F.coalesce(F.col(f"c.`{v}`"), F.lit(False)).alias(k) for k, v in flags.items()))
    r = one.select(F.col("c.urn").alias("calibration"), F.posexplode("c.functionalClassifications").alias("ordinal", "r"))
    bound = lambda i: F.get("r.range", F.lit(i))
    ranges = r.select("calibration", "ordinal", "r.id", "r.label", bound(0).alias("low"), bound(1).alias("high"), F.col("r.inclusiveLowerBound").alias("low_in"), F.col("r.inclusiveUpperBound").alias("high_in"), F.col("r.range").isNotNull().alias("ranged"))
    return cals, ranges


ASSIGNMENTS = "calibration string, classes array<struct<functionalClassificationId:int,variants:array<struct<urn:string>>>>"


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """(calibration, urn, class_id) of class-based calibrations: the last assignment of a variant counts; entries without a class
    id or an urn are passed over."""
    one = spark.read.schema(ASSIGNMENTS).json(path).select("calibration", F.posexplode("classes").alias("_i", "c"))
    v = one.filter("c.functionalClassificationId is not null").select("calibration", "_i", F.col("c.functionalClassificationId").alias("class_id"), F.explode("c.variants.urn").alias("urn"))
    return v.filter("urn <> ''").groupBy("calibration", "urn").agg(F.max_by("class_id", "_i").alias("class_id"))
