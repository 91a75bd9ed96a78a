"""Aggregates that pick or merge: scores by allele, consensus, severity, ordered distinct text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import to_double

# Consequence terms, the most severe first.
SEVERITY = """transcript_ablation splice_acceptor_variant splice_donor_variant stop_gained frameshift_variant stop_lost start_lost
transcript_amplification feature_elongation feature_truncation inframe_insertion inframe_deletion missense_variant
protein_altering_variant splice_donor_5th_base_variant splice_region_variant splice_donor_region_variant
splice_polypyrimidine_tract_variant incomplete_terminal_codon_variant start_retained_variant stop_retained_variant
synonymous_variant coding_sequence_variant mature_miRNA_variant 5_prime_UTR_variant 3_prime_UTR_variant
non_coding_transcript_exon_variant intron_variant NMD_transcript_variant non_coding_transcript_variant coding_transcript_variant
upstream_gene_variant downstream_gene_variant TFBS_ablation TFBS_amplification TF_binding_site_variant
regulatory_region_ablation regulatory_region_amplification regulatory_region_variant intergenic_variant sequence_variant""".split()

ALLELE = ["chrom", "pos", "ref", "alt"]


def number(c: Column) -> Column:
    """A number, or null for text and NaN."""
    v = to_double(c)
    return F.when(~F.isnan(v), v)


def max_score(scores: DataFrame, score: str = "score") -> DataFrame:
    """The largest score of each allele; rows with a bare chromosome name come before those with ``chr`` as a block."""
    rows = scores.withColumn("_s", number(F.col(score))).filter("_s is not null")
    rows = rows.withColumn("_rank", F.col("chrom").startswith("chr").cast("int")).withColumn("chrom", F.regexp_replace("chrom", "^chr", ""))
    best = rows.groupBy(*ALLELE).agg(F.min(F.struct("_rank", F.negative("_s").alias("_n"))).alias("_b"))
    return best.select(*ALLELE, F.negative(F.col("_b._n")).alias("score"))


def argmax(scores: DataFrame, keys: list[str], score: str, line: str, label: str) -> DataFrame:
    """The largest score of each key with its label; the earliest line on ties."""
    rows = scores.withColumn("_s", number(F.col(score))).filter("_s is not null")
    best = rows.groupBy(*keys).agg(F.max(F.struct("_s", F.negative(line).alias("_l"), F.col(label).alias("label"))).alias("_b"))
    return best.select(*keys, F.col("_b._s").alias(score), F.col("_b.label").alias(label))


def consensus(values: Column) -> Column:
    """struct(value, differs) of an array: its only non-empty value, or empty."""
    known = F.array_distinct(F.filter(values, lambda x: F.coalesce(x, F.lit("")) != ""))
    return F.struct(F.when(F.size(known) == 1, F.get(known, F.lit(0))).otherwise("").alias("value"), (F.size(known) > 1).alias("differs"))


def severity_rank(term: Column) -> Column:
    """Place in the severity list; null for unknown terms."""
    return F.nullif(F.array_position(F.array(*map(F.lit, SEVERITY)), term), F.lit(0).cast("long"))


def most_severe(df: DataFrame, keys: list[str], term: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(F.col(term), severity_rank(F.col(term))).alias(term))


def ordered_distinct_concat(order: Column, value: Column) -> Column:
    """An aggregate: distinct values by first appearance, joined by `` | ``; a blank is a value."""
    got = F.array_sort(F.collect_list(F.struct(order.alias("o"), F.coalesce(value, F.lit("")).alias("v"))))
    return F.array_join(F.array_distinct(F.transform(got, lambda x: x["v"])), " | ")


def rank_pick(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(*order)).alias(value))


def frequency(ac: Column, an: Column) -> Column:
    """struct(af, maf); null where the allele number is not positive."""
    af = ac / an
    return F.when(an > 0, F.struct(af.alias("af"), F.least(af, 1 - af).alias("maf")))
