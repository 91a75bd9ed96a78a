"""Preparation of a frequency table: filters and projection by the paths that its schema has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Paths that may hold a field, the first that exists counts.
PATHS = {
    "allele_count": ["joint.freq.all.ac", "joint.freq.ac", "freq.all.ac", "freq.ac", "allele_count", "ac"],
    "allele_number": ["joint.freq.all.an", "joint.freq.an", "freq.all.an", "freq.an", "allele_number", "an"],
    "faf95_max": ["joint.fafmax.faf95_max", "fafmax.faf95_max", "faf95_max"],
    "faf95_max_ancestry": ["joint.fafmax.faf95_max_gen_anc", "fafmax.faf95_max_gen_anc", "faf95_max_ancestry"],
}


def find_path(schema: T.StructType, path: str) -> Column | None:
    """A column for ``path`` (any case; the first element of arrays on the way), or nothing."""
    kind, out = schema, None
    for part in path.split("."):
        if isinstance(kind, T.ArrayType):
            kind, out = kind.elementType, F.get(out, F.lit(0))
        field = next((f for f in kind.fields if f.name.lower() == part.lower()), None) if isinstance(kind, T.StructType) else None
        if field is None:
            return None
        out = F.col(f"`{field.name}`") if out is None else out.getField(field.name)
        kind = field.dataType
    return out


def _clear(c: Column, kind: T.DataType) -> Column:
    return ~F.coalesce(c, F.lit(False)) if isinstance(kind, T.BooleanType) else F.coalesce(F.size(c), F.lit(0)) <= 0


def pass_filter(df: DataFrame) -> DataFrame:
    """Rows that passed: by ``filters`` at the top, else by those of exome or genome data that are there; all without any."""
    top = next((f for f in df.schema if f.name == "filters"), None)
    if top is not None:
        return df.filter(_clear(F.col("filters"), top.dataType))
    test = None
    for part in ("exome", "genome"):
        c = find_path(df.schema, f"{part}.filters")
        if c is not None:
            kind = df.schema[part].dataType["filters"].dataType
            one = c.isNotNull() & _clear(c, kind)
            test = one if test is None else test | one
    return df if test is None else df.filter(test)


def gene_filter(df: DataFrame, genes: list[str], path: str = "vep.transcript_consequences") -> DataFrame:
    """Rows with a consequence in one of ``genes``; all rows where the table has no consequences."""
    c = find_path(df.schema, path)
    return df if c is None else df.filter(F.coalesce(F.exists(c, lambda x: x["gene_symbol"].isin(genes)), F.lit(False)))


def project_frequency(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the frequency fields; the counts must be there, and filter sets are sorted text."""
    found = {k: next((c for p in paths if (c := find_path(df.schema, p)) is not None), None) for k, paths in PATHS.items()}
    if found["allele_count"] is None or found["allele_number"] is None:
        raise ValueError("the table has no allele count or number")
    kinds = {"allele_count": "long", "allele_number": "long", "faf95_max": "double", "faf95_max_ancestry": "string"}
    out = [(c if c is not None else F.lit(None)).cast(kinds[k]).alias(k) for k, c in found.items()]
    filters = next((f for f in df.schema if f.name == "filters"), None)
    if filters is not None and isinstance(filters.dataType, T.ArrayType):
        out.append(F.array_join(F.sort_array("filters"), "|").alias("filters"))
    return df.select(*keep, *out)


def prepare_frequency(df: DataFrame, keep: list[str], genes: list[str] | None = None) -> DataFrame:
    """Filtered and projected, in this order, so that both filters stand right above the scan."""
    return project_frequency(pass_filter(gene_filter(df, genes) if genes else df), keep)
