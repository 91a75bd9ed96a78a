"""The reference reaches as far as the keys of a larger table do."""

import duckdb
import pytest

from varspark.queries import oracle_sql, queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["H6_genomic_haplotype", "H11_vcf_anchor", "H12_fill_missing_ref"])
def test_bases_behind_the_first_chunks(spark, tmp_path, name):
    spark.read.parquet(f"{DATA}/supplier.parquet").write.parquet(str(tmp_path / "supplier.parquet"))
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    orders.limit(300).withColumn("o_custkey", orders.o_custkey + 14_000).write.parquet(str(tmp_path / "orders.parquet"))
    c = duckdb.connect()
    c.execute(f"create view orders as select * from '{tmp_path}/orders.parquet/*.parquet'")
    want = c.sql(oracle_sql()[name])
    got = queries()[name](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
