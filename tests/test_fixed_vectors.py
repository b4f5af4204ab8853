"""Values that are fixed elsewhere: a published cipher vector, and what a plan reads from a partitioned table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import keys as K
from cohortloom.sources import tables


def test_aes_cbc_vector(spark):
    # NIST SP 800-38A, F.2.1 (CBC-AES128), first block; padding only adds a second one.
    key, iv, plain, cipher = "2b7e151628aed2a6abf7158809cf4f3c", "000102030405060708090a0b0c0d0e0f", "6bc1bee22e409f96e93d7e117393172a", "7649abac8119b246cee98e9b12e9197d"
    out = spark.range(1).select(F.lower(F.hex(F.unbase64(K.encrypt_text(*(F.unhex(F.lit(x)) for x in (plain, key, iv)))))).alias("x")).first().x
    assert out[:32] == iv and out[32:64] == cipher and len(out) == 96


def test_latest_partition_is_pruned(spark, tmp_path):
    rows = [(i, f"2024-01-{d:02}") for i, d in enumerate((1, 1, 2, 3, 5))] + [(9, None)]
    spark.createDataFrame(rows, "x int, day string").withColumn("day", F.to_date("day")).write.partitionBy("day").parquet(str(tmp_path / "t"))
    newest = tables.latest_listed_partition(spark, str(tmp_path / "t"), "day", upto="2024-01-04")
    assert [r.x for r in newest.collect()] == [3]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert tables.latest_listed_partition(spark, str(tmp_path / "t"), "day", upto="2020-01-01").count() == 0
