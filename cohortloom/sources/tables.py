"""Partitioned tables: scans, latest partitions and high-water marks."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions import dates

# Fixed folder name of a null partition value.
HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"


def scan(spark: SparkSession, path: str, fmt: str = "parquet", where: Column | None = None) -> DataFrame:
    """Columnar scan (parquet or orc) with an optional partition predicate."""
    df = spark.read.format(fmt).load(path)
    return df if where is None else df.where(where)


def latest_partition(df: DataFrame, partition: str, upto=None, pattern: str | None = None) -> DataFrame:
    """Rows of the greatest partition value, optionally at or before ``upto`` and matching a pattern;
    no rows when there is none. The one value comes to the driver, because only a literal prunes the
    file listing of the scan."""
    days = df.select(partition)
    if upto is not None:
        days = days.where(F.col(partition) <= F.lit(upto))
    if pattern is not None:
        days = days.where(F.col(partition).cast("string").rlike(pattern))
    newest = days.agg(F.max(partition)).first()[0]
    return df.where(F.lit(False)) if newest is None else df.where(F.col(partition) == F.lit(newest))


def partition_values(spark: SparkSession, path: str, partition: str) -> list[str]:
    """The values of a table's first partition column, from the names of the folders directly below it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    names = [unquote(f.getPath().getName()) for f in listed if f.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{partition}="))


def latest_listed_partition(spark: SparkSession, path: str, partition: str, upto: str | None = None) -> DataFrame:
    """As :func:`latest_partition` for a table partitioned on disk, from the names of its folders alone: one entry
    per partition, no file name is listed to find the value, and the scan lists one partition. The value is text."""
    found = [v for v in partition_values(spark, path, partition) if v != HIVE_NULL and (upto is None or v <= upto)]
    df = spark.read.parquet(path)
    return df.where(F.col(partition) == F.lit(found[-1])) if found else df.where(F.lit(False))


def latest_table_partition(spark: SparkSession, table: str, upto: str | None = None, pattern: str | None = None) -> DataFrame:
    """As :func:`latest_partition` for a catalogue table with one partition column, from the catalogue's
    partition list alone: no data file is opened to find the value."""
    listed = spark.sql(f"SHOW PARTITIONS {table}").select(F.substring_index("partition", "=", 1).alias("name"), F.substring_index("partition", "=", -1).alias("value"))
    if upto is not None:
        listed = listed.where(F.col("value") <= upto)
    if pattern is not None:
        listed = listed.where(F.col("value").rlike(pattern))
    newest = listed.agg(F.max(F.struct("value", "name")).alias("m")).first()["m"]
    df = spark.table(table)
    return df.where(F.lit(False)) if newest is None else df.where(F.col(newest["name"]) == newest["value"])


def period_partition(df: DataFrame, partition: str, day, period: str) -> DataFrame:
    """Rows of the partition that closes the last complete day, week, month or year before ``day``."""
    return df.where(F.col(partition) == dates.period_end(F.lit(day), period))


def latest_per_feature(df: DataFrame, feature: str, partition: str) -> DataFrame:
    """Rows of each feature's own latest partition."""
    newest = df.groupBy(feature).agg(F.max(partition).alias(partition))
    return df.join(newest, [feature, partition], "left_semi")


def high_water_marks(df: DataFrame, source: str, time: str) -> DataFrame:
    """(source, mark): greatest time seen."""
    return df.groupBy(F.col(source).alias("source")).agg(F.max(time).alias("mark"))


def raise_marks(marks: DataFrame, seen: DataFrame) -> DataFrame:
    """Stored and new marks, the later one per source."""
    return marks.unionByName(seen).groupBy("source").agg(F.max("mark").alias("mark"))


def above_marks(df: DataFrame, marks: DataFrame, source: str, time: str) -> DataFrame:
    """Rows later than their source's mark; sources without one are wholly new."""
    known = marks.select(F.col("source").alias(source), "mark")
    joined = df.join(known, source, "left")
    return joined.where(F.col("mark").isNull() | (F.col(time) > F.col("mark"))).drop("mark")
