"""Seed lists: stored datasets, match results, the feature hub, SQL and delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed field separator of stored seed rows.
SEPARATOR = "\u0001"


def stored_seeds(table: DataFrame, dataset: str, dataset_id: str, index: int = 1, separator: str = SEPARATOR) -> DataFrame:
    """(id, data): the ``index``-th field (from 1) of the rows of one dataset. Null rows and rows whose
    first field is ``-1`` drop. The dataset test is a partition predicate."""
    fields = F.split(F.col("data"), f"\\Q{separator}\\E")
    rows = table.where((F.col(dataset) == dataset_id) & F.col("data").isNotNull())
    return rows.where(fields[0] != "-1").select(F.get(fields, F.lit(index - 1)).alias("id"), "data")


def matched_seeds(matches: DataFrame, id_type: str | int) -> DataFrame:
    """(id, data): one row per id matched for a type; the map value is csv."""
    csv = F.try_element_at("match_ids", F.lit(id_type))
    return matches.select(F.explode(F.split(csv, ",")).alias("id"), "data")


def hub_seeds(hub: DataFrame, key: str) -> DataFrame:
    """(id, data) of the hub rows that hold ``key``."""
    value = F.try_element_at("feature", F.lit(key))
    seed = F.try_element_at("feature", F.lit("seed"))
    return hub.select(F.get(value, F.lit(0)).alias("id"), F.get(seed, F.lit(0)).alias("data")).where("id is not null")


def frame_seeds(df: DataFrame, index: int = 1, separator: str = SEPARATOR, prefix: str = "in_") -> DataFrame:
    """Any query result as seeds: columns get a prefix, ``id`` is the ``index``-th column as text and
    ``data`` all columns joined."""
    columns = [f"{prefix}{c}" for c in df.columns]
    renamed = df.toDF(*columns)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return renamed.withColumn("id", F.col(columns[index - 1]).cast("string")).withColumn(
        "data", F.concat_ws(separator, *texts)
    )


def sql_seeds(spark: SparkSession, query: str, index: int = 1, separator: str = SEPARATOR) -> DataFrame:
    return frame_seeds(spark.sql(query), index, separator)


def delimited_seeds(
    spark: SparkSession, path: str, headers: Sequence[str], separator: str, key: str, key_name: str = "id"
) -> DataFrame:
    """Delimited text with given headers; rows equal to the header line drop and the key column is
    named ``key_name``. The separator is literal text."""
    lines = spark.read.text(path)
    return split_lines(lines, "value", headers, separator, key, key_name)


def split_lines(
    lines: DataFrame, column: str, headers: Sequence[str], separator: str, key: str, key_name: str = "id"
) -> DataFrame:
    fields = F.split(F.col(column), f"\\Q{separator}\\E")
    body = lines.where(F.col(column) != separator.join(headers))
    return body.select(
        *[F.get(fields, F.lit(i)).alias(key_name if h == key else h) for i, h in enumerate(headers)]
    )


def load_into_hub(seeds: DataFrame, key: str, id_column: str = "id", data: str = "data") -> DataFrame:
    """Hub rows ``{seed: [data], key: [id]}``."""
    feature = F.create_map(F.lit("seed"), F.array(data), F.lit(key), F.array(id_column))
    return seeds.select(feature.alias("feature"))


def csv_table(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """CSV with a declared schema (no inference pass over the data)."""
    return spark.read.csv(path, schema=schema, header=header, mode="FAILFAST")


def jdbc_table(spark: SparkSession, url: str, table: str, properties: dict[str, str], partition: dict | None = None) -> DataFrame:
    """JDBC table. ``partition`` may give column, lowerBound, upperBound and numPartitions; without it the
    read is a single connection, fit for metadata tables only."""
    if partition:
        return spark.read.jdbc(
            url, table, column=partition["column"], lowerBound=partition["lowerBound"],
            upperBound=partition["upperBound"], numPartitions=partition["numPartitions"], properties=properties,
        )
    return spark.read.jdbc(url, table, properties=properties)

