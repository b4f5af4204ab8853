"""Writers: partitioned tables, reports, exports and external systems."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortloom.session import scratch_path

# Fixed default of rows per output file.
ROWS_PER_FILE = 3_000_000


def overwrite_partitions(df: DataFrame, path: str, partitions: Sequence[str], rows_per_file: int = ROWS_PER_FILE, fmt: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``. Rebalancing by the partition columns lets
    Spark split a big partition over several tasks and merge small ones; files are cut by row count."""
    balanced = df.hint("rebalance", *[F.col(p) for p in partitions])
    (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .format(fmt)
        .partitionBy(*partitions)
        .save(path)
    )


def overwrite_with(df: DataFrame, path: str, values: Mapping[str, str], **options) -> None:
    """Overwrite the one partition named by literal values."""
    named = df.withColumns({k: F.lit(v) for k, v in values.items()})
    overwrite_partitions(named, path, list(values), **options)


def full_and_increment(df: DataFrame, full_path: str, increment_path: str, recent: Column) -> None:
    """Full table, then its recent rows. The second write reads the written table back, so the
    plan behind ``df`` runs once and nothing is held in executor memory."""
    df.write.mode("overwrite").parquet(full_path)
    written = df.sparkSession.read.parquet(full_path)
    written.where(recent).write.mode("overwrite").parquet(increment_path)


def report(df: DataFrame, path: str, order: Sequence[Column], limit: int | None = None) -> None:
    """Ordered tab-separated report with a header: one file of ``limit`` rows, or without a limit several files
    that follow each other in the order of their names, so that no task takes the whole table."""
    ordered = df.orderBy(*order)
    ordered = ordered if limit is None else ordered.limit(limit).coalesce(1)
    ordered.write.mode("overwrite").csv(path, sep="\t", header=True)


def split_export(ids: DataFrame, path: str) -> None:
    """Distinct (id_type, id) rows, one directory per id type."""
    ids.distinct().write.mode("overwrite").partitionBy("id_type").csv(path)


def size_based_partitions(rows: int, per_partition: int = ROWS_PER_FILE) -> int:
    return max(1, rows // per_partition)


def observed(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Runs ``write`` on the rows and gives aggregates of them, collected in the same pass as the write."""
    seen = Observation()
    write(df.observe(seen, *[column.alias(name) for name, column in metrics.items()]))
    return seen.get


def write_sized(df: DataFrame, path: str, per_partition: int = ROWS_PER_FILE) -> int:
    """As many files as the number of rows asks for; gives the number of rows. ``df`` is evaluated once, into a
    staged table that counts its rows as it is written."""
    staged = scratch_path(df.sparkSession, "staged")
    rows = observed(df, lambda rows: rows.write.parquet(staged), n=F.count(F.lit(1)))["n"]
    stored = df.sparkSession.read.parquet(staged)
    stored.repartition(size_based_partitions(rows, per_partition)).write.mode("overwrite").parquet(path)
    return rows


def publish_version(spark: SparkSession, df: DataFrame, view: str, version: str, value: str) -> DataFrame:
    """Point a view at one version of a table, version column left out."""
    current = df.where(F.col(version) == value).drop(version)
    current.createOrReplaceTempView(view)
    return spark.table(view)


def dense_rows(df: DataFrame, key: str, headers: Sequence[str], tags: str = "tags", confidence: str | None = None) -> DataFrame:
    """One text column per header: the tag value, with its confidence after a tab when asked, blank
    when the entity lacks it."""
    cells = []
    for h in headers:
        cell = F.coalesce(F.try_element_at(F.col(tags), F.lit(h)), F.lit(""))
        if confidence is not None:
            cell = F.concat_ws("\t", cell, F.coalesce(F.try_element_at(F.col(confidence), F.lit(h)), F.lit("")))
        cells.append(cell.alias(h))
    return df.select(key, *cells)


def category_slices(slices: DataFrame, path: str, category: str = "category") -> None:
    """One directory per category (see ``tags.split_by_category``)."""
    overwrite_partitions(slices, path, [category])


def flat_rows(df: DataFrame, separator: str = ",") -> DataFrame:
    """Struct columns as ``k=v,k=v`` text, plain columns as text."""
    from cohortloom.functions.text import flatten_struct

    out = []
    for field in df.schema.fields:
        if field.dataType.typeName() == "struct":
            names = field.dataType.names
            out.append(flatten_struct(names, [F.col(f"{field.name}.{n}") for n in names], separator).alias(field.name))
        else:
            out.append(F.col(field.name).cast("string").alias(field.name))
    return df.select(*out)


def kafka_records(df: DataFrame) -> DataFrame:
    """First column as record value; null values are left out of the topic."""
    return df.select(F.col(df.columns[0]).cast("string").alias("value")).where("value is not null")


def send(df: DataFrame, write: Callable[[DataFrame], None]) -> dict:
    """Hands the records of ``df`` to ``write`` and gives ``ok``, the records, and ``failed``, the rows that make none,
    counted as they go out."""
    value = F.col(df.columns[0]).cast("string")
    counted = {"ok": F.count(value), "failed": F.count_if(value.isNull())}
    return observed(df.select(value.alias(df.columns[0])), lambda rows: write(kafka_records(rows)), **counted)


def to_kafka(df: DataFrame, servers: str, topic: str) -> dict:
    """Sends all records and gives their counts as ``send`` does. Needs the Kafka connector on the class path."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    return send(df, lambda records: records.write.format("kafka").options(**options).save())


def to_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int = 8) -> None:
    """Append rows over a bounded number of connections."""
    df.coalesce(connections).write.jdbc(url, table, mode="append", properties=properties)


def csv_to_table(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    overwrite_partitions(df, path, partitions)
