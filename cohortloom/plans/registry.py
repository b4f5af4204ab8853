"""Named queries over the driver tables, each with its SQL counterpart where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """Lazy access to the parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = str(folder).rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        # Kept, so that the footer is read once per table however often a query names it.
        df = self.__dict__[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return df


@dataclass(frozen=True)
class Query:
    name: str
    rows: str  # inventory ids covered
    run: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, rows: str, sql: str | None = None):
    def register(run: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, rows, run, sql)
        return run

    return register
