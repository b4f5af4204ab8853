"""How many rows of text Spark hands to Python at once."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to ``MOST_ROWS`` rows: texts are long, and both the executor and its
    Python worker hold a whole batch. A lower setting stays."""
    now = int(spark.conf.get(SETTING))
    if now <= 0 or now > MOST_ROWS:
        spark.conf.set(SETTING, str(MOST_ROWS))
