"""A corpus pipeline: each stage reads what its predecessor kept, as Parquet, and its decisions take effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm import best_fit_packing, decontamination, language_id, ngram_join, toxicity
from cohortloom.llm.batches import bounded_batches
from cohortloom.llm.folds import held_out
from cohortloom.llm.queries import table
from cohortloom.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: SQL cannot express the stages that learn from data; the tests hold each against a plain version.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score reaches the threshold; learns from two thirds of the labels.

    A null or empty text is scored as such; repeated rows are judged alike; without labels, and of an empty table, nothing goes.
    """
    bounded_batches(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1)))
    rated = toxicity.score(docs, model, into="_toxicity")
    return rated.where(F.col("_toxicity") < toxicity.PREDICT_AT).drop("_toxicity")


#: A document whose own language tag another language contradicts with at least this score is rejected.
SURE_LANGUAGE = 0.7


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of undetermined language (a null text, or one without a letter) or of clearly another one than they say.

    A null tag contradicts nothing; repeated rows are judged alike; where no row has a tag and a text nothing is learned, and all go.
    """
    bounded_batches(spark)
    found = language_id.predict(docs, language_id.learn(docs), into="_language")
    other = F.col("lang").isNotNull() & (F.col("lang") != F.col("_language.lang")) & (F.col("_language.score") >= SURE_LANGUAGE)
    return found.where((F.col("_language.lang") != "und") & ~other).drop("_language")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row, that of the smallest id, of each group of texts that near-duplicate links connect.

    Null texts stand alone, rows of one id together; texts without words group with equal ones; repeated rows are copies.
    """
    bounded_batches(spark)
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a window of a benchmark item.

    A null or empty text holds none and stays; repeated rows are judged alike; an empty benchmark rejects nothing.
    """
    bounded_batches(spark)
    windows = decontamination.benchmark_windows(table(spark, sf_dir, "benchmark"))
    return decontamination.decontaminate(docs, windows)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: sequence_id and offset.

    A null or empty text is a piece of its end id alone; repeated rows are packed each; an empty table gives no rows.
    """
    bounded_batches(spark)
    return best_fit_packing.pack(best_fit_packing.token_pieces(docs, with_ids=False))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_language),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, with a written table between them."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
