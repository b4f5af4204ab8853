"""The registered queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm import arrow_sequences, best_fit_packing, chat_roles, decontamination, group_divergence, gru_lm, host_rules, language_id, merkle_manifest, ngram_join, token_counts, toxicity, vector_sharding
from cohortloom.llm.batches import bounded_batches
from cohortloom.llm.folds import held_out
from cohortloom.llm.oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of every document; a token over a line's end goes where most of it lies."""
    return token_counts.line_counts(table(spark, sf_dir, "documents"))


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """The conversations as raw transcripts: of ten turns four keep their role's name as a marker, three show
    another name for it, one a dash, and two nothing. Which, a hash of conversation and turn decides."""
    names = {"system": ("System:", "Instructions:", "Note:"), "user": ("User:", "Human:", "Q:"), "assistant": ("Assistant:", "AI:", "A:")}
    draw = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10))
    shown = F.lit("")
    for role, (own, other, short) in names.items():
        named = F.when(draw < 4, own + " ").when(draw < 6, other + " ").when(draw == 6, short + " ").when(draw == 7, "- ").otherwise("")
        shown = F.when(F.col("role") == role, named).otherwise(shown)
    return conversations.select("conv_id", "turn", "role", F.concat(shown, F.coalesce("text", F.lit(""))).alias("text"))


@query
def op4_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical turns recovered from raw transcripts; roles are learned from two thirds of the conversations."""
    raw = raw_transcripts(table(spark, sf_dir, "conversations"))
    model = chat_roles.learn(chat_roles.lines_of(raw.where(~held_out("conv_id", 3, 1)), "conv_id", "turn", "text", "role"))
    turns = chat_roles.recover(chat_roles.lines_of(raw, "conv_id", "turn", "text"), model)
    return turns.select(F.expr("try_cast(conv as bigint)").alias("conv_id"), held_out("conv", 3, 1).alias("held_out"), "position", "line", "role", "n_lines", "continues", "rendered")


@query
def op5_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = vector_sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "n_tokens")


@query
def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.digest(host_rules.judge(table(spark, sf_dir, "documents")))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = decontamination.benchmark_windows(table(spark, sf_dir, "benchmark"))
    return decontamination.digest(decontamination.find_contamination(table(spark, sf_dir, "documents"), windows))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack(best_fit_packing.token_pieces(table(spark, sf_dir, "documents"), with_ids=False))


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.learn(documents, table(spark, sf_dir, "labels").where(~held_out("doc_id", 3, 1)))
    found = toxicity.score(documents, model, keep=["doc_id"])
    rated = F.col("toxicity")
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), rated.alias("score"), (rated >= toxicity.PREDICT_AT).cast("int").alias("predicted"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    filters = language_id.learn(documents.where(~held_out("doc_id", 3, 1)))
    found = language_id.predict(documents, filters, keep=["doc_id"])
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query
def op3_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = gru_lm.fit_and_score(documents, ~held_out("doc_id", 7, 2))
    return scored.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_arrow_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_sequences.write_sequences(table(spark, sf_dir, "documents")).documents()


@query
def op12_group_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_divergence.Divergence(table(spark, sf_dir, "documents")).report()


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = merkle_manifest.leaves(table(spark, sf_dir, "documents"), claim=merkle_manifest.n_chars_tampered())
    return merkle_manifest.Manifest(leaves).verify().withColumnRenamed("id", "doc_id")
