"""Feature assembly, scaling, projection, similarity and text vectors."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import functions as F

from cohortloom.operators import vectors
from cohortloom.plans import fixtures
from cohortloom.plans.registry import query
from cohortloom.session import scratch_path

DIMS = 64
SUMMED = "list_sum(list_transform({v}, lambda x: CAST(x AS DOUBLE)))"


def _checksum(column, places=4):
    """Position-weighted sum of a vector, so that flat results can be compared."""
    weighted = F.transform(column, lambda x, i: x * (i + 1))
    return F.round(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x), places)


@query(
    "mean_vectors",
    "A40",
    """WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, avg(v) AS m FROM x GROUP BY ALL) SELECT label, round(sum(m * i), 4) AS checksum FROM m GROUP BY label""",
)
def mean_vectors(t):
    return vectors.mean_vector(t.embeddings, ["label"], "embedding", DIMS).select("label", _checksum("mean").alias("checksum"))


@query(
    "standardised_vectors",
    "M2",
    """WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
s AS (SELECT *, (v - avg(v) OVER (PARTITION BY i)) / stddev_samp(v) OVER (PARTITION BY i) AS z FROM x) SELECT vec_id, round(sum(z * i), 4) AS checksum FROM s GROUP BY vec_id""",
)
def standardised_vectors(t):
    scaled = vectors.standardise(t.embeddings, "embedding", DIMS)
    return scaled.select("vec_id", _checksum("scaled").alias("checksum"))


LOADINGS = [[round(math.cos((k + 1) * (i + 1)), 6) for i in range(DIMS)] for k in range(3)]


def _dot_sql(row):
    weights = ", ".join(str(w) for w in row)
    return f"round(list_dot_product(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), [{weights}]::DOUBLE[]), 3)"


@query(
    "loading_projection",
    "M3",
    "SELECT vec_id, " + ", ".join(f"{_dot_sql(row)} AS c{k}" for k, row in enumerate(LOADINGS)) + " FROM embeddings",
)
def loading_projection(t):
    projected = vectors.project(t.embeddings, "embedding", LOADINGS)
    return projected.select("vec_id", *[F.col("projected")[k].alias(f"c{k}") for k in range(len(LOADINGS))])


@query(
    "rolling_vector_store",
    "M4 W1",
    f"""WITH {fixtures.PROFILE_SQL}, h AS (SELECT o_custkey AS c_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice AS x FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2001-05-01'),
l AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY day DESC, x DESC) = 1) SELECT c_custkey, day, x, segment FROM l JOIN profile USING (c_custkey)""",
)
def rolling_vector_store(t):
    rows = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day"), F.array("o_totalprice").alias("vector")
    )
    newest = date(2001, 6, 30)
    before, today = rows.where(F.col("day") < F.lit(newest)), rows.where(F.col("day") >= F.lit(newest))
    attributes = fixtures.profile(t).select("c_custkey", "segment")
    store = vectors.rolling_store(before, today, "c_custkey", "day", newest, attributes)
    return store.select("c_custkey", "day", F.col("vector")[0].alias("x"), "segment")


@query(
    "centroid_lookalike",
    "M5",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT i, avg(v) AS m FROM x WHERE label = 3 GROUP BY i) SELECT vec_id, round(sqrt(sum(pow(v - m, 2))), 6) AS distance FROM x JOIN c USING (i) GROUP BY vec_id""",
)
def centroid_lookalike(t):
    seeds = t.embeddings.where("label = 3").select("vec_id")
    ranked = vectors.lookalike(t.embeddings, seeds, "vec_id", "embedding", DIMS)
    return ranked.select("vec_id", F.round("distance", 6).alias("distance"))


UNIT_SQL = "u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, label FROM embeddings)"


@query(
    "cosine_top_30",
    "M6 T2",
    f"""WITH {UNIT_SQL}, s AS (SELECT a.vec_id AS id, b.vec_id AS other, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM u a JOIN u b ON a.vec_id <> b.vec_id)
SELECT id, other, score FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 30""",
)
def cosine_top_30(t):
    return vectors.cosine_top_k(t.embeddings, "vec_id", "embedding", 30).select("id", "other", F.round("score", 6).alias("score"))


def _half_sql(name, first, last):
    return f"""{name} AS (SELECT a.vec_id AS id, b.vec_id AS other, round(list_cosine_similarity(a.v[{first}:{last}], b.v[{first}:{last}]), 6) AS s
  FROM u a JOIN u b ON a.vec_id <> b.vec_id QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY s DESC, b.vec_id) <= 10)"""


@query(
    "fused_similarity",
    "M7",
    f"""WITH {UNIT_SQL}, {_half_sql("a", 1, DIMS // 2)}, {_half_sql("b", DIMS // 2 + 1, DIMS)}, c AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT id, other, round(coalesce(count(*) FILTER (s <> 0) / sum(1 / s) FILTER (s <> 0), 0), 6) AS score FROM c GROUP BY id, other""",
)
def fused_similarity(t):
    """The most similar vectors in each half of the dimensions, fused."""
    halves = [
        vectors.cosine_top_k(t.embeddings.select("vec_id", F.slice("embedding", start, DIMS // 2).alias("half")), "vec_id", "half", 10)
        for start in (1, DIMS // 2 + 1)
    ]
    return vectors.fuse_scores(halves).select("id", "other", F.round("score", 6).alias("score"))


# Fixed short stop-word list of the text queries.
STOP_WORDS = ("the", "and", "of", "de", "la", "le", "der", "die", "und", "el", "en", "que")


# Four documents to a name, a day per document: some texts are older than the window, others not the latest.
NAMED_TEXT_SQL = """t AS (SELECT CAST(doc_id // 4 AS VARCHAR) AS name, text, DATE '2024-01-01' + CAST(doc_id * 7 % 300 AS INTEGER) AS day FROM documents)"""


@query(
    "text_embedding",
    "M8",
    f"""WITH {NAMED_TEXT_SQL}, l AS (SELECT * FROM t WHERE day > DATE '2024-10-26' - 180 QUALIFY row_number() OVER (PARTITION BY name ORDER BY day DESC, text DESC) = 1),
w AS (SELECT name, day, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '' AND w NOT IN ('the', 'and', 'of', 'de', 'la', 'le', 'der', 'die', 'und', 'el', 'en', 'que')) AS ws FROM l),
known AS (SELECT w FROM (SELECT unnest(ws) AS w FROM w) GROUP BY w HAVING count(*) >= 2), has AS (SELECT DISTINCT name FROM (SELECT name, unnest(ws) AS w FROM w) WHERE w IN (SELECT w FROM known))
SELECT name, day, len(ws) AS words, 100 AS dims, name IN (SELECT name FROM has) AS has_vector, TRUE AS equal_to_twins FROM w""",
)
def text_embedding(t):
    texts = t.documents.select(
        F.expr("doc_id div 4").cast("string").alias("name"), "text", F.date_add(F.lit(date(2024, 1, 1)), (F.col("doc_id") * 7 % 300).cast("int")).alias("day")
    )
    latest = vectors.latest_texts(texts, "name", "text", "day", date(2024, 10, 26))
    embedded = vectors.text_embedding(latest, "text", STOP_WORDS, minimum_count=2)
    path = scratch_path(t.spark, "embedded")
    embedded.withColumn("_twin", F.xxhash64("tokens")).write.parquet(path)
    embedded = t.spark.read.parquet(path)
    # Equal tokens have equal vectors, wherever their rows lie.
    twins = embedded.groupBy("_twin").agg((F.min("embedding") == F.max("embedding")).alias("equal_to_twins"))
    has = F.exists("embedding", lambda x: x != 0)
    return embedded.join(twins, "_twin").select("name", "day", F.size("tokens").alias("words"), F.size("embedding").alias("dims"), has.alias("has_vector"), "equal_to_twins")


@query(
    "stop_word_tokens",
    "M9",
    """SELECT doc_id, len(w) AS words, array_to_string(w, ' ') AS tokens FROM (SELECT doc_id,
  list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '' AND w NOT IN ('the', 'and', 'of', 'de', 'la', 'le', 'der', 'die', 'und', 'el', 'en', 'que')) AS w FROM documents)""",
)
def stop_word_tokens(t):
    words = vectors.tokens(F.col("text"), STOP_WORDS)
    return t.documents.select("doc_id", words.alias("w")).select("doc_id", F.size("w").cast("long").alias("words"), F.array_join("w", " ").alias("tokens"))


@query(
    "named_vectors",
    "M10",
    """WITH c AS (SELECT l_partkey AS vec_id, count(*) AS n FROM lineitem GROUP BY 1)
SELECT vec_id, len(embedding) AS dims, round(embedding[1]::DOUBLE, 6) AS first, p_name AS name FROM embeddings LEFT JOIN (SELECT CASE WHEN p_size > 10 THEN p_partkey ELSE -1 - p_partkey END AS p_partkey, p_name FROM part) ON p_partkey = vec_id WHERE vec_id IN (SELECT vec_id FROM c WHERE n >= 30)""",
)
def named_vectors(t):
    texts = t.embeddings.select("vec_id", F.array_join(F.transform("embedding", lambda x: x.cast("double").cast("string")), ", ").alias("line"))
    parsed = texts.select("vec_id", vectors.parse_vector(F.col("line")).alias("vector"))
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("vec_id")).agg(F.count("*").alias("n"))
    named = F.when(F.col("p_size") > 10, F.col("p_partkey")).otherwise(-1 - F.col("p_partkey"))
    names = t.part.select(named.alias("vec_id"), F.col("p_name").alias("name"))
    kept = vectors.named_vectors(parsed, "vec_id", counts, "n", 30, names)
    return kept.select("vec_id", F.size("vector").cast("long").alias("dims"), F.round(F.col("vector")[0], 6).alias("first"), "name")


@query("vector_categories", "M11", "SELECT label, count(*) AS vectors FROM embeddings GROUP BY label")
def vector_categories(t):
    return vectors.category_counts(t.embeddings, "label")


@query(
    "sparse_features",
    "M1 W6",
    f"""WITH {fixtures.PROFILE_SQL},
l AS (SELECT c_custkey, 'attr_region' AS space, CASE WHEN region IN ('ASIA', 'EUROPE', 'AFRICA') THEN region ELSE 'other' END AS feature, 1.0 AS value FROM profile
  UNION ALL SELECT c_custkey, 'attr_segment', segment, 1.0 FROM profile
  UNION ALL SELECT o_custkey, 'status', o_orderstatus, 1.0 FROM orders JOIN profile ON c_custkey = o_custkey
  UNION ALL SELECT o_custkey, 'type', p_type, 1.0 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey JOIN profile ON c_custkey = o_custkey),
n AS (SELECT space, feature, count(*) AS cnt FROM l GROUP BY space, feature),
d AS (SELECT space, feature, row_number() OVER (ORDER BY space, cnt DESC, feature) - 1 AS idx FROM n),
x AS (SELECT c_custkey, idx, CAST(sum(value) AS BIGINT) AS v FROM l JOIN d USING (space, feature) GROUP BY c_custkey, idx)
SELECT c_custkey, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices, string_agg(CAST(v AS VARCHAR), ',' ORDER BY idx) AS vals FROM x GROUP BY c_custkey""",
)
def sparse_features(t):
    people = fixtures.profile(t).select("c_custkey", F.col("region").alias("attr_region"), F.col("segment").alias("attr_segment"))
    attributes = vectors.one_hot_names(people, "c_custkey", {"attr_region": ["ASIA", "EUROPE", "AFRICA"], "attr_segment": None})
    known = people.select("c_custkey")
    status = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.lit("status").alias("space"), F.col("o_orderstatus").alias("feature"))
    bought = fixtures.purchases(t).join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("o_custkey").alias("c_custkey"), F.lit("type").alias("space"), F.col("p_type").alias("feature")
    )
    counts = status.unionByName(bought).join(known, "c_custkey", "left_semi").withColumn("value", F.lit(1.0))
    rows = vectors.sparse_features(attributes.unionByName(counts), "c_custkey")
    whole = F.transform("values", lambda v: v.cast("long").cast("string"))
    return rows.select(
        "c_custkey", F.array_join(F.transform("indices", lambda i: i.cast("string")), ",").alias("indices"), F.array_join(whole, ",").alias("vals")
    )
