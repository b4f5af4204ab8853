"""Projection by loading tables, and the vector index."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import projection, ranking, vector_index, vectors
from cohortloom.plans import fixtures
from cohortloom.plans.registry import query

DIMS = 64

# The mean vector of each label is a component.
LOADINGS_SQL = """x AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS feature, unnest(embedding)::DOUBLE AS v FROM embeddings),
w AS (SELECT label AS component, feature, avg(v) AS weight FROM x GROUP BY ALL),
s AS (SELECT feature, avg(v) AS mean, stddev_samp(v) AS spread FROM x GROUP BY feature),
z AS (SELECT vec_id, feature, CASE WHEN spread > 0 THEN (v - mean) / spread ELSE 0 END AS z FROM x JOIN s USING (feature)),
y AS (SELECT vec_id, component, sum(z * weight) AS score FROM z JOIN w USING (feature) GROUP BY ALL)"""


def _loadings(t):
    """(feature, component, weight) from the embeddings: one row per label and dimension."""
    cells = t.embeddings.select(F.col("label").cast("long").alias("component"), F.posexplode("embedding").alias("feature", "v"))
    return cells.groupBy(F.col("feature").cast("long").alias("feature"), "component").agg(F.avg(F.col("v").cast("double")).alias("weight"))


@query(
    "loading_table_projection",
    "M3",
    f"WITH {LOADINGS_SQL} SELECT vec_id, component, round(score, 3) AS by_cells, round(score, 3) AS by_rows FROM y",
)
def loading_table_projection(t):
    """Standardised vectors by a loading table, as a sparse product of cells and as a product of whole rows."""
    loadings = _loadings(t)
    cells = t.embeddings.select(F.col("vec_id").alias("entity"), F.posexplode("embedding").alias("feature", "value"))
    cells = cells.select("entity", F.col("feature").cast("long").alias("feature"), F.col("value").cast("double").alias("value"))
    statistics = projection.cell_statistics(cells, t.embeddings.count())
    by_cells = projection.project_cells(cells, loadings, statistics).select(F.col("entity").alias("vec_id"), "component", F.col("score").alias("by_cells"))
    scaled = vectors.standardise(t.embeddings, "embedding", DIMS).select("vec_id", "scaled")
    by_rows = projection.project_rows(scaled, "scaled", DIMS, loadings).select("vec_id", F.posexplode("projected").alias("component", "by_rows"))
    return by_cells.join(by_rows, ["vec_id", "component"]).select("vec_id", "component", "by_cells", "by_rows")


@query(
    "loading_check",
    "M3",
    f"""WITH {LOADINGS_SQL},
n AS (SELECT component, sqrt(sum(weight * weight)) AS norm FROM w GROUP BY component),
v AS (SELECT component, var_samp(score) AS variance FROM y GROUP BY component),
o AS (SELECT a.component, b.component AS other, abs(sum(a.weight * b.weight)) AS product FROM w a JOIN w b USING (feature) WHERE a.component <> b.component GROUP BY ALL),
m AS (SELECT component, feature, covar_samp(z, score) AS moved FROM z JOIN y USING (vec_id) GROUP BY ALL),
r AS (SELECT component, sqrt(sum(pow(moved - variance / (norm * norm) * weight, 2))) AS residual FROM m JOIN w USING (component, feature) JOIN v USING (component) JOIN n USING (component) GROUP BY component)
SELECT component, round(variance, 4) AS variance, round(variance / (SELECT count(*) FROM s WHERE spread > 0), 4) AS share, round(norm, 4) AS norm,
  round((SELECT max(product) FROM o WHERE o.component = v.component), 4) AS overlap, round(residual, 4) AS residual
FROM v JOIN n USING (component) JOIN r USING (component)""",
)
def loading_check(t):
    found = projection.check_loadings(t.embeddings, "embedding", DIMS, _loadings(t))
    return found.select("component", *[F.round(c, 4).alias(c) for c in ("variance", "share", "norm", "overlap", "residual")])


# Purchases by type are the cells; 40 components with weights by a rule from the type's name.
CELLS_SQL = f"""{fixtures.PURCHASES_SQL}, c AS (SELECT o_custkey AS entity, p_type, count(*)::DOUBLE AS value FROM purchases JOIN part ON p_partkey = l_partkey GROUP BY ALL),
f AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS feature FROM (SELECT DISTINCT p_type FROM part)),
w AS (SELECT feature, p_type, component, ((length(p_type) * 7 + ascii(p_type) + feature * 5 + component * 3) % 17 - 8) / 10.0 AS weight FROM f, range(40) r(component))"""


@query(
    "sparse_projection",
    "M3 M1",
    f"""WITH {CELLS_SQL}, e AS (SELECT DISTINCT entity FROM c),
d AS (SELECT entity, feature, coalesce(value, 0) AS v FROM e JOIN f ON TRUE LEFT JOIN c USING (entity, p_type)),
s AS (SELECT feature, avg(v) AS mean, stddev_samp(v) AS spread FROM d GROUP BY feature),
z AS (SELECT entity, feature, (v - mean) / spread AS z FROM d JOIN s USING (feature) WHERE spread > 0)
SELECT entity, component, round(sum(z * weight), 2) AS score FROM z JOIN w USING (feature) GROUP BY ALL""",
)
def sparse_projection(t):
    """Counts of purchases by type, standardised over all customers, by 40 components."""
    bought = fixtures.purchases(t).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    counts = bought.groupBy(F.col("o_custkey").alias("entity"), "p_type").agg(F.count("*").cast("double").alias("value"))

    dictionary = ranking.global_index(t.part.select("p_type").distinct(), ["p_type"], "feature", start=0)
    rule = (F.length("p_type") * 7 + F.ascii("p_type") + F.col("feature") * 5 + F.col("component") * 3) % 17 - 8
    weights = dictionary.withColumn("component", F.explode(F.sequence(F.lit(0), F.lit(39)))).select("feature", F.col("component").cast("long").alias("component"), (rule / 10.0).alias("weight"))
    cells = counts.join(dictionary, "p_type").select("entity", "feature", "value")
    statistics = projection.cell_statistics(cells, cells.select("entity").distinct().count())
    return projection.project_cells(cells, weights, statistics, places=2)


@query(
    "indexed_cosine_top_10",
    "M6",
    """WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT a.vec_id AS id, b.vec_id AS other, round(list_cosine_similarity(a.v, b.v), 6) AS score FROM u a JOIN u b ON a.vec_id <> b.vec_id)
SELECT id, other, score FROM s QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 10""",
)
def indexed_cosine_top_10(t):
    """The index asked for all its lists: the exact answer."""
    index = vector_index.VectorIndex(t.embeddings, "vec_id", "embedding")
    return index.search(index.queries(), 10, index.lists).select("id", "other", F.round("score", 6).alias("score"))


@query(
    "index_recall",
    "M6",
    "SELECT count(*) AS queries, 10 * count(*) AS pairs, TRUE AS reached FROM embeddings WHERE vec_id % 100 = 0",
)
def index_recall(t):
    """Rows whose id 100 divides, against all rows: the share of the true ten best that the index finds is at least 0.9."""
    index = vector_index.VectorIndex(t.embeddings, "vec_id", "embedding")
    found = index.recall(10, index.probes_for(10, 0.9))
    return found.select("queries", "pairs", (F.col("found") >= 0.9 * F.col("pairs")).alias("reached"))
