"""Label distributions, penetration, population index, calibration and portraits."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.operators import distribution as D
from cohortloom.operators import filters, ranking
from cohortloom.plans import fixtures
from cohortloom.plans.registry import query

PROFILE = fixtures.PROFILE_SQL
PURCHASES = fixtures.PURCHASES_SQL

SEEDS_SQL = "seeds AS (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01')"


def _seeds(t):
    year = t.orders.where((F.col("o_orderdate") >= "1996-01-01") & (F.col("o_orderdate") < "1997-01-01"))
    return year.select(F.col("o_custkey").alias("c_custkey")).distinct()


def _long_labels_sql(source: str) -> str:
    parts = []
    for name in fixtures.TAG_NAMES:
        value = f"CASE WHEN {name} IS NULL OR trim({name}) IN ('', '-1') THEN 'unknown' ELSE {name} END"
        parts.append(f"SELECT c_custkey, '{name}' AS label, unnest(list_distinct(string_split({value}, ','))) AS value FROM {source}")
    return " UNION ALL ".join(parts)


@query(
    "label_distribution",
    "A1 W3 K4 J1",
    f"""WITH {PROFILE}, {SEEDS_SQL}, s AS (SELECT profile.* FROM profile JOIN seeds USING (c_custkey)),
l AS ({_long_labels_sql('s')})
SELECT label, value, count(*) AS cnt, round(count(*) / (SELECT count(*) FROM s), 4) AS percent FROM l GROUP BY label, value
ORDER BY label, percent DESC, value""",
)
def label_distribution(t):
    rows = _seeds(t).join(fixtures.tagged(t), "c_custkey")
    shares = D.label_distribution(rows, "c_custkey", fixtures.TAG_NAMES)
    report = ranking.ordered_report(shares, [F.asc("label"), F.desc("percent"), F.asc("value")])
    return report.withColumn("percent", F.col("percent").cast("double"))


@query(
    "report_order",
    "W3 W7",
    f"""WITH {PROFILE}, c AS (SELECT nation, segment, count(*) AS cnt FROM profile GROUP BY nation, segment)
SELECT nation, segment, cnt, row_number() OVER (PARTITION BY nation ORDER BY cnt DESC, segment) AS rn FROM c
QUALIFY rn <= 3""",
)
def report_order(t):
    counts = fixtures.profile(t).groupBy("nation", "segment").agg(F.count("*").alias("cnt"))
    top = ranking.top_k_per_group(counts, ["nation"], [F.desc("cnt"), F.asc("segment")], 3)
    return top.withColumn("rn", F.col("rn").cast("long"))


@query(
    "distinct_entities",
    "A2",
    f"WITH {PURCHASES} SELECT l_suppkey, l_partkey % 100 AS item_group, count(DISTINCT o_custkey) AS cnt FROM purchases GROUP BY ALL",
)
def distinct_entities(t):
    rows = fixtures.purchases(t).withColumn("item_group", F.col("l_partkey") % 100)
    return D.distinct_entities(rows, ["l_suppkey", "item_group"], "o_custkey")


@query(
    "index_given_population",
    "A3",
    f"""WITH {PURCHASES}, given AS (SELECT p_partkey AS l_partkey, (p_size - 5) / 1000.0 AS population_share FROM part),
s AS (SELECT l_partkey, count(DISTINCT o_custkey) AS cnt FROM purchases GROUP BY l_partkey)
SELECT l_partkey, cnt, round(cnt / (SELECT count(DISTINCT o_custkey) FROM purchases), 8) AS penetration,
  round(cnt / (SELECT count(DISTINCT o_custkey) FROM purchases) / population_share * 100, 5) AS tgi
FROM s JOIN given USING (l_partkey) WHERE population_share > 0""",
)
def index_given_population(t):
    base = t.part.select(F.col("p_partkey").alias("l_partkey"), ((F.col("p_size") - 5) / 1000.0).alias("population_share"))
    shares = D.penetration(fixtures.purchases(t), "l_partkey", "o_custkey")
    return D.index_against(shares, base, "l_partkey").select(
        "l_partkey", "cnt", F.round("penetration", 8).alias("penetration"), F.round("tgi", 5).alias("tgi")
    )


@query(
    "index_computed_population",
    "A4",
    f"""WITH {PURCHASES}, {SEEDS_SQL}, sample AS (SELECT * FROM purchases WHERE o_custkey IN (SELECT c_custkey FROM seeds)),
p AS (SELECT l_partkey, count(DISTINCT o_custkey) / (SELECT count(DISTINCT o_custkey) FROM purchases) AS share FROM purchases GROUP BY l_partkey),
s AS (SELECT l_partkey, count(DISTINCT o_custkey) AS cnt, count(DISTINCT o_custkey) / (SELECT count(DISTINCT o_custkey) FROM sample) AS pen FROM sample GROUP BY l_partkey)
SELECT l_partkey, cnt, round(pen / share * 100, 5) AS tgi FROM s JOIN p USING (l_partkey)""",
)
def index_computed_population(t):
    population = fixtures.purchases(t).select("o_custkey", "l_partkey")
    seeds = _seeds(t).withColumnRenamed("c_custkey", "o_custkey")
    return D.population_index(population, seeds, "l_partkey", "o_custkey").select(
        "l_partkey", "cnt", F.round("tgi", 5).alias("tgi")
    )


@query(
    "stacked_metrics",
    "A5",
    """WITH a AS (SELECT c_nationkey AS nationkey, count(*) AS customers FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY 1),
b AS (SELECT s_nationkey AS nationkey, count(*) AS suppliers FROM supplier GROUP BY 1)
SELECT nationkey, coalesce(customers, 0) AS customers, coalesce(suppliers, 0) AS suppliers FROM a FULL JOIN b USING (nationkey)""",
)
def stacked_metrics(t):
    a = t.customer.where("c_mktsegment = 'BUILDING'").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("customers"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("suppliers"))
    return D.stacked_metrics(a, b, ["nationkey"])


ATTRIBUTE_SHARES_SQL = f"""{PROFILE}, a AS (
  SELECT region, unnest(['segment', 'nation', 'band']) AS label, unnest([segment, nation, band]) AS value FROM profile),
c AS (SELECT region, label, value, count(*) AS cnt FROM a GROUP BY ALL),
sh AS (SELECT *, cnt / sum(cnt) OVER (PARTITION BY region, label) AS share FROM c)"""


@query(
    "attribute_shares",
    "A6 W2",
    f"WITH {ATTRIBUTE_SHARES_SQL} SELECT region, label, value, cnt, round(share, 8) AS share FROM sh",
)
def attribute_shares(t):
    shares = D.attribute_shares(fixtures.profile(t), ["region"], ["segment", "nation", "band"])
    return shares.select("region", "label", "value", "cnt", F.round("share", 8).alias("share"))


@query(
    "calibration",
    "A7",
    f"""WITH {ATTRIBUTE_SHARES_SQL},
r AS (SELECT 'segment' AS label, c_mktsegment AS value, count(*) / (SELECT count(*) FROM customer) AS ratio_a, sum(c_acctbal) / (SELECT sum(c_acctbal) FROM customer) AS ratio_b FROM customer GROUP BY c_mktsegment),
n AS (SELECT r_name AS region, count(*) * 3 AS total_b FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name),
i AS (SELECT sh.*, total_b, share / ratio_a * ratio_b AS idx FROM sh JOIN r USING (label, value) JOIN n USING (region)),
w AS (SELECT *, idx / sum(idx) OVER (PARTITION BY region, label) AS weight FROM i),
b AS (SELECT *, weight * total_b AS cnt_b FROM w)
SELECT region, label, value, cnt, round(weight, 8) AS weight, round(cnt_b, 6) AS cnt_b,
  round((cnt + cnt_b) / (sum(cnt) OVER (PARTITION BY region, label) + sum(cnt_b) OVER (PARTITION BY region, label)), 8) AS final_share FROM b""",
)
def calibration(t):
    observed = D.attribute_shares(fixtures.profile(t), ["region"], ["segment"])
    everyone, balance = t.customer.agg(F.count("*")).scalar(), t.customer.agg(F.sum("c_acctbal")).scalar()
    ratios = t.customer.groupBy(F.col("c_mktsegment").alias("value")).agg(
        (F.count("*") / everyone).alias("ratio_a"), (F.sum("c_acctbal") / balance).alias("ratio_b")
    ).withColumn("label", F.lit("segment"))
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    totals = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).groupBy(
        F.col("r_name").alias("region")
    ).agg((F.count("*") * 3).alias("total_b"))
    return D.calibrate(observed, ratios, totals, ["region"]).select(
        "region", "label", "value", "cnt", F.round("weight", 8).alias("weight"), F.round("cnt_b", 6).alias("cnt_b"),
        F.round("final_share", 8).alias("final_share"),
    )


@query(
    "counter_stack",
    "A8",
    f"""WITH {PURCHASES} SELECT l_suppkey, count(DISTINCT o_custkey) AS customers, count(DISTINCT l_partkey) AS parts, count(DISTINCT day) AS days
FROM purchases GROUP BY l_suppkey""",
)
def counter_stack(t):
    return D.counter_stack(
        fixtures.purchases(t), ["l_suppkey"], {"customers": F.col("o_custkey"), "parts": F.col("l_partkey"), "days": F.col("day")}
    )


@query(
    "multi_value_share",
    "A10",
    f"""WITH {PROFILE}, v AS (SELECT DISTINCT c_custkey, unnest(string_split(codes, ',')) AS value FROM profile)
SELECT value, count(*) AS cnt, round(count(*) / (SELECT count(*) FROM profile), 8) AS share FROM v GROUP BY value""",
)
def multi_value_share(t):
    return D.multi_value_share(fixtures.profile(t), "c_custkey", "codes").select("value", "cnt", F.round("share", 8).alias("share"))


@query(
    "value_count_maps",
    "A11",
    f"""WITH {PROFILE}, c AS (SELECT region, unnest(['segment', 'band']) AS label, unnest([segment, band]) AS value FROM profile),
g AS (SELECT region, label, value, count(*) AS n FROM c GROUP BY ALL)
SELECT region, string_agg(value || ':' || CAST(n AS VARCHAR), ',' ORDER BY value) FILTER (label = 'segment') AS segment,
  string_agg(value || ':' || CAST(n AS VARCHAR), ',' ORDER BY value) FILTER (label = 'band') AS band FROM g GROUP BY region""",
)
def value_count_maps(t):
    counts = D.value_count_maps(fixtures.profile(t), ["region"], ["segment", "band"])
    return counts.select("region", D.map_text(F.col("segment")).alias("segment"), D.map_text(F.col("band")).alias("band"))


@query(
    "value_index",
    "A12",
    f"""WITH {PROFILE}, c AS (SELECT nation, unnest(['segment', 'band']) AS label, unnest([segment, band]) AS value FROM profile),
g AS (SELECT nation, label, value, count(*) AS n FROM c GROUP BY ALL),
x AS (SELECT *, n / sum(n) OVER (PARTITION BY nation, label) / (sum(n) OVER (PARTITION BY label, value) / sum(n) OVER (PARTITION BY label)) * 100 AS tgi FROM g),
grid AS (SELECT * FROM (SELECT DISTINCT nation, label FROM g) JOIN (SELECT DISTINCT label, value FROM g UNION SELECT 'band', '9') USING (label))
SELECT nation, label, value, round(coalesce(tgi, 0), 5) AS tgi FROM grid LEFT JOIN x USING (nation, label, value)""",
)
def value_index(t):
    counts = D.attribute_counts(fixtures.profile(t), ["nation"], ["segment", "band"])
    listed = counts.select("label", "value").distinct()
    listed = listed.unionByName(t.region.agg(F.lit("band").alias("label"), F.lit("9").alias("value")))
    scored = D.value_index(counts, "nation", "label", "value", "cnt", listed)
    return scored.select("nation", "label", "value", F.round("tgi", 5).alias("tgi"))


@query(
    "fill_counts",
    "A38",
    f"""WITH {PROFILE}, l AS (SELECT unnest(['segment', 'band', 'codes']) AS label, unnest([segment, band, codes]) AS value FROM profile)
SELECT label, count(*) FILTER (value IS NOT NULL AND value <> '-1' AND trim(value) <> '') AS filled, count(*) AS entities FROM l GROUP BY label""",
)
def fill_counts(t):
    return D.fill_counts(fixtures.tagged(t), ["segment", "band", "codes"])


@query(
    "top_values_text",
    "A42 W7",
    f"""WITH {PURCHASES}, c AS (SELECT l_suppkey, l_partkey, count(*) AS cnt FROM purchases GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY cnt DESC, l_partkey) AS rn FROM c)
SELECT l_suppkey, string_agg(CAST(l_partkey AS VARCHAR) || ':' || CAST(cnt AS VARCHAR), ',' ORDER BY rn) AS top_values FROM r WHERE rn <= 30 GROUP BY l_suppkey""",
)
def top_values_text(t):
    counts = fixtures.purchases(t).groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("cnt"))
    return D.top_values_text(counts, ["l_suppkey"], "l_partkey", "cnt", 30)


@query(
    "portrait_merge",
    "A43",
    f"""WITH {PROFILE}, v AS (SELECT region, unnest(string_split(codes, ',')) AS value FROM profile)
SELECT region, entities, interests FROM (SELECT region, count(*) AS entities FROM profile GROUP BY region)
LEFT JOIN (SELECT region, string_agg(value || ':' || CAST(n AS VARCHAR), ',' ORDER BY value) AS interests
  FROM (SELECT region, value, count(*) AS n FROM v GROUP BY ALL) GROUP BY region) USING (region)""",
)
def portrait_merge(t):
    rows = fixtures.profile(t)
    exploded = rows.select("region", F.explode(F.split("codes", ",")).alias("code"))
    interests = D.value_count_maps(exploded, ["region"], ["code"]).select("region", D.map_text(F.col("code")).alias("interests"))
    entities = rows.groupBy("region").agg(F.count("*").alias("entities"))
    return D.portrait_merge([entities, interests], ["region"])


@query(
    "list_enrichment",
    "J24",
    f"""WITH {PROFILE}, items AS (SELECT c_custkey, unnest(string_split(codes, ',')) AS code FROM profile),
dim AS (SELECT substr(o_orderpriority, 1, 1) AS code, max(o_orderpriority) AS category FROM orders GROUP BY 1),
info AS (SELECT CAST(s_nationkey AS VARCHAR) AS code, max(s_name) AS info FROM supplier GROUP BY 1)
SELECT c_custkey, code, category, info FROM items LEFT JOIN dim USING (code) LEFT JOIN info USING (code)""",
)
def list_enrichment(t):
    dim = t.orders.select(F.substring("o_orderpriority", 1, 1).alias("code"), F.col("o_orderpriority").alias("category"))
    info = t.supplier.select(F.col("s_nationkey").cast("string").alias("code"), F.col("s_name").alias("info"))
    return D.enrich_list(fixtures.profile(t), "c_custkey", "codes", dim, "code", info)


@query(
    "category_expansion",
    "J26",
    f"""WITH {PROFILE}, parents AS (SELECT DISTINCT CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'x' ELSE '' END || substr(o_orderpriority, 1, 1) AS id, 'L1-' || CAST(length(o_orderpriority) % 2 AS VARCHAR) AS c1,
  'L2-' || CAST(length(o_orderpriority) AS VARCHAR) AS c2 FROM orders),
i AS (SELECT c_custkey, unnest(string_split(codes, ',')) AS id FROM profile),
x AS (SELECT c_custkey, unnest([id, c1, c2]) AS v FROM i LEFT JOIN parents USING (id))
SELECT c_custkey, string_agg(v, ',' ORDER BY v) AS ids FROM (SELECT DISTINCT c_custkey, v FROM x WHERE v IS NOT NULL) GROUP BY c_custkey""",
)
def category_expansion(t):
    size = F.length("o_orderpriority")
    # One category has a parent under another id than the lists use.
    other = F.when(F.col("o_orderpriority") == "3-MEDIUM", "x").otherwise("")
    parents = t.orders.select(
        F.concat(other, F.substring("o_orderpriority", 1, 1)).alias("id"),
        F.concat(F.lit("L1-"), (size % 2).cast("string")).alias("category_1"),
        F.concat(F.lit("L2-"), size.cast("string")).alias("category_2"),
    ).distinct()
    return D.expand_categories(fixtures.profile(t), "c_custkey", "codes", parents)


@query(
    "label_table",
    "A17",
    """SELECT c_custkey, c_mktsegment AS segment, CASE WHEN trim(coalesce(region, '')) = '' THEN 'unknown'
  WHEN region IN ('ASIA', 'EUROPE') THEN region ELSE 'foreign' END AS region
FROM (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal < 1500 THEN ' ' ELSE r_name END AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
)
def label_table(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    region = F.when(F.col("c_acctbal") < 1500, " ").otherwise(F.col("r_name"))
    return rows.select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), D.normalise_region(region, ["ASIA", "EUROPE"]).alias("region")
    )


@query(
    "latest_row",
    "W1 W8",
    """SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, 'latest' AS which FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
UNION ALL SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day, 'earliest' AS which FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)""",
)
def latest_row(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    newest = ranking.latest_per_key(rows, ["o_custkey"], ["day", "o_orderkey"]).withColumn("which", F.lit("latest"))
    oldest = ranking.latest_per_key(rows, ["o_custkey"], ["day", "o_orderkey"], oldest=True)
    return newest.unionByName(oldest.withColumn("which", F.lit("earliest")))


@query(
    "global_numbering",
    "W4 W5 W6 W9",
    """WITH n AS (SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY c_name) AS idx, dense_rank() OVER (ORDER BY c_nationkey) AS nation_rank FROM customer)
SELECT c_custkey, idx, nation_rank, c_nationkey - min(c_nationkey) OVER () + 1 AS rebased FROM n""",
)
def global_numbering(t):
    numbered = ranking.global_index(t.customer.select("c_custkey", "c_name", "c_nationkey"), ["c_name"], "idx")
    ranked = ranking.global_dense_rank(numbered, "c_nationkey", "nation_rank")
    return ranking.rebased(ranked, "c_nationkey", "rebased").select("c_custkey", "idx", "nation_rank", "rebased")


@query(
    "sorted_unique_rows",
    "T4",
    "SELECT l_orderkey, min(l_partkey) AS l_partkey FROM lineitem GROUP BY l_orderkey",
)
def sorted_unique_rows(t):
    return ranking.sorted_unique_partitions(t.lineitem.select("l_orderkey", "l_partkey"), ["l_orderkey"], ["l_partkey"])


@query(
    "report_junk_share",
    "F11",
    f"""WITH {ATTRIBUTE_SHARES_SQL} SELECT region, label, value, round(share, 8) AS share FROM sh
WHERE value NOT IN ('other', '-1', 'unknown', '') AND share IS NOT NULL AND share > 0""",
)
def report_junk_share(t):
    shares = D.attribute_shares(fixtures.profile(t), ["region"], ["segment", "nation", "band"])
    kept = filters.drop_junk_shares(shares, "value", "share")
    return kept.select("region", "label", "value", F.round("share", 8).alias("share"))
