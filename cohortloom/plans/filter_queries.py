"""Audience filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import geo
from cohortloom.operators import distribution, filters
from cohortloom.plans import fixtures
from cohortloom.plans.registry import query

PROFILE = fixtures.PROFILE_SQL


@query(
    "attribute_filter",
    "F1",
    f"""WITH {PROFILE} SELECT c_custkey, segment, nation, codes FROM profile
WHERE segment IN ('BUILDING', 'MACHINERY') AND len(list_intersect(string_split(codes, ','), ['1', '2'])) > 0
  AND NOT coalesce(nation IN ('NATION_3', 'NATION_4'), false) AND NOT coalesce(len(list_intersect(string_split(codes, ','), ['5'])) > 0, false)""",
)
def attribute_filter(t):
    kept = filters.attribute_filter(
        fixtures.profile(t),
        include={"segment": "BUILDING,MACHINERY", "codes": "1,2", "region": ""},
        exclude={"nation": "NATION_3,NATION_4", "codes": "5"},
        single_valued=["segment", "nation", "region"],
    )
    return kept.select("c_custkey", "segment", "nation", "codes")


@query(
    "category_parent_filter",
    "F2",
    """SELECT p_partkey, cates FROM (SELECT p_partkey, p_type, substr(md5(p_brand), 1, 4) || '_' || CAST(p_size AS VARCHAR) || ',' || p_type AS cates, p_brand FROM part)
WHERE p_brand IN ('Brand#2', 'Brand#7') OR p_type = 'ECONOMY' OR substr(p_type, 1, 4) = 'PROM'""",
)
def category_parent_filter(t):
    cates = F.concat(F.substring(F.md5("p_brand"), 1, 4), F.lit("_"), F.col("p_size").cast("string"), F.lit(","), F.col("p_type"))
    parts = t.part.select("p_partkey", cates.alias("cates"))
    import hashlib

    wanted = [hashlib.md5(b.encode()).hexdigest()[:4] for b in ("Brand#2", "Brand#7")] + ["ECONOMY", "PROM"]
    return filters.attribute_filter(parts, {"cates": ",".join(wanted)}, {}, [], hierarchical=["cates"])


@query(
    "geohash_prefix_filter",
    "F3 X14",
    f"""WITH {fixtures.STAYS_SQL} SELECT entity, stay FROM stays
WHERE (floor((lat + 90) / 180 * 4096) = floor((20.3 + 90) / 180 * 4096) AND floor((lon + 180) / 360 * 8192) = floor((100.4 + 180) / 360 * 8192))""",
)
def geohash_prefix_filter(t):
    hashed = fixtures.stays(t).withColumn("hashes", F.concat_ws(",", F.lit(""), F.upper(geo.geohash(F.col("lat"), F.col("lon"), 5))))
    # Eight-character hash of (20.3, 100.4).
    kept = hashed.where(filters.geohash_prefix_match([F.col("hashes"), F.lit(None).cast("string")], ["w5x7kxt0"]))
    return kept.select("entity", "stay")


@query(
    "map_tag_filter",
    "F4",
    f"""WITH {PROFILE} SELECT c_custkey FROM profile
WHERE codes IS NOT NULL AND len(list_intersect(string_split(codes, ','), ['2', '3'])) > 0 AND NOT (band IN ('0', '1'))""",
)
def map_tag_filter(t):
    kept = filters.map_tag_filter(fixtures.tagged(t), include={"codes": "2,3"}, exclude={"band": "0,1", "absent": "x"})
    return kept.select("c_custkey")


@query(
    "numeric_tag_filter",
    "F5",
    f"""WITH {PROFILE} SELECT c_custkey, balance FROM profile WHERE (balance >= 2000 AND balance < 7000)
  AND (TRY_CAST(band AS DOUBLE) <= 0 OR TRY_CAST(band AS DOUBLE) > 1)""",
)
def numeric_tag_filter(t):
    rows = fixtures.profile(t)
    return rows.where(
        filters.numeric_condition(F.col("balance").cast("string"), ">=2000 & <7000")
        & filters.numeric_condition(F.col("band"), "<=0|>1")
    ).select("c_custkey", "balance")


@query(
    "in_not_in_filter",
    "F6",
    f"""WITH {PROFILE} SELECT c_custkey, region, segment, codes FROM profile
WHERE region IN ('ASIA', 'EUROPE') AND segment NOT IN ('FURNITURE') AND codes NOT IN ('1', '2')""",
)
def in_not_in_filter(t):
    rows = fixtures.profile(t).select("c_custkey", "region", "segment", "codes", "nation")
    kept = filters.list_filter(
        rows, {"region": ["ASIA", "EUROPE"], "nation": []}, {"segment": ["FURNITURE"], "codes": ["1", "2"]}
    )
    return kept.drop("nation")


@query(
    "tag_equality_filter",
    "F15",
    f"WITH {PROFILE} SELECT c_custkey FROM profile WHERE region = 'AFRICA' AND band = '2'",
)
def tag_equality_filter(t):
    return fixtures.tagged(t).where(filters.tag_equality(F.col("tags"), {"region": "AFRICA", "band": "2"})).select("c_custkey")


@query(
    "tag_projection",
    "F17 X5",
    f"""WITH {PROFILE} SELECT c_custkey, concat_ws(';', 'codes=' || codes, CASE WHEN region = 'ASIA' THEN 'region=ASIA' END) AS kept FROM profile
WHERE codes IS NOT NULL OR region = 'ASIA'""",
)
def tag_projection(t):
    from cohortloom.functions import maps

    # Regions other than ASIA are blanked first, so the blank clean-up shows.
    blanked = fixtures.tagged(t).withColumn(
        "tags",
        maps.clean_map(
            F.transform_values("tags", lambda k, v: F.when((k == "region") & (v != "ASIA"), " ").otherwise(v))
        ),
    )
    kept = filters.project_tags(blanked, ["codes", "region"], ["tags"])
    return kept.select("c_custkey", fixtures.map_text(F.col("tags")).alias("kept"))


@query(
    "confidence_cleanup",
    "F18",
    f"""WITH {PROFILE} SELECT c_custkey, concat_ws(';', CASE WHEN band <> '-1' THEN 'band=0.9' END, CASE WHEN codes IS NOT NULL THEN 'codes=0.8' END) AS confidence
FROM profile WHERE band <> '-1' OR codes IS NOT NULL""",
)
def confidence_cleanup(t):
    from cohortloom.functions import maps

    given = F.create_map(*[F.lit(x) for x in ("band", "0.9", "codes", "0.8", "gone", "0.1")])
    cleaned = fixtures.tagged(t).select("c_custkey", maps.clean_confidence(given, F.col("tags")).alias("c"))
    return cleaned.where("c is not null").select("c_custkey", fixtures.map_text(F.col("c")).alias("confidence"))


@query(
    "selection_by_item",
    "F19",
    f"""WITH {fixtures.PURCHASES_SQL} SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM purchases WHERE l_partkey IN (1, 5, 9, 100))""",
)
def selection_by_item(t):
    return _selection(t, "l_partkey", [1, 5, 9, 100])


@query(
    "selection_by_category",
    "F19",
    f"""WITH {fixtures.PURCHASES_SQL} SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM purchases JOIN part ON l_partkey = p_partkey WHERE p_type = 'PROMO' AND p_brand = 'Brand#3')""",
)
def selection_by_category(t):
    return _selection(t, "category", ["PROMO/Brand#3"])


def _selection(t, level, wanted):
    categories = t.part.select(F.col("p_partkey").alias("l_partkey"), F.concat_ws("/", "p_type", "p_brand").alias("category"))
    activity = fixtures.purchases(t).select(F.col("o_custkey").alias("c_custkey"), "l_partkey")
    return filters.optimise_selection(
        t.customer.select("c_custkey", "c_name"), activity, categories, "c_custkey", "l_partkey", level, wanted
    )


@query(
    "report_threshold",
    "F20 T1",
    f"""WITH {fixtures.PURCHASES_SQL}, s AS (SELECT l_partkey, count(DISTINCT o_custkey) AS cnt FROM purchases GROUP BY l_partkey)
SELECT l_partkey, cnt, round(cnt / (SELECT count(DISTINCT o_custkey) FROM purchases), 6) AS install_percent FROM s
WHERE cnt / (SELECT count(DISTINCT o_custkey) FROM purchases) > 0.02 ORDER BY cnt DESC, l_partkey LIMIT 200""",
)
def report_threshold(t):
    shares = distribution.penetration(fixtures.purchases(t), "l_partkey", "o_custkey")
    kept = filters.report_threshold(shares, {"penetration": 0.02})
    ordered = kept.orderBy(F.desc("cnt"), F.asc("l_partkey")).limit(200)
    return ordered.select("l_partkey", "cnt", F.round("penetration", 6).alias("install_percent"))


@query(
    "junk_share_filter",
    "F11 A9",
    f"""WITH {PROFILE}, c AS (SELECT band AS value, count(*) AS cnt FROM profile GROUP BY band),
s AS (SELECT value, cnt * 1.0 / (SELECT sum(cnt) FROM c) AS share FROM c)
SELECT 'band' AS label, value, round(share / sum(share) OVER (), 9) AS final_share FROM s WHERE value <> '-1' AND share > 0""",
)
def junk_share_filter(t):
    shares = distribution.attribute_shares(fixtures.profile(t), [], ["band"])
    final = distribution.renormalise(shares, [])
    return final.select("label", "value", F.round(F.col("final_share").cast("double"), 9).alias("final_share"))
