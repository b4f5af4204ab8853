"""Tag store merges, entity resolution and profile assembly."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cohortloom.functions import dates, maps
from cohortloom.operators import lookup, sets, tags
from cohortloom.plans import fixtures
from cohortloom.plans.fixtures import map_text
from cohortloom.plans.registry import query
from cohortloom.session import scratch_path
from cohortloom.sources import buckets, sinks

HISTORY = fixtures.HISTORY_SQL
PROFILE = fixtures.PROFILE_SQL

LATEST_SQL = f"""{HISTORY}, d AS (SELECT o_custkey, tag, day, max(value) AS value FROM history GROUP BY ALL),
latest AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY o_custkey, tag ORDER BY day DESC) = 1)"""


@query("latest_wins_merge", "A22", f"WITH {LATEST_SQL} SELECT o_custkey, tag, day, value FROM latest")
def latest_wins_merge(t):
    # Two halves merged separately and then together: the merge is associative.
    rows = fixtures.history(t)
    cut = F.lit(date(1998, 1, 1))
    old = tags.latest_wins(rows.where(F.col("day") < cut), "o_custkey")
    new = tags.latest_wins(rows.where(F.col("day") >= cut), "o_custkey")
    return tags.latest_wins(old.unionByName(new), "o_custkey")


@query(
    "timed_tag_map",
    "A22",
    f"""WITH {LATEST_SQL} SELECT o_custkey, string_agg(tag || '=' || CAST(day AS VARCHAR) || '@' || value, ';' ORDER BY tag) AS tags FROM latest GROUP BY o_custkey""",
)
def timed_tag_map(t):
    timed = tags.to_timed_map(tags.latest_wins(fixtures.history(t), "o_custkey"), "o_custkey")
    shown = F.transform_values("tags", lambda _, v: F.concat_ws("@", v["day"].cast("string"), v["value"]))
    return timed.select("o_custkey", map_text(shown).alias("tags"))


@query(
    "pairs_to_map",
    "A28 X18 X23",
    f"""WITH {LATEST_SQL}, f AS (SELECT * FROM d WHERE NOT (tag = 'price' AND value = '0')),
l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY o_custkey, tag ORDER BY day DESC) = 1)
SELECT o_custkey, string_agg(tag || '=' || value, ';' ORDER BY tag) AS tags FROM l GROUP BY o_custkey""",
)
def pairs_to_map(t):
    price = F.floor(F.col("o_totalprice") / 100000).cast("string")
    pair = lambda k, v: F.concat(F.lit(k + maps.KEY_SEPARATOR), v)
    text = F.concat_ws(
        maps.PAIR_SEPARATOR,
        pair("status", F.col("o_orderstatus")),
        pair("priority", F.col("o_orderpriority")),
        # Blank values drop in the parser.
        pair("price", F.when(price == "0", " ").otherwise(price)),
    )
    rows = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), text.alias("kv"))
    return tags.pairs_to_map(rows, "o_custkey", "kv", "day").select("o_custkey", map_text(F.col("tags")).alias("tags"))


@query(
    "wide_to_tags",
    "A29",
    """SELECT * FROM (SELECT c_custkey, unnest(['1_1000', '2_1000', '3_1000']) AS tag, unnest([c_name, CAST(c_nationkey AS VARCHAR), CASE WHEN c_mktsegment = 'BUILDING' THEN ' ' ELSE c_mktsegment END]) AS value FROM customer) WHERE trim(value) <> ''""",
)
def wide_to_tags(t):
    blank = F.when(F.col("c_mktsegment") == "BUILDING", " ").otherwise(F.col("c_mktsegment"))
    wide = t.customer.withColumn("c_mktsegment", blank)
    return tags.unpivot_tags(wide, ["c_custkey"], {"c_name": "1_1000", "c_nationkey": "2_1000", "c_mktsegment": "3_1000"})


@query(
    "window_tags",
    "A29",
    """SELECT user_id, event_type || '_' || CAST(n % 2 AS VARCHAR) || '_7' AS tag, CAST(n AS VARCHAR) AS value
FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)""",
)
def window_tags(t):
    counts = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    flagged = counts.withColumn("flag", F.col("n") % 2).withColumn("window", F.lit(7))
    return tags.window_tags(flagged, "user_id", "flag", "window", "event_type", "n")


@query(
    "group_tags_by_category",
    "A30",
    f"""WITH {PROFILE}, r AS (SELECT c_custkey, unnest(['segment', 'nation', 'region', 'band', 'codes']) AS tag, unnest([segment, nation, region, band, codes]) AS value FROM profile),
p AS (SELECT unnest(['nation', 'region', 'segment', 'band']) AS tag, unnest(['place', 'place', 'market', 'market']) AS category)
SELECT c_custkey, string_agg(category || '=' || ids || '#' || vals, ';' ORDER BY category) AS grouped FROM (
  SELECT c_custkey, category, string_agg(tag, ',' ORDER BY tag) AS ids, string_agg(value, ',' ORDER BY tag) AS vals FROM r JOIN p USING (tag) WHERE value IS NOT NULL GROUP BY ALL) GROUP BY c_custkey""",
)
def group_tags_by_category(t):
    cells = [("nation", "place"), ("region", "place"), ("segment", "market"), ("band", "market")]
    parents = t.spark.createDataFrame(cells, "tag string, category string")
    grouped = tags.grouped_map(tags.group_by_category(fixtures.tagged(t), "c_custkey", parents), "c_custkey")
    shown = F.transform_values("grouped_tags", lambda _, v: F.translate(v, maps.KEY_SEPARATOR, "#"))
    return grouped.select("c_custkey", map_text(shown).alias("grouped"))


MERGE_SQL = f"""{HISTORY}, s AS (SELECT o_custkey, tag, day < DATE '2000-01-01' AS old, day, max(value) AS value FROM history WHERE NOT (day >= DATE '2000-01-01' AND tag = 'price') GROUP BY ALL),
l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY o_custkey, old, tag ORDER BY day DESC) = 1),
w AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY o_custkey, tag ORDER BY old) = 1),
tops AS (SELECT o_custkey, max(value) FILTER (NOT old) AS nt, max(value) FILTER (old) AS ot, max(day) AS update_time FROM l GROUP BY o_custkey)"""


@query(
    "tag_full_increment_merge",
    "A31",
    f"""WITH {MERGE_SQL} SELECT o_custkey, any_value(update_time) AS update_time, any_value(coalesce(nt, ot)) AS top, string_agg(tag || '=' || value, ';' ORDER BY tag) AS tags
FROM w JOIN tops USING (o_custkey) GROUP BY o_custkey""",
)
def tag_full_increment_merge(t):
    merged = tags.merge_full_increment(*_merge_sides(t), "o_custkey", ["tags"], ["top"], "update_time")
    return merged.select("o_custkey", "update_time", "top", map_text(F.col("tags")).alias("tags"))


def _merge_sides(t):
    """Tag maps with a summary, before and after a day."""
    cut = F.lit(date(2000, 1, 1))
    rows = fixtures.history(t)

    def side(part):
        latest = tags.latest_wins(part, "o_custkey")
        summary = latest.groupBy("o_custkey").agg(F.max("day").alias("update_time"), F.max("value").alias("top"))
        return tags.to_map(latest, "o_custkey").join(summary, "o_custkey")

    full = side(rows.where(F.col("day") < cut))
    increment = side(rows.where((F.col("day") >= cut) & (F.col("tag") != "price")))
    return full, increment


@query(
    "bucketed_tag_merge",
    "A31",
    f"""WITH {MERGE_SQL} SELECT o_custkey, any_value(update_time) AS update_time, any_value(coalesce(nt, ot)) AS top, string_agg(tag || '=' || value, ';' ORDER BY tag) AS tags
FROM w JOIN tops USING (o_custkey) GROUP BY o_custkey""",
)
def bucketed_tag_merge(t):
    """As ``tag_full_increment_merge``, the stored side bucketed by its key."""
    full, increment = _merge_sides(t)
    table = buckets.store(full, ["o_custkey"], buckets.buckets_for(full.count()), "tags")

    def merge(stored, new):
        return tags.merge_full_increment(stored, new, "o_custkey", ["tags"], ["top"], "update_time")

    merged = buckets.merge_stored(t.spark, table, increment, ["o_custkey"], merge)
    return merged.select("o_custkey", "update_time", "top", map_text(F.col("tags")).alias("tags"))


@query(
    "stamped_tag_update",
    "A32",
    f"""WITH {MERGE_SQL}, i AS (SELECT o_custkey FROM l WHERE NOT old AND tag = 'status' AND value = 'O'),
x AS (SELECT o_custkey, tag, CASE WHEN old THEN 'old' ELSE 'new' END AS stamp, value, old FROM l
  WHERE NOT (old AND tag IN ('priority', 'price') AND o_custkey IN (SELECT o_custkey FROM i)) AND NOT (NOT old AND tag = 'priority' AND o_custkey NOT IN (SELECT o_custkey FROM i))),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY o_custkey, tag ORDER BY old) = 1)
SELECT o_custkey, string_agg(tag || '=' || stamp || '@' || value, ';' ORDER BY tag) AS tags FROM y GROUP BY o_custkey""",
)
def stamped_tag_update(t):
    cut = F.lit(date(2000, 1, 1))
    rows = fixtures.history(t)
    old = tags.to_map(tags.latest_wins(rows.where(F.col("day") < cut), "o_custkey"), "o_custkey")
    old = old.withColumn("tags", F.transform_values("tags", lambda _, v: F.struct(v.alias("value"), F.lit("old").alias("day"))))
    newest = tags.latest_wins(rows.where((F.col("day") >= cut) & (F.col("tag") != "price")), "o_custkey")
    new = tags.to_map(newest, "o_custkey")
    # The increment brings the list tag "priority" only when the status is open.
    is_open = F.try_element_at("tags", F.lit("status")) == "O"
    new = new.withColumn("tags", F.map_filter("tags", lambda k, _: (k != "priority") | is_open))
    updated = tags.stamped_update(old, new, "o_custkey", F.lit("new"), ["priority", "price"])
    shown = F.transform_values("tags", lambda _, v: F.concat_ws("@", v["day"], v["value"]))
    return updated.select("o_custkey", map_text(shown).alias("tags"))


@query(
    "period_tag_build",
    "A33",
    f"""WITH {HISTORY}, due AS (SELECT * FROM history WHERE (tag = 'status' AND day = DATE '1998-05-16') OR (tag = 'priority' AND day = DATE '1998-04-30') OR (tag = 'price' AND day = DATE '1997-12-31')),
d AS (SELECT o_custkey, tag, day, max(value) AS value FROM due GROUP BY ALL) SELECT o_custkey, tag, day, value FROM d""",
)
def period_tag_build(t):
    today = F.lit(date(1998, 5, 17))
    ends = {p: dates.period_end(today, p) for p in ("day", "month", "year")}
    period = F.when(F.col("tag") == "status", "day").when(F.col("tag") == "priority", "month").otherwise("year")
    return tags.period_tags(fixtures.history(t).withColumn("period", period), "o_custkey", "day", ends, "period")


RESOLVE_SQL = """raw AS (SELECT o_orderkey % 3 AS k, CAST(o_custkey AS VARCHAR) AS v, o_orderstatus AS channel, o_orderpriority AS label,
  CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 2 ELSE 1 END AS flag FROM orders),
f AS (SELECT flag, CASE WHEN k = 0 THEN v END AS plain, CASE WHEN k < 2 THEN md5(v) END AS md5, CASE WHEN k <> 1 THEN sha256(v) END AS sha256,
  CASE k WHEN 0 THEN 'phone' WHEN 1 THEN 'phonemd5' ELSE 'phonesha256' END AS type, channel, substr(label, 1, 1) AS tag, CAST(length(label) AS VARCHAR) || CAST(flag AS VARCHAR) AS value FROM raw),
g AS (SELECT *, CASE WHEN max(plain) OVER (PARTITION BY coalesce(md5, sha256), channel, md5 IS NULL) IS NOT NULL THEN 1 ELSE 0 END AS known FROM f),
e AS (SELECT *, CASE WHEN md5 IS NOT NULL AND known = 0 THEN 'm' || md5 ELSE 's' || coalesce(sha256, max(sha256) OVER (PARTITION BY md5, channel)) END AS grp FROM g),
l AS (SELECT grp, channel, tag, arg_min(value, CAST(flag AS VARCHAR) || value) AS value FROM e GROUP BY ALL)"""


@query(
    "entity_resolution",
    "A34",
    f"""WITH {RESOLVE_SQL}, a AS (SELECT grp, channel, min(flag) AS flag, max(plain) AS plain, max(md5) AS md5, max(sha256) AS sha256, string_agg(DISTINCT type, ',' ORDER BY type) AS types FROM e GROUP BY ALL)
SELECT flag, plain, md5, sha256, types, channel, (SELECT string_agg(tag || '=' || value, ';' ORDER BY tag) FROM l WHERE l.grp = a.grp AND l.channel = a.channel) AS label FROM a""",
)
def entity_resolution(t):
    kind = F.element_at(F.array(F.lit("phone"), F.lit("phoneMD5"), F.lit("phoneSHA256")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    plain = F.col("o_custkey").cast("string")
    value = F.when(kind == "phone", plain).when(kind == "phoneMD5", F.md5(plain)).otherwise(F.sha2(plain, 256))
    flag = F.when(F.col("o_orderdate") < "2000-01-01", 2).otherwise(1)
    label = F.create_map(
        F.substring("o_orderpriority", 1, 1), F.concat(F.length("o_orderpriority").cast("string"), flag.cast("string"))
    )
    rows = t.orders.select(
        value.alias("value"), kind.alias("type"), label.alias("label"), F.col("o_orderstatus").alias("channel"), flag.alias("f")
    )
    new = tags.label_relation_rows(rows.where("f = 1"))
    stored = tags.label_relation_rows(rows.where("f = 2")).withColumn("flag", F.lit(2))
    resolved = tags.resolve_entities(new.unionByName(stored))
    types = F.lower(F.array_join("types", ","))
    return resolved.select("flag", "plain", "md5", "sha256", types.alias("types"), "channel", map_text(F.col("label")).alias("label"))


@query(
    "hub_merge",
    "J6 X6 S6",
    """WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
r AS (SELECT CASE WHEN c_acctbal > 3000 THEN c_custkey ELSE -1 - c_custkey END AS c_custkey, c_mktsegment FROM customer)
SELECT CAST(o_custkey AS VARCHAR) AS id, concat_ws(';', 'extra=' || c_mktsegment, 'seed=' || CASE WHEN {side} THEN 'result' ELSE o_orderpriority END) AS feature
FROM o LEFT JOIN r ON o_custkey = c_custkey""".replace("{side}", "c_custkey IS NOT NULL"),
)
def hub_merge(t):
    return _hub(t, "right")


@query(
    "hub_merge_seed_wins",
    "J6 X6",
    """WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
r AS (SELECT CASE WHEN c_acctbal > 3000 THEN c_custkey ELSE -1 - c_custkey END AS c_custkey, c_mktsegment FROM customer)
SELECT CAST(o_custkey AS VARCHAR) AS id, concat_ws(';', 'extra=' || c_mktsegment, 'seed=' || o_orderpriority) AS feature FROM o LEFT JOIN r ON o_custkey = c_custkey""",
)
def hub_merge_seed_wins(t):
    return _hub(t, "left")


def _hub(t, prefer):
    empty = F.array().cast("array<string>")
    hub = t.orders.select(
        F.col("o_custkey").cast("string").alias("id"),
        "o_orderkey",
        F.create_map(F.lit("seed"), F.array("o_orderpriority"), F.lit("none"), empty).alias("feature"),
    )
    # Poorer customers have results under ids that are not in the hub.
    owner = F.when(F.col("c_acctbal") > 3000, F.col("c_custkey")).otherwise(-1 - F.col("c_custkey"))
    results = t.customer.select(
        owner.cast("string").alias("id"),
        F.create_map(F.lit("seed"), F.array(F.lit("result")), F.lit("extra"), F.array("c_mktsegment")).alias("feature"),
    )
    # A map cannot be compared, so the hub row order is its key alone.
    merged = lookup.hub_join(hub, results, "id", ["o_orderkey"], prefer)
    shown = F.transform_values("feature", lambda _, v: F.array_join(v, ","))
    return merged.select("id", map_text(shown).alias("feature"))


@query(
    "list_merges",
    "X7 X9",
    """SELECT o_orderkey, concat_ws(',', substr(o_orderpriority, 1, 1), CASE WHEN substr(o_orderpriority, 1, 1) <> o_orderstatus THEN o_orderstatus END, 'Z') AS merged,
  'a=' || o_orderstatus || ',Z;b=Z' AS keyed FROM orders""",
)
def list_merges(t):
    old = F.array(F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"))
    new = F.array(F.col("o_orderstatus"), F.lit("Z"))
    keyed = maps.merge_keyed_lists(
        F.create_map(F.lit("a"), F.array("o_orderstatus")), F.create_map(F.lit("a"), F.array(F.lit("Z")), F.lit("b"), F.array(F.lit("Z")))
    )
    return t.orders.select(
        "o_orderkey",
        F.array_join(maps.append_new(old, new), ",").alias("merged"),
        map_text(F.transform_values(keyed, lambda _, v: F.array_join(v, ","))).alias("keyed"),
    )


@query(
    "tag_translation",
    "J22",
    f"""WITH {PROFILE}, r AS (SELECT c_custkey, unnest(['segment', 'nation', 'region', 'band', 'codes']) AS k, unnest([segment, nation, region, band, codes]) AS v FROM profile),
p AS (SELECT DISTINCT CASE WHEN o_orderpriority = '5-LOW' THEN 'x' ELSE '' END || substr(o_orderpriority, 1, 1) AS code, o_orderpriority AS name FROM orders),
x AS (SELECT c_custkey, k, generate_subscripts(string_split(v, ','), 1) AS i, unnest(string_split(v, ',')) AS code FROM r WHERE v IS NOT NULL)
SELECT c_custkey, CASE k WHEN 'band' THEN 'balance band' WHEN 'codes' THEN 'priorities' ELSE k END AS tag, string_agg(coalesce(name, code), ',' ORDER BY i) AS value
FROM x LEFT JOIN p USING (code) GROUP BY c_custkey, k""",
)
def tag_translation(t):
    # One priority is known under another code than the profiles use.
    other = F.when(F.col("o_orderpriority") == "5-LOW", "x").otherwise("")
    values = t.orders.select(
        F.lit("value").alias("kind"), F.concat(other, F.substring("o_orderpriority", 1, 1)).alias("code"), F.col("o_orderpriority").alias("name")
    ).distinct()
    names = t.spark.createDataFrame([("key", "band", "balance band"), ("key", "codes", "priorities")], "kind string, code string, name string")
    return lookup.translate_map(fixtures.tagged(t), "c_custkey", "tags", values.unionByName(names))


@query(
    "profile_assembly",
    "J27 O3",
    """WITH a AS (SELECT CASE WHEN c_acctbal > 2000 THEN c_custkey ELSE -1 - c_custkey END AS key, c_name AS name, '2000-01-01' AS tm FROM customer),
b AS (SELECT o_custkey AS key, max(o_orderpriority) AS priority, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS tm FROM orders GROUP BY 1),
c AS (SELECT user_id AS key, count(*) AS n_events, ' ' AS tm FROM events GROUP BY 1)
SELECT key, name, priority, n_events, greatest(a.tm, b.tm) AS update_time FROM a FULL JOIN b USING (key) FULL JOIN c USING (key)""",
)
def profile_assembly(t):
    # Poorer customers have a key of their own, which no other source knows.
    key = F.when(F.col("c_acctbal") > 2000, F.col("c_custkey")).otherwise(-1 - F.col("c_custkey"))
    a = t.customer.select(key.alias("key"), F.col("c_name").alias("name"), F.lit("2000-01-01").alias("update_time"))
    b = t.orders.groupBy(F.col("o_custkey").alias("key")).agg(
        F.max("o_orderpriority").alias("priority"), F.max(F.to_date("o_orderdate")).cast("string").alias("update_time")
    )
    c = t.events.groupBy(F.col("user_id").alias("key")).agg(F.count("*").alias("n_events"), F.lit(" ").alias("update_time"))
    return tags.assemble_profiles([a, b, c], "key", "update_time")


@query(
    "category_slices",
    "K11",
    f"""WITH {PROFILE} SELECT c_custkey, 'place' AS category, 'nation=' || nation || ';region=' || region AS tags FROM profile
UNION ALL SELECT c_custkey, 'interest', 'codes=' || codes FROM profile WHERE codes IS NOT NULL""",
)
def category_slices(t):
    slices = tags.split_by_category(fixtures.tagged(t), "c_custkey", {"place": ["nation", "region"], "interest": ["codes"], "none": ["x"]})
    path = scratch_path(t.spark, "categories")
    sinks.category_slices(slices, path)
    return t.spark.read.parquet(path).select("c_custkey", "category", map_text(F.col("tags")).alias("tags"))


@query(
    "sparse_text",
    "X17 X18 X19",
    """SELECT o_orderkey, CASE WHEN o_orderkey = 0 THEN 'status,price=' WHEN o_orderkey % 2 = 0 THEN 'status,key,price=' ELSE 'status,key,flag,price=' END AS names,
  CAST(nullif(o_orderkey, 0) AS VARCHAR) AS key_text, printf('%.4f', o_totalprice) AS price_text, CASE WHEN o_orderkey = 0 THEN 2 ELSE CAST(3 + o_orderkey % 2 AS BIGINT) END AS n FROM orders""",
)
def sparse_text(t):
    from cohortloom.functions import text

    packed = text.pack_nonzero(
        ["status", "key", "flag", "price"],
        [F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_orderkey") % 2, F.col("o_totalprice").cast("decimal(18,2)")],
    )
    rows = t.orders.select("o_orderkey", packed.alias("packed"))
    parsed = maps.parse_sparse(F.col("packed"))
    return rows.select("o_orderkey", "packed", parsed.alias("cells")).select(
        "o_orderkey",
        F.concat(F.substring_index("packed", "=", 1), F.lit("=")).alias("names"),
        # Zero is not packed, so order 0 has no key.
        text.plain_number(F.get(F.filter("cells", lambda c: c["index"] == "key"), F.lit(0))["value"].cast("double")).alias("key_text"),
        F.element_at("cells", -1)["value"].alias("price_text"),
        F.size("cells").cast("long").alias("n"),
    )


@query(
    "distinct_sources",
    "O3 O4",
    "SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier",
)
def distinct_sources(t):
    return sets.distinct_union(
        "nationkey", t.customer.select(F.col("c_nationkey").alias("nationkey")), t.supplier.select(F.col("s_nationkey").alias("nationkey"))
    )
