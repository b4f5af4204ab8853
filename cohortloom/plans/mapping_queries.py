"""Mapping build, merge and lookup; as-of matching and change points."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cohortloom.functions import keys as K
from cohortloom.operators import asof, lookup, mapping, ranking
from cohortloom.plans import fixtures
from cohortloom.plans.fixtures import struct_list_text
from cohortloom.plans.registry import query
from cohortloom.sources import buckets, tables

PURCHASES = fixtures.PURCHASES_SQL
PROFILE = fixtures.PROFILE_SQL

SEEN_SQL = f"""{PURCHASES}, seen AS (SELECT o_custkey, l_partkey AS id, min(day) AS f, max(day) AS l FROM purchases GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY l DESC, id DESC) AS rn FROM seen)"""
IDS_TEXT = "string_agg(CAST(l AS VARCHAR) || ':' || CAST(id AS VARCHAR) || ':' || CAST(f AS VARCHAR), ';' ORDER BY l DESC, id DESC)"


def _state(t, rows=None, most=None):
    rows = fixtures.purchases(t) if rows is None else rows
    return mapping.first_last_seen(rows, "o_custkey", "l_partkey", "day", "day", most)


def _ids(t, limit):
    return mapping.newest_ids(_state(t), "o_custkey", limit)


def _text(ids):
    return struct_list_text(ids, "last_seen", "id", "first_seen")


@query(
    "mapping_build",
    "A24",
    f"WITH {SEEN_SQL} SELECT o_custkey, {IDS_TEXT} AS ids, max(l) AS update_time FROM ranked WHERE rn <= 20 GROUP BY o_custkey",
)
def mapping_build(t):
    return _ids(t, 20).select("o_custkey", _text(F.col("ids")).alias("ids"), "update_time")


INVERT_SQL = """wide AS (SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m%d') AS tm FROM orders),
r AS (SELECT CAST(unnest([o_custkey, o_custkey % 97]) AS VARCHAR) AS key, CAST(o_orderkey AS VARCHAR) AS id, tm FROM wide),
s AS (SELECT key, id, min(tm) AS first_seen, max(tm) AS last_seen FROM r GROUP BY ALL)"""


@query(
    "mapping_inversion",
    "A25",
    f"WITH {INVERT_SQL} SELECT key, id, first_seen, last_seen FROM s",
)
def mapping_inversion(t):
    tm = F.date_format("o_orderdate", "yyyyMMdd")
    wide = t.orders.select(
        F.col("o_orderkey").cast("string").alias("entity"),
        F.concat_ws(",", F.col("o_custkey").cast("string"), (F.col("o_custkey") % 97).cast("string"), F.lit(" ")).alias("x"),
        F.concat_ws(",", tm, tm, tm).alias("x_tm"),
        F.concat_ws(",", tm, tm, tm).alias("x_ltm"),
    )
    return mapping.invert(wide, "entity", "x", "x_tm", "x_ltm")


@query(
    "mapping_merge",
    "J8 J8m",
    f"WITH {SEEN_SQL} SELECT o_custkey, {IDS_TEXT} AS ids, max(l) AS update_time FROM ranked WHERE rn <= 30 GROUP BY o_custkey",
)
def mapping_merge(t):
    cut = F.lit(date(1998, 6, 30))
    rows, most = fixtures.purchases(t), t.lineitem.count()
    full, increment = _state(t, rows.where(F.col("day") <= cut), most), _state(t, rows.where(F.col("day") > cut), most)
    merged = mapping.newest_ids(mapping.merge_full_increment(full, increment, "o_custkey", most), "o_custkey", 30)
    return merged.select("o_custkey", _text(F.col("ids")).alias("ids"), "update_time")


@query(
    "bucketed_mapping_merge",
    "J8 J8m",
    f"WITH {SEEN_SQL} SELECT o_custkey, {IDS_TEXT} AS ids, max(l) AS update_time FROM ranked WHERE rn <= 30 GROUP BY o_custkey",
)
def bucketed_mapping_merge(t):
    """Two daily merges into a stored state bucketed by (key, id); the state is never shuffled."""
    rows, keys = fixtures.purchases(t), ["o_custkey", "id"]
    cuts = [F.lit(date(1997, 6, 30)), F.lit(date(1998, 6, 30))]
    full = _state(t, rows.where(F.col("day") <= cuts[0]))
    number = buckets.buckets_for(t.lineitem.count())
    table = buckets.store(full, keys, number, "mapping")

    def merge(stored, new):
        return buckets.merged_state(stored, new, keys, "first_seen", "last_seen")

    between = _state(t, rows.where((F.col("day") > cuts[0]) & (F.col("day") <= cuts[1])))
    table = buckets.store(buckets.merge_stored(t.spark, table, between, keys, merge), keys, number, "mapping", in_place=True)
    merged = buckets.merge_stored(t.spark, table, _state(t, rows.where(F.col("day") > cuts[1])), keys, merge)
    return mapping.newest_ids(merged, "o_custkey", 30).select("o_custkey", _text(F.col("ids")).alias("ids"), "update_time")


@query(
    "pair_expansion",
    "A35 W8",
    """WITH p AS (SELECT 'c' || CAST(o_custkey AS VARCHAR) AS a, 's' || CAST(l_suppkey AS VARCHAR) AS b, CAST(l_shipdate AS DATE) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
u AS (SELECT a AS owner, b AS other, day FROM p UNION ALL SELECT b, a, day FROM p)
SELECT owner, other, min(day) AS first_seen FROM u GROUP BY ALL""",
)
def pair_expansion(t):
    rows = fixtures.purchases(t).select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("a"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("b"),
        "day",
    )
    cut = F.lit(date(1999, 1, 1))
    stored = mapping.pair_expansion(rows.where(F.col("day") < cut), "a", "b", "day")
    return mapping.merge_pairs(stored, mapping.pair_expansion(rows.where(F.col("day") >= cut), "a", "b", "day"))


@query(
    "collected_pairs",
    "A35",
    f"""WITH {PURCHASES}, u AS (SELECT o_custkey AS owner, l_suppkey AS other, min(day) AS f FROM purchases GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY owner ORDER BY f, other) AS rn FROM u)
SELECT owner, string_agg(CAST(f AS VARCHAR) || ':' || CAST(other AS VARCHAR), ';' ORDER BY f, other) AS others FROM r WHERE rn <= 10 GROUP BY owner""",
)
def collected_pairs(t):
    pairs = fixtures.purchases(t).groupBy(F.col("o_custkey").alias("owner"), F.col("l_suppkey").alias("other")).agg(
        F.min("day").alias("first_seen")
    )
    return mapping.collected_pairs(pairs, 10).select("owner", struct_list_text(F.col("others"), "first_seen", "other").alias("others"))


@query(
    "latest_elements",
    "A36",
    f"""WITH {PURCHASES}, d AS (SELECT DISTINCT o_custkey, l_suppkey % 5 AS kind, l_partkey, day FROM purchases),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, kind ORDER BY day DESC, l_partkey DESC) AS rn FROM d)
SELECT o_custkey, kind, string_agg(CAST(day AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR), ';' ORDER BY rn) AS elements
FROM r WHERE rn <= 5 GROUP BY ALL""",
)
def latest_elements(t):
    rows = fixtures.purchases(t).withColumn("kind", F.col("l_suppkey") % 5)
    listed = mapping.latest_elements(rows, ["o_custkey", "kind"], "l_partkey", "day", 5)
    return listed.select("o_custkey", "kind", struct_list_text(F.col("elements"), "day", "l_partkey").alias("elements"))


def _lookup_sides(t, mapped):
    """Seeds as plain names, and a mapping keyed by the md5 of their canonical form."""
    names = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_name"))
    rest = [c for c in mapped.columns if c != "o_custkey"]
    keyed = mapped.join(names, "o_custkey").select(K.canonical(F.col("c_name"), case="upper", kind="md5").alias("seed"), *rest)
    sellers = t.supplier.select(F.col("s_name").alias("seed"))
    seeds = t.customer.select(F.concat(F.lit(" "), F.lower("c_name")).alias("seed")).unionByName(sellers)
    return seeds, keyed, K.canonical(F.col("seed"), case="upper", kind="md5")


def _lookup(t, limit):
    seeds, keyed, canonical = _lookup_sides(t, _ids(t, limit).select("o_custkey", "ids"))
    return lookup.latest_matches(lookup.match(seeds, keyed, "seed", canonical), {"ids": limit})


LOOKUP_SQL = f"""{SEEN_SQL}, m AS (SELECT c_name, o_custkey FROM customer JOIN (SELECT DISTINCT o_custkey FROM purchases) ON c_custkey = o_custkey),
seeds AS (SELECT ' ' || lower(c_name) AS seed, c_name AS k FROM customer UNION ALL SELECT s_name, s_name FROM supplier)"""


@query(
    "key_lookup_latest",
    "J1 J2 J3 J7",
    f"""WITH {LOOKUP_SQL} SELECT seed, string_agg(CAST(id AS VARCHAR), ',' ORDER BY rn) AS ids
FROM seeds LEFT JOIN m ON k = c_name LEFT JOIN (SELECT * FROM ranked WHERE rn <= 3) r ON r.o_custkey = m.o_custkey GROUP BY seed""",
)
def key_lookup_latest(t):
    ids = F.array_join(F.transform("ids", lambda s: s["id"].cast("string")), ",")
    return _lookup(t, 3).select("seed", ids.alias("ids"))


@query(
    "key_lookup_all",
    "J1 J3 A38",
    f"""WITH {LOOKUP_SQL} SELECT seed, count(*) AS match_cnt, sum(id)::BIGINT AS id_sum FROM seeds JOIN m ON k = c_name
JOIN ranked r ON r.o_custkey = m.o_custkey GROUP BY seed""",
)
def key_lookup_all(t):
    seeds, keyed, canonical = _lookup_sides(t, _state(t))
    rows = lookup.match_rows(seeds, keyed, "seed", canonical)
    return rows.groupBy("seed").agg(F.count("id").alias("match_cnt"), F.sum("id").alias("id_sum"))


@query(
    "match_counts",
    "A38",
    f"""WITH {LOOKUP_SQL} SELECT 'ids' AS id_type, count(DISTINCT id) AS match_cnt FROM seeds JOIN m ON k = c_name
JOIN (SELECT * FROM ranked WHERE rn <= 1) r ON r.o_custkey = m.o_custkey""",
)
def match_counts(t):
    return lookup.match_counts(_lookup(t, 1), ["ids"])


@query(
    "best_candidate",
    "J4",
    f"""WITH {SEEN_SQL}, w AS (SELECT CASE WHEN p_size > 20 THEN p_partkey ELSE -1 - p_partkey END AS id, p_size AS weight FROM part),
c AS (SELECT c_custkey, id, coalesce(weight, 0) AS weight FROM customer LEFT JOIN (SELECT * FROM ranked WHERE rn <= 10) ON o_custkey = c_custkey LEFT JOIN w USING (id))
SELECT c_custkey, id AS best_id, CASE WHEN id IS NOT NULL THEN weight END AS best_weight FROM c QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY weight DESC, id DESC NULLS LAST) = 1""",
)
def best_candidate(t):
    # Small parts have weights under ids that no mapping knows.
    known = F.when(F.col("p_size") > 20, F.col("p_partkey")).otherwise(-1 - F.col("p_partkey"))
    weights = t.part.select(known.alias("id"), F.col("p_size").alias("weight"))
    mapped = _ids(t, 10).select(F.col("o_custkey").alias("c_custkey"), "ids")
    seeds = t.customer.select("c_custkey").join(mapped, "c_custkey", "left")
    return lookup.best_candidate(seeds, "ids", weights, ["c_custkey"])


@query(
    "asof_match",
    "J5",
    """WITH h AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS valid_from, max(o_orderkey) AS id FROM orders GROUP BY ALL),
q AS (SELECT DISTINCT o_custkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) - 1200 AS day FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT q.o_custkey, q.l_linenumber, q.l_partkey, q.day, coalesce(arg_max(h.id, h.valid_from) FILTER (h.valid_from <= q.day), arg_min(h.id, h.valid_from)) AS id
FROM q LEFT JOIN h ON h.o_custkey = q.o_custkey GROUP BY q.o_custkey, q.l_linenumber, q.l_partkey, q.day""",
)
def asof_match(t):
    history = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("valid_from"), F.col("o_orderkey").alias("id"))
    asks = t.lineitem.join(t.orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_custkey", "l_linenumber", "l_partkey", F.date_sub(F.to_date("l_shipdate"), 1200).alias("day")
    ).distinct()
    return asof.asof_join(asks, history, ["o_custkey"], "day", "valid_from", ["id"], first_if_before=True)


@query(
    "asof_null_sides",
    "J5",
    """WITH h AS (SELECT CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS ts, value FROM events WHERE event_type = 'purchase'),
q AS (SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 13 <> 0 THEN ts END AS ts FROM events),
b AS (SELECT event_id, arg_max(h.value, struct_pack(t := h.ts, v := h.value)) AS v FROM q JOIN h ON h.user_id = q.user_id AND h.ts <= q.ts GROUP BY event_id),
n AS (SELECT event_id, min(h.ts) AS ts, q.user_id FROM q JOIN h ON h.user_id = q.user_id AND h.ts >= q.ts GROUP BY event_id, q.user_id),
f AS (SELECT event_id, max(h.value) AS v FROM n JOIN h ON h.user_id = n.user_id AND h.ts = n.ts GROUP BY event_id)
SELECT q.event_id, b.v AS value_before, f.v AS value_after FROM q LEFT JOIN b USING (event_id) LEFT JOIN f USING (event_id)""",
)
def asof_null_sides(t):
    """Both sides hold null keys and null times."""

    def sometimes(column, n):
        return F.when(F.col("event_id") % n != 0, F.col(column)).alias(column)

    bought = t.events.where("event_type = 'purchase'").select(sometimes("user_id", 11), sometimes("ts", 7), "value")
    asks = t.events.select("event_id", sometimes("user_id", 5), sometimes("ts", 13))
    before = bought.select("user_id", F.col("ts").alias("bt"), F.col("value").alias("value_before"))
    after = bought.select("user_id", F.col("ts").alias("at"), F.col("value").alias("value_after"))
    out = asof.asof_join(asks, before, ["user_id"], "ts", "bt", ["value_before"])
    out = asof.asof_join(out, after, ["user_id"], "ts", "at", ["value_after"], forward=True)
    return out.select("event_id", "value_before", "value_after")


# Every third event belongs to user 0 and to one hour, in which many events share a second.
HOT_SQL = """e AS (SELECT event_id, value, event_type, CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id,
  CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-15 12:00:00' + to_seconds(event_id * 7919 % 3600) ELSE date_trunc('second', ts) END AS ts FROM events)"""


@query(
    "asof_hot_key",
    "J5",
    f"""WITH {HOT_SQL}, p AS (SELECT user_id, ts, max(value) AS value FROM e WHERE event_type = 'purchase' GROUP BY ALL)
SELECT event_id, b.value AS value_before, n.value AS value_after FROM e
ASOF LEFT JOIN p b ON e.user_id = b.user_id AND e.ts >= b.ts ASOF LEFT JOIN p n ON e.user_id = n.user_id AND e.ts <= n.ts""",
)
def asof_hot_key(t):
    """One key holds a third of the rows within an hour."""
    events = hot_events(t)
    bought = events.where("event_type = 'purchase'")
    before = bought.select("user_id", F.col("ts").alias("bt"), F.col("value").alias("value_before"))
    after = bought.select("user_id", F.col("ts").alias("at"), F.col("value").alias("value_after"))
    out = asof.asof_join(events.select("event_id", "user_id", "ts"), before, ["user_id"], "ts", "bt", ["value_before"])
    out = asof.asof_join(out, after, ["user_id"], "ts", "at", ["value_after"], forward=True)
    return out.select("event_id", "value_before", "value_after")


def hot_events(t):
    hot = F.col("event_id") % 3 == 0
    second = F.timestamp_add("SECOND", F.col("event_id") * 7919 % 3600, F.lit("2024-01-15 12:00:00").cast(t.events.schema["ts"].dataType))
    return t.events.select(
        "event_id", "value", "event_type", F.when(hot, 0).otherwise(F.col("user_id")).alias("user_id"),
        F.when(hot, second).otherwise(F.date_trunc("second", "ts")).alias("ts"),
    )


EVENT_ASOF = """WITH e AS (SELECT event_id, user_id, ts, event_type FROM events),
p AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL)"""


@query(
    "asof_before_event",
    "J5 J18",
    EVENT_ASOF + """ SELECT event_id, b.value AS value_before, n.value AS value_after FROM e
ASOF LEFT JOIN p b ON e.user_id = b.user_id AND e.ts > b.ts ASOF LEFT JOIN p n ON e.user_id = n.user_id AND e.ts < n.ts""",
)
def asof_before_event(t):
    bought = t.events.where("event_type = 'purchase'")
    before = bought.select("user_id", F.col("ts").alias("bt"), F.col("value").alias("value_before"))
    after = bought.select("user_id", F.col("ts").alias("at"), F.col("value").alias("value_after"))
    asks = t.events.select("event_id", "user_id", "ts")
    out = asof.asof_join(asks, before, ["user_id"], "ts", "bt", ["value_before"], strict=True)
    out = asof.asof_join(out, after, ["user_id"], "ts", "at", ["value_after"], strict=True, forward=True)
    return out.select("event_id", "value_before", "value_after")


OWNERS_SQL = """o AS (SELECT o_custkey % 200 AS key, date_trunc('month', o_orderdate)::DATE AS period, o_orderstatus AS owner,
  max(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) AS flag, count(*) AS cnt FROM orders GROUP BY ALL),
w AS (SELECT key, period, owner FROM o QUALIFY row_number() OVER (PARTITION BY key, period ORDER BY flag DESC, cnt DESC, owner DESC) = 1),
c AS (SELECT key, period AS valid_from, owner FROM w QUALIFY owner IS DISTINCT FROM lag(owner) OVER (PARTITION BY key ORDER BY period))"""


def _points(t):
    counted = t.orders.groupBy(
        (F.col("o_custkey") % 200).alias("key"),
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("period"),
        F.col("o_orderstatus").alias("owner"),
    ).agg(F.max((F.col("o_totalprice") > 450000).cast("int")).alias("flag"), F.count("*").alias("cnt"))
    return asof.change_points(asof.owners_by_period(counted, "key", "owner", "period", "flag", "cnt"), "key", "period", "owner")


@query("change_points", "A37", f"WITH {OWNERS_SQL} SELECT key, valid_from, owner FROM c")
def change_points(t):
    return _points(t)


@query(
    "change_history",
    "A37 W1",
    f"""WITH {OWNERS_SQL} SELECT key, string_agg(CAST(valid_from AS VARCHAR) || ':' || owner, ';' ORDER BY valid_from) AS history, max(valid_from) AS updated FROM c GROUP BY key""",
)
def change_history(t):
    full = asof.change_history(_points(t), "key", "owner").withColumn("updated", F.element_at("history", -1)["valid_from"])
    older = full.withColumn("updated", F.date_sub("updated", 31)).withColumn("history", F.slice("history", 1, 1))
    newest = asof.latest_history(older, full, "key", "updated")
    return newest.select("key", struct_list_text(F.col("history"), "valid_from", "owner").alias("history"), "updated")


SOURCE_FLOW_SQL = """stays AS (SELECT user_id, event_id AS place, ts AS start_ts, ts + INTERVAL 20 MINUTE AS end_ts FROM events WHERE event_type <> 'purchase'),
v AS (SELECT user_id, min(ts) AS first_visit, max(ts) AS last_visit FROM events WHERE event_type = 'purchase' GROUP BY user_id),
f AS (SELECT user_id, max(event_id) AS place FROM events WHERE event_type = 'view' GROUP BY user_id)"""


@query(
    "source_and_flow",
    "J18",
    f"""WITH {SOURCE_FLOW_SQL} SELECT v.user_id, first_visit, last_visit,
  (SELECT arg_max(place, start_ts) FROM stays s WHERE s.user_id = v.user_id AND start_ts < last_visit) AS source_place,
  coalesce((SELECT arg_min(place, end_ts) FROM stays s WHERE s.user_id = v.user_id AND end_ts > first_visit), f.place) AS flow_place
FROM v LEFT JOIN f ON f.user_id = v.user_id""",
)
def source_and_flow(t):
    return _source_flow(t)


def _source_flow(t):
    visits = t.events.where("event_type = 'purchase'")
    stays = t.events.where("event_type <> 'purchase'").select(
        "user_id", F.col("event_id").alias("place"), F.col("ts").alias("start_ts"), F.expr("ts + interval 20 minutes").alias("end_ts")
    )
    frequent = t.events.where("event_type = 'view'").groupBy("user_id").agg(F.max("event_id").alias("place"))
    bounds = asof.visit_bounds(visits, ["user_id"], "ts")
    return asof.source_and_flow(bounds, stays, frequent, "user_id", "start_ts", "end_ts", ["place"])


@query(
    "source_flow_assembly",
    "J19",
    f"""WITH {SOURCE_FLOW_SQL}, {PROFILE}, sf AS (SELECT v.user_id, (SELECT arg_max(place, start_ts) FROM stays s WHERE s.user_id = v.user_id AND start_ts < last_visit) AS source_place FROM v)
SELECT strftime(ts, '%Y-%m-%d %H') AS visit_hour, segment, count(*) AS visits, sum(source_place)::BIGINT AS source_sum
FROM events e JOIN profile ON c_custkey = e.user_id JOIN sf ON sf.user_id = e.user_id WHERE event_type = 'purchase' GROUP BY ALL""",
)
def source_flow_assembly(t):
    hourly = t.events.where("event_type = 'purchase'").select("user_id", F.date_format("ts", "yyyy-MM-dd HH").alias("visit_hour"))
    people = fixtures.profile(t).select(F.col("c_custkey").alias("user_id"), "segment")
    joined = asof.visit_report(hourly, people, _source_flow(t).select("user_id", "source_place"), "user_id")
    return joined.groupBy("visit_hour", "segment").agg(F.count("*").alias("visits"), F.sum("source_place").alias("source_sum"))


PIT_SQL = f"""{fixtures.HISTORY_SQL}, req AS (SELECT user_id * 10 AS o_custkey, DATE '1996-01-01' + CAST((user_id * 37) % 1500 AS INTEGER) AS day FROM events GROUP BY user_id),
asked AS (SELECT o_custkey, day, unnest(['status', 'price', 'absent']) AS tag FROM req),
h AS (SELECT o_custkey, tag, day AS value_day, max(value) AS value FROM history GROUP BY ALL),
pit AS (SELECT a.o_custkey, a.day, a.tag, max(value_day) AS value_day, arg_max(value, value_day) AS value
  FROM asked a LEFT JOIN h ON h.o_custkey = a.o_custkey AND h.tag = a.tag AND h.value_day <= a.day GROUP BY ALL)"""


def _pit(t):
    day = F.date_add(F.lit(date(1996, 1, 1)), (F.col("user_id") * 37 % 1500).cast("int"))
    requests = t.events.select((F.col("user_id") * 10).alias("o_custkey"), day.alias("day")).distinct()
    return asof.point_in_time(
        requests, fixtures.history(t), "o_custkey", "day", ["status", "price", "absent"], "day", "tag", "value"
    )


@query("point_in_time_features", "A23", f"WITH {PIT_SQL} SELECT o_custkey, day, tag, value_day, value FROM pit")
def point_in_time_features(t):
    return _pit(t)


@query(
    "point_in_time_missing",
    "A23",
    f"""WITH {PIT_SQL} SELECT o_custkey, day, coalesce(string_agg(tag || '=' || value, ';' ORDER BY tag) FILTER (value IS NOT NULL), '') AS features,
  string_agg(tag, ',' ORDER BY tag) FILTER (value IS NULL) AS missing FROM pit GROUP BY ALL""",
)
def point_in_time_missing(t):
    rows = asof.features_with_missing(_pit(t), "o_custkey", "day", "tag")
    return rows.select(
        "o_custkey", "day", F.coalesce(fixtures.map_text(F.col("features")), F.lit("")).alias("features"),
        F.array_join("missing", ",").alias("missing"),
    )


@query(
    "daily_range_replace",
    "A45",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders)
SELECT o_orderkey, day, CASE WHEN day BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' THEN o_totalprice * 2 ELSE o_totalprice END AS price FROM o""",
)
def daily_range_replace(t):
    old = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("price"))
    new = old.withColumn("price", F.col("price") * 2)
    return asof.daily_index(old, "o_orderkey", "day", F.lit(date(1997, 1, 1)), F.lit(date(1997, 12, 31)), new)


@query(
    "cleaned_name_lookup",
    "J15 X21",
    """WITH n AS (SELECT CASE WHEN n_nationkey < 20 THEN n_name ELSE 'old ' || n_name END AS city, CAST(n_nationkey AS VARCHAR) AS city_code FROM nation),
c AS (SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN 'NATION_7 city' WHEN c_nationkey % 2 = 0 THEN 'NATION_' || c_nationkey || ' city' ELSE 'NATION_' || c_nationkey END AS raw, c_mktsegment FROM customer),
k AS (SELECT *, CASE WHEN raw = 'NATION_2 city' THEN 'NATION_2 city' WHEN raw LIKE '% city' THEN left(raw, length(raw) - 5) ELSE raw END AS cleaned FROM c)
SELECT c_custkey, raw, coalesce(city_code, '4') AS city_code, CASE c_mktsegment WHEN 'BUILDING' THEN '1' WHEN 'MACHINERY' THEN '2' ELSE '4' END AS isp_code
FROM k LEFT JOIN n ON cleaned = city""",
)
def cleaned_name_lookup(t):
    from cohortloom.functions import text

    name = F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
    raw = F.when((F.col("c_nationkey") == 7) | (F.col("c_nationkey") % 2 == 0), F.concat(name, F.lit(" city"))).otherwise(name)
    people = t.customer.select(
        "c_custkey", raw.alias("raw"), text.code_of(F.col("c_mktsegment"), {"BUILDING": "1", "MACHINERY": "2"}, "4").alias("isp_code")
    )
    city = F.when(F.col("n_nationkey") < 20, F.col("n_name")).otherwise(F.concat(F.lit("old "), "n_name"))
    dim = t.nation.select(city.alias("city"), F.col("n_nationkey").cast("string").alias("city_code"))
    return lookup.cleaned_name_lookup(people, "raw", dim, "city", " city", {"NATION_2 city": "NATION_2 city"}, "city_code", "4")


@query(
    "digest_translation",
    "J20",
    """SELECT sha256(CAST(o_custkey AS VARCHAR)) AS key, o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def digest_translation(t):
    dictionary = lookup.digest_dictionary(t.customer, "c_custkey")
    held = t.orders.select(F.md5(F.col("o_custkey").cast("string")).alias("key"), "o_orderkey")
    return lookup.translate_digest(held, "key", dictionary, "md5", "sha256", "c_custkey")


@query(
    "digest_dictionary",
    "J20",
    """SELECT c_custkey, unnest(['md5', 'md5_16', 'sha256']) AS kind, unnest([md5(CAST(c_custkey AS VARCHAR)), substr(md5(CAST(c_custkey AS VARCHAR)), 9, 16), sha256(CAST(c_custkey AS VARCHAR))]) AS digest FROM customer""",
)
def digest_dictionary(t):
    return lookup.digest_dictionary(t.customer, "c_custkey")


@query(
    "prefix_membership",
    "J21",
    """SELECT count(*) AS members FROM orders WHERE substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 2) IN (SELECT DISTINCT substr(md5(n_name), 1, 2) FROM nation)""",
)
def prefix_membership(t):
    prefixes = t.nation.select(F.substring(F.md5("n_name"), 1, 2).alias("prefix"))
    # Upper case with separators, which the operator strips.
    keyed = t.orders.select(K.insert_colons(F.upper(F.md5(F.col("o_orderkey").cast("string")))).alias("key"))
    return lookup.prefix_members(keyed, "key", prefixes, "prefix", 2).agg(F.count("*").alias("members"))


@query(
    "prefix_dimension",
    "J28",
    """WITH k AS (SELECT DISTINCT lpad(CAST(o_orderkey AS VARCHAR), 9, '1') AS phone FROM orders),
d AS (SELECT substr(lpad(CAST(p_partkey AS VARCHAR), 7, '1'), 1, 7) AS prefix, max(p_brand) AS code FROM part GROUP BY 1)
SELECT phone, substr(phone, 1, 7) AS prefix, coalesce(code, '4') AS code FROM k LEFT JOIN d ON substr(phone, 1, 7) = prefix""",
)
def prefix_dimension(t):
    keys = t.orders.select(F.lpad(F.col("o_orderkey").cast("string"), 9, "1").alias("phone"))
    dirty = t.orders.select(F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("phone"))
    dim = t.part.groupBy(F.lpad(F.col("p_partkey").cast("string"), 7, "1").alias("prefix")).agg(F.max("p_brand").alias("code"))
    return lookup.prefix_dimension(keys.unionByName(dirty), "phone", dim, "prefix", 7, "code", "4")


@query(
    "latest_profile_match",
    "J25",
    f"""WITH {SEEN_SQL} SELECT o_custkey, id AS l_partkey, p_brand, CASE WHEN p_partkey IS NULL THEN 0 ELSE 1 END AS match_flag
FROM ranked LEFT JOIN (SELECT CASE WHEN p_size > 25 THEN p_partkey ELSE -1 - p_partkey END AS p_partkey, p_brand FROM part) ON p_partkey = id WHERE rn = 1""",
)
def latest_profile_match(t):
    key = F.when(F.col("p_size") > 25, F.col("p_partkey")).otherwise(-1 - F.col("p_partkey"))
    known = t.part.select(key.alias("l_partkey"), "p_brand")
    return lookup.latest_with_profile(_ids(t, 5), "o_custkey", known, "l_partkey")


@query(
    "parent_lookup",
    "J23",
    """WITH RECURSIVE cat AS (SELECT p_partkey AS id, p_partkey // 10 AS parent, length(CAST(p_partkey AS VARCHAR)) AS level FROM part),
up AS (SELECT id, id AS node, parent, level FROM cat UNION ALL SELECT up.id, c.id, c.parent, c.level FROM up JOIN cat c ON c.id = up.parent WHERE up.level > 2)
SELECT id, max(CASE WHEN level = 2 THEN node END) AS ancestor FROM up GROUP BY id""",
)
def parent_lookup(t):
    catalogue = t.part.select(
        F.col("p_partkey").alias("id"),
        F.floor(F.col("p_partkey") / 10).alias("parent"),
        F.length(F.col("p_partkey").cast("string")).alias("level"),
    )
    return lookup.parent_at_level(catalogue, "id", "parent", "level", target=2)


@query(
    "recent_increment",
    "K2 A24",
    f"WITH {SEEN_SQL} SELECT o_custkey, max(l) AS update_time FROM ranked GROUP BY o_custkey HAVING max(l) >= DATE '2001-06-01'",
)
def recent_increment(t):
    return mapping.recent_increment(_state(t), "o_custkey", F.lit(date(2001, 6, 1)))


@query(
    "new_rows_above_marks",
    "K9",
    """WITH m AS (SELECT o_orderpriority, max(o_orderdate) AS mark FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01' AND o_orderpriority <> '5-LOW' GROUP BY 1)
SELECT o_orderkey, orders.o_orderpriority FROM orders LEFT JOIN m ON m.o_orderpriority = orders.o_orderpriority WHERE mark IS NULL OR o_orderdate > mark""",
)
def new_rows_above_marks(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate")
    seen = rows.where((F.col("o_orderdate") < "2001-01-01") & (F.col("o_orderpriority") != "5-LOW"))
    marks = tables.high_water_marks(seen, "o_orderpriority", "o_orderdate")
    return tables.above_marks(rows, marks, "o_orderpriority", "o_orderdate").select("o_orderkey", "o_orderpriority")


@query(
    "latest_of_many",
    "W1",
    f"WITH {PURCHASES} SELECT o_custkey, l_partkey, max(day) AS day FROM purchases GROUP BY ALL",
)
def latest_of_many(t):
    return ranking.latest_per_key(fixtures.purchases(t).select("o_custkey", "l_partkey", "day"), ["o_custkey", "l_partkey"], ["day"])
