"""Stand-in business tables derived from the driver tables, in Spark and as SQL fragments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import maps
from cohortloom.plans.registry import Tables

# ---- entity profile and tag map (customer) --------------------------------------------------

PROFILE_SQL = """profile AS (
  SELECT c_custkey, c_mktsegment AS segment, n_name AS nation, r_name AS region,
         CASE WHEN c_acctbal < 1000 THEN '-1'
              ELSE CAST(CAST(floor(c_acctbal / 2500) AS BIGINT) AS VARCHAR) END AS band,
         codes, CAST(round(c_acctbal) AS BIGINT) AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT o_custkey, string_agg(DISTINCT substr(o_orderpriority, 1, 1), ',' ORDER BY substr(o_orderpriority, 1, 1)) AS codes
             FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey) ON o_custkey = c_custkey)"""


def profile(t: Tables) -> DataFrame:
    """One row per customer; ``codes`` is multi-valued and may be missing, ``band`` may be ``-1``."""
    code = F.substring("o_orderpriority", 1, 1)
    codes = (
        t.orders.where("o_orderstatus = 'O'")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.array_join(F.sort_array(F.collect_set(code)), ",").alias("codes"))
    )
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    band = F.when(F.col("c_acctbal") < 1000, "-1").otherwise(F.floor(F.col("c_acctbal") / 2500).cast("string"))
    return (
        t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(codes, "c_custkey", "left")
        .select(
            "c_custkey",
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
            band.alias("band"),
            "codes",
            F.round("c_acctbal").cast("long").alias("balance"),
        )
    )


TAG_NAMES = ("segment", "nation", "region", "band", "codes")


def tagged(t: Tables) -> DataFrame:
    """(c_custkey, tags): the profile as a tag map without missing tags."""
    cells = [F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in TAG_NAMES]
    present = F.filter(F.array(*cells), lambda c: c["value"].isNotNull())
    return profile(t).select("c_custkey", F.map_from_entries(present).alias("tags"))


# ---- entity-item pairs with sight dates (customer x part) ----------------------------------

PURCHASES_SQL = """purchases AS (
  SELECT o_custkey, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS day, l_quantity, l_extendedprice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def purchases(t: Tables) -> DataFrame:
    return t.lineitem.join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(
        "o_custkey", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("day"), "l_quantity", "l_extendedprice"
    )


# ---- dated tag history (orders) -------------------------------------------------------------

HISTORY_SQL = """history AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, unnest(['status', 'priority', 'price']) AS tag,
         unnest([o_orderstatus, o_orderpriority, CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR)]) AS value
  FROM orders)"""


def history(t: Tables) -> DataFrame:
    """(o_custkey, day, tag, value)."""
    cells = F.array(
        F.struct(F.lit("status").alias("tag"), F.col("o_orderstatus").alias("value")),
        F.struct(F.lit("priority").alias("tag"), F.col("o_orderpriority").alias("value")),
        F.struct(F.lit("price").alias("tag"), F.floor(F.col("o_totalprice") / 100000).cast("string").alias("value")),
    )
    return t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), F.explode(cells).alias("c")).select(
        "o_custkey", "day", "c.tag", "c.value"
    )


# ---- daily item status (events): purchase = active, signup = install, error = uninstall ----

CURRENT = date(2024, 1, 30)
ITEM_SQL = "CAST(CAST(json_extract(props, '$.k') AS BIGINT) % 8 AS VARCHAR)"

STATUS_SQL = f"""daily AS (
  SELECT user_id, 'App-' || {ITEM_SQL} AS app, CAST(ts AS DATE) AS day,
         CASE event_type WHEN 'purchase' THEN 'active' WHEN 'signup' THEN 'install' WHEN 'error' THEN 'uninstall'
              ELSE event_type END AS status,
         CAST(floor(value * 10000) AS BIGINT) AS duration, event_id
  FROM events)"""


def daily(t: Tables) -> DataFrame:
    """(user_id, app, day, status, duration, event_id); the app comes from the props number."""
    number = F.get_json_object("props", "$.k").cast("long") % 8
    status = (
        F.when(F.col("event_type") == "purchase", "active")
        .when(F.col("event_type") == "signup", "install")
        .when(F.col("event_type") == "error", "uninstall")
        .otherwise(F.col("event_type"))
    )
    return t.events.select(
        "user_id",
        F.concat(F.lit("App-"), number.cast("string")).alias("app"),
        F.to_date("ts").alias("day"),
        status.alias("status"),
        F.floor(F.col("value") * 10000).cast("long").alias("duration"),
        "event_id",
    )


# ---- coordinates derived from keys -----------------------------------------------------------

STAYS_SQL = """stays AS (
  SELECT o_custkey AS entity, o_orderkey AS stay,
         20.0 + CAST(o_orderkey * 7919 % 100003 AS DOUBLE) / 100003 * 0.9 AS lat,
         100.0 + CAST(o_orderkey * 104729 % 100019 AS DOUBLE) / 100019 * 0.9 AS lon
  FROM orders)"""

POIS_SQL = """pois AS (
  SELECT s_suppkey % 4 + 1 AS poi_type, s_name AS poi_name,
         20.0 + CAST(s_suppkey * 6151 % 1009 AS DOUBLE) / 1009 * 0.9 AS poi_lat,
         100.0 + CAST(s_suppkey * 3571 % 1013 AS DOUBLE) / 1013 * 0.9 AS poi_lon
  FROM supplier)"""


def _spread(key: str, factor: int, modulus: int, origin: float):
    return F.lit(origin) + (F.col(key) * factor % modulus).cast("double") / modulus * 0.9


def stays(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("entity"),
        F.col("o_orderkey").alias("stay"),
        _spread("o_orderkey", 7919, 100003, 20.0).alias("lat"),
        _spread("o_orderkey", 104729, 100019, 100.0).alias("lon"),
    )


def pois(t: Tables) -> DataFrame:
    return t.supplier.select(
        (F.col("s_suppkey") % 4 + 1).alias("poi_type"),
        F.col("s_name").alias("poi_name"),
        _spread("s_suppkey", 6151, 1009, 20.0).alias("poi_lat"),
        _spread("s_suppkey", 3571, 1013, 100.0).alias("poi_lon"),
    )


def struct_list_text(ids, *fields: str):
    """``a:b;a:b`` text of an array of structs, for flat query results."""
    return F.array_join(F.transform(ids, lambda e: F.concat_ws(":", *[e[f].cast("string") for f in fields])), ";")


def map_text(mapping):
    """``k=v;k=v`` in key order."""
    entries = F.sort_array(F.map_entries(maps.null_if_empty(mapping)))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
