"""Seed lists, set expressions, key cleaning and date helpers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cohortloom.functions import dates, maps, text
from cohortloom.functions import keys as K
from cohortloom.operators import filters, ranking, sets
from cohortloom.plans import fixtures
from cohortloom.plans.registry import query
from cohortloom.session import scratch_path
from cohortloom.sources import seeds, tables

SEED_TABLE_SQL = """stored AS (
  SELECT c_mktsegment AS dataset, CASE WHEN c_acctbal < 500 THEN '-1' ELSE CAST(c_custkey AS VARCHAR) END || '|' || c_name || '|' || c_mktsegment AS data
  FROM customer)"""


def _stored(t):
    first = F.when(F.col("c_acctbal") < 500, "-1").otherwise(F.col("c_custkey").cast("string"))
    return t.customer.select(
        F.col("c_mktsegment").alias("dataset"), F.concat_ws("|", first, "c_name", "c_mktsegment").alias("data")
    )


@query(
    "stored_seed_read",
    "S1",
    f"""WITH {SEED_TABLE_SQL}
SELECT split_part(data, '|', 2) AS id, data FROM stored WHERE dataset = 'BUILDING' AND split_part(data, '|', 1) <> '-1'""",
)
def stored_seed_read(t):
    return seeds.stored_seeds(_stored(t), "dataset", "BUILDING", index=2, separator="|")


@query(
    "matched_seed_read",
    "S2",
    f"""WITH {fixtures.PROFILE_SQL}
SELECT unnest(string_split(codes, ',')) AS id, segment AS data FROM profile WHERE codes IS NOT NULL""",
)
def matched_seed_read(t):
    matches = fixtures.profile(t).select(
        F.create_map(F.lit("code"), F.col("codes"), F.lit("nation"), F.col("nation")).alias("match_ids"),
        F.col("segment").alias("data"),
    )
    return seeds.matched_seeds(matches, "code")


@query(
    "hub_seed_read",
    "S3 S6",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name || ',' || c_mktsegment AS data FROM customer",
)
def hub_seed_read(t):
    rows = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.concat_ws(",", "c_name", "c_mktsegment").alias("data"))
    return seeds.hub_seeds(seeds.load_into_hub(rows, "4"), "4")


@query(
    "sql_seed_read",
    "S4",
    """SELECT s_suppkey AS in_s_suppkey, s_name AS in_s_name, s_nationkey AS in_s_nationkey, s_name AS id,
  CAST(s_suppkey AS VARCHAR) || '|' || s_name || '|' || CAST(s_nationkey AS VARCHAR) AS data FROM supplier""",
)
def sql_seed_read(t):
    return seeds.frame_seeds(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), index=2, separator="|")


@query(
    "delimited_seed_read",
    "S5",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS brand FROM part",
)
def delimited_seed_read(t):
    path = scratch_path(t.spark, "delimited")
    body = t.part.select(F.concat_ws("||", "p_partkey", "p_name", "p_brand").alias("value"))
    header = t.part.agg(F.lit("partkey||name||brand").alias("value"))
    header.unionByName(body).write.text(path)
    return seeds.delimited_seeds(t.spark, path, ["partkey", "name", "brand"], "||", key="partkey")


@query(
    "latest_partition_read",
    "S7 S10",
    """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') = (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders WHERE strftime(o_orderdate, '%Y-%m') <= '1999-06')""",
)
def latest_partition_read(t):
    """From a table partitioned by month on disk."""
    path = scratch_path(t.spark, "by-month")
    dated = t.orders.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    dated.repartition("month").write.partitionBy("month").parquet(path)
    return tables.latest_listed_partition(t.spark, path, "month", upto="1999-06").withColumn("month", F.col("month").cast("string"))


@query(
    "period_partition_read",
    "S7",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-04-30'",
)
def period_partition_read(t):
    dated = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return tables.period_partition(dated, "day", date(1998, 5, 17), "month")


@query(
    "latest_partition_per_feature",
    "S7",
    """SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders
QUALIFY CAST(o_orderdate AS DATE) = max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_orderpriority)""",
)
def latest_partition_per_feature(t):
    dated = t.orders.select("o_orderkey", "o_orderpriority", F.to_date("o_orderdate").alias("day"))
    return tables.latest_per_feature(dated, "o_orderpriority", "day").select("o_orderkey", "o_orderpriority", "day")


def _sets(t):
    def customers(df, key="o_custkey"):
        return df.select(F.col(key).alias("key"))

    return {
        "building": customers(t.customer.where("c_mktsegment = 'BUILDING'"), "c_custkey"),
        "urgent": customers(t.orders.where("o_orderpriority = '1-URGENT'")),
        "open": customers(t.orders.where("o_orderstatus = 'O' and o_totalprice > 400000")),
        "rich": customers(t.customer.where("c_acctbal > 8000"), "c_custkey"),
    }


SETS_SQL = """building AS (SELECT c_custkey AS key FROM customer WHERE c_mktsegment = 'BUILDING'),
urgent AS (SELECT o_custkey AS key FROM orders WHERE o_orderpriority = '1-URGENT'),
opened AS (SELECT o_custkey AS key FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 400000),
rich AS (SELECT c_custkey AS key FROM customer WHERE c_acctbal > 8000)"""


@query(
    "set_expression",
    "O1",
    f"""WITH {SETS_SQL},
a AS (SELECT key FROM building UNION SELECT key FROM rich),
b AS (SELECT key FROM a INTERSECT SELECT key FROM urgent),
c AS (SELECT key FROM opened EXCEPT SELECT key FROM rich)
SELECT key FROM (SELECT key FROM b EXCEPT SELECT key FROM c) x""",
)
def set_expression(t):
    return sets.set_expression(_sets(t), "building | rich & urgent - (open - rich)", "key")


@query(
    "set_counts",
    "O2",
    f"""WITH {SETS_SQL}, u AS (SELECT 'building' AS set_name FROM building UNION ALL SELECT 'urgent' FROM urgent
  UNION ALL SELECT 'open' FROM opened UNION ALL SELECT 'rich' FROM rich)
SELECT set_name, count(*) AS cnt FROM u GROUP BY set_name UNION ALL SELECT 'total', count(*) FROM u""",
)
def set_counts(t):
    return sets.set_counts(_sets(t), "key")


@query(
    "padded_union",
    "O3",
    """SELECT c_nationkey AS nationkey, c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS suppkey FROM customer
UNION ALL SELECT s_nationkey, s_name, NULL, s_suppkey FROM supplier""",
)
def padded_union(t):
    left = t.customer.select(F.col("c_nationkey").alias("nationkey"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    right = t.supplier.select(F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("suppkey"))
    return sets.padded_union(left, right)


@query(
    "distinct_union",
    "O4",
    f"WITH {SETS_SQL} SELECT key FROM building UNION SELECT key FROM urgent UNION SELECT key FROM opened",
)
def distinct_union(t):
    s = _sets(t)
    return sets.distinct_union("key", s["building"], s["urgent"], s["open"])


@query(
    "clean_keys",
    "F7 F8",
    """WITH k AS (SELECT c_custkey, lpad(CAST(c_custkey * 7919 AS VARCHAR), 14, '1') AS digits, c_name FROM customer),
l AS (SELECT *, list_sum(list_transform(range(14), lambda i: CASE WHEN i % 2 = 0 THEN CAST(substr(digits, i + 1, 1) AS INTEGER)
   ELSE (CAST(substr(digits, i + 1, 1) AS INTEGER) * 2) % 10 + CAST(substr(digits, i + 1, 1) AS INTEGER) * 2 // 10 END)) AS s FROM k)
SELECT c_custkey, digits || CAST((10 - s % 10) % 10 AS VARCHAR) AS filled, replace(replace(upper(c_name), '#', ''), 'CUSTOMER', '') AS cleaned
FROM l""",
)
def clean_keys(t):
    keyed = t.customer.select(
        "c_custkey", F.lpad((F.col("c_custkey") * 7919).cast("string"), 14, "1").alias("digits"), "c_name"
    )
    keyed = filters.regex_clean(keyed, "digits", drop_letters=True)
    return keyed.select(
        "c_custkey",
        K.clean(F.col("digits"), lower="1", delete=["[-:]"], fill_check_digit=True).alias("filled"),
        K.clean(F.col("c_name"), lower="0", delete=["#", "(?i)customer"]).alias("cleaned"),
    )


@query(
    "regex_key_filter",
    "F7",
    "SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name, '^(red|blue) ')",
)
def regex_key_filter(t):
    return filters.regex_clean(t.part.select("p_partkey", "p_name"), "p_name", drop_pattern="^(red|blue) ")


@query(
    "valid_keys",
    "F9",
    """WITH k AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN upper(md5(CAST(o_orderkey AS VARCHAR))) || '00000000'
  WHEN o_orderpriority = '5-LOW' THEN repeat('0', 40) ELSE md5(CAST(o_orderkey AS VARCHAR)) || '0123abcd' END AS key FROM orders)
SELECT o_orderkey, key FROM k WHERE regexp_full_match(key, '[a-f0-9]{40}') AND key <> repeat('0', 40)""",
)
def valid_keys(t):
    base = F.md5(F.col("o_orderkey").cast("string"))
    key = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.upper(base), F.lit("00000000")))
        .when(F.col("o_orderpriority") == "5-LOW", F.repeat(F.lit("0"), F.lit(40)))
        .otherwise(F.concat(base, F.lit("0123abcd")))
    )
    return t.orders.select("o_orderkey", key.alias("key")).where(K.is_valid_hex_key(F.col("key")))


@query(
    "hash_sample",
    "F10",
    """SELECT c_custkey, c_name FROM customer
WHERE CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 10 = 3""",
)
def hash_sample(t):
    return filters.hash_sample(t.customer.select("c_custkey", "c_name"), "c_custkey", 10, 3)


@query("random_sample", "F13")
def random_sample(t):
    return filters.random_sample(t.lineitem.select("l_orderkey", "l_linenumber"), 0.01, seed=7)


@query(
    "crowded_key_drop",
    "F12",
    """SELECT l_partkey, l_orderkey FROM lineitem
WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) > 32)""",
)
def crowded_key_drop(t):
    return filters.drop_crowded_keys(t.lineitem.select("l_partkey", "l_orderkey"), "l_partkey", 32)


@query(
    "key_digests",
    "X1 X2 X20",
    """SELECT c_custkey, md5(c_name) AS md5_32, substr(md5(c_name), 9, 16) AS md5_16, sha256(c_name) AS sha256,
  regexp_replace(lpad(CAST(c_custkey AS VARCHAR), 12, '0'), '^(..)(..)(..)(..)(..)(..)$', '\\1:\\2:\\3:\\4:\\5:\\6') AS colons,
  c_name AS decrypted, c_name AS unhexed, c_mktsegment || '-' || c_name AS joined FROM customer""",
)
def key_digests(t):
    name = F.col("c_name")
    secret = F.lit("0123456789abcdef")
    iv = F.encode(F.substring(F.md5(name), 1, 16), "utf-8")
    return t.customer.select(
        "c_custkey",
        K.digest(name, "md5").alias("md5_32"),
        K.digest(name, "md5_16").alias("md5_16"),
        K.digest(name, "sha256").alias("sha256"),
        K.insert_colons(F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("colons"),
        K.decrypt_text(K.encrypt_text(name, secret, iv), secret).alias("decrypted"),
        text.unhex_text(F.hex(name)).alias("unhexed"),
        F.concat_ws("-", "c_mktsegment", "c_name").alias("joined"),
    )


@query(
    "array_keys",
    "X3 X8 X10",
    """WITH g AS (SELECT o_orderkey, [CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderpriority, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)] AS ks FROM orders)
SELECT o_orderkey, array_to_string(list_transform(ks, lambda k: md5(k)), ',') AS digests,
  array_to_string(list_transform(list_filter(ks, lambda k: length(k) >= 4), lambda k: substr(k, 1, 4)), ',') AS truncated,
  array_to_string(list_transform(list_filter(ks, lambda k: regexp_full_match(k, '[0-9]+')), lambda k: k || '@' || CAST(length(k) AS VARCHAR)), ',') AS numeric,
  array_to_string(list_concat(ks, [md5('x')]), ',') AS collapsed FROM g""",
)
def array_keys(t):
    lists = t.orders.select(
        "o_orderkey",
        F.array(
            F.col("o_orderkey").cast("string"),
            F.col("o_custkey").cast("string"),
            F.col("o_orderpriority"),
            F.floor("o_totalprice").cast("string"),
        ).alias("ks"),
    )
    ks = F.col("ks")
    pairs = K.numeric_elements(ks, F.transform(ks, lambda k: F.length(k)))
    covered = F.concat(F.slice(K.digest_elements(ks, "md5"), 1, 1), F.array(F.md5(F.lit("x"))))
    return lists.select(
        "o_orderkey",
        F.array_join(K.digest_elements(ks, "md5"), ",").alias("digests"),
        F.array_join(K.truncate_elements(ks, 4), ",").alias("truncated"),
        F.array_join(F.transform(pairs, lambda p: F.concat_ws("@", p["value"], p["time"].cast("string"))), ",").alias("numeric"),
        F.array_join(K.uncovered_digests(ks, covered), ",").alias("collapsed"),
    )


@query(
    "day_arithmetic",
    "X11 X12",
    """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_orderkey, strftime(day, '%Y%m%d') AS day_text, CAST(day - INTERVAL 1 DAY AS DATE) AS minus_day,
  CAST(day - INTERVAL 2 MONTH AS DATE) AS minus_months, CAST(day + INTERVAL 1 YEAR AS DATE) AS plus_year,
  CAST(date_trunc('week', day) - INTERVAL 7 DAY AS DATE) AS week_first,
  day_count, CAST(date_trunc('month', day) - INTERVAL 1 DAY AS DATE) AS month_end,
  epoch(day)::BIGINT AS epoch_seconds, strftime(day, '%Y%m%d') AS back
FROM d, LATERAL (SELECT CAST(date_part('day', date_trunc('month', day) - INTERVAL 1 DAY) AS BIGINT) AS day_count)""",
)
def day_arithmetic(t):
    day = F.col("day")
    seconds = dates.day_text_to_epoch(dates.day_text(day))
    return t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day")).select(
        "o_orderkey",
        dates.day_text(day).alias("day_text"),
        dates.shift(day, days=-1).alias("minus_day"),
        dates.shift(day, months=-2).alias("minus_months"),
        dates.shift(day, years=1).alias("plus_year"),
        dates.last_week(day)[0].alias("week_first"),
        F.size(dates.last_month(day)).cast("long").alias("day_count"),
        dates.period_end(day, "month").alias("month_end"),
        seconds.alias("epoch_seconds"),
        dates.epoch_to_day_text(seconds + 3600).alias("back"),
    )


@query(
    "export_limit",
    "T1 T3",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def export_limit(t):
    return ranking.ordered_report(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 100
    )


@query(
    "latest_of_arrays",
    "X4",
    """SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_transform(list_reverse_sort([
    {'t': l_quantity, 'v': l_orderkey}, {'t': round(l_discount * 100), 'v': l_partkey}, {'t': round(l_tax * 100), 'v': l_suppkey}])[1:2],
  lambda p: CAST(p.v AS VARCHAR)), ',') AS newest_two FROM lineitem""",
)
def latest_of_arrays(t):
    values = F.array("l_orderkey", "l_partkey", "l_suppkey")
    times = F.array(F.col("l_quantity"), F.round(F.col("l_discount") * 100), F.round(F.col("l_tax") * 100))
    newest = F.transform(maps.latest(values, times, 2), lambda v: v.cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(newest, ",").alias("newest_two"))
