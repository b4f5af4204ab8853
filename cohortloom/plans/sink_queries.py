"""Writers read back, consistency checks and column profiles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from cohortloom.operators import checks, mapping, profile
from cohortloom.plans import fixtures
from cohortloom.plans.registry import query
from cohortloom.session import scratch_path
from cohortloom.sources import seeds, sinks, tables


@query(
    "partition_overwrite",
    "K1 K3 S10",
    """SELECT o_orderkey, o_totalprice * CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS price, o_orderstatus FROM orders""",
)
def partition_overwrite(t):
    path = scratch_path(t.spark, "orders")
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    sinks.overwrite_partitions(rows, path, ["o_orderstatus"], fmt="orc")
    # Only the partition named by the literal is replaced.
    doubled = rows.where("o_orderstatus = 'F'").select("o_orderkey", (F.col("price") * 2).alias("price"))
    sinks.overwrite_with(doubled, path, {"o_orderstatus": "F"}, fmt="orc")
    return tables.scan(t.spark, path, "orc", F.col("o_orderstatus").isNotNull())


@query(
    "full_and_increment_write",
    "K2",
    f"""WITH {fixtures.PURCHASES_SQL}, m AS (SELECT o_custkey, max(day) AS update_time FROM purchases GROUP BY o_custkey)
SELECT o_custkey, update_time, 'full' AS kind FROM m UNION ALL SELECT o_custkey, update_time, 'increment' FROM m WHERE update_time >= DATE '2001-06-01'""",
)
def full_and_increment_write(t):
    base = scratch_path(t.spark, "mapping")
    built = mapping.newest_ids(mapping.first_last_seen(fixtures.purchases(t), "o_custkey", "l_partkey", "day", "day"), "o_custkey", 50)
    sinks.full_and_increment(built, f"{base}/full", f"{base}/increment", F.col("update_time") >= F.lit(date(2001, 6, 1)))
    parts = [t.spark.read.parquet(f"{base}/{k}").select("o_custkey", "update_time", F.lit(k).alias("kind")) for k in ("full", "increment")]
    return parts[0].unionByName(parts[1])


@query(
    "report_file",
    "K4 T3",
    f"""WITH {fixtures.PROFILE_SQL} SELECT segment, CAST(count(*) AS VARCHAR) AS cnt FROM profile GROUP BY segment""",
)
def report_file(t):
    path = scratch_path(t.spark, "report")
    counts = fixtures.profile(t).groupBy("segment").agg(F.count("*").alias("cnt"))
    sinks.report(counts, path, [F.desc("cnt"), F.asc("segment")], limit=100)
    return t.spark.read.csv(path, sep="\t", header=True)


@query(
    "split_export",
    "K5",
    f"""WITH {fixtures.PURCHASES_SQL} SELECT DISTINCT 'part' AS id_type, l_partkey AS id FROM purchases UNION ALL SELECT DISTINCT 'supplier', l_suppkey FROM purchases""",
)
def split_export(t):
    path = scratch_path(t.spark, "export")
    cells = F.array(
        F.struct(F.lit("part").alias("id_type"), F.col("l_partkey").alias("id")),
        F.struct(F.lit("supplier").alias("id_type"), F.col("l_suppkey").alias("id")),
    )
    sinks.split_export(fixtures.purchases(t).select(F.explode(cells).alias("c")).select("c.*"), path)
    return t.spark.read.csv(path, schema="id long, id_type string")


@query(
    "csv_load",
    "S9",
    "SELECT p_partkey, p_name, p_retailprice, p_brand FROM part",
)
def csv_load(t):
    base = scratch_path(t.spark, "csv")
    t.part.select("p_partkey", "p_name", "p_retailprice", "p_brand").write.csv(f"{base}/in", header=True)
    from pyspark.sql.types import DoubleType, LongType, StringType, StructType

    schema = StructType().add("p_partkey", LongType()).add("p_name", StringType()).add("p_retailprice", DoubleType()).add("p_brand", StringType())
    sinks.csv_to_table(seeds.csv_table(t.spark, f"{base}/in", schema), f"{base}/out", ["p_brand"])
    return t.spark.read.parquet(f"{base}/out")


@query(
    "source_marks",
    "K9",
    "SELECT event_type AS source, max(ts) AS mark FROM events GROUP BY event_type",
)
def source_marks(t):
    first = t.events.where("user_id % 2 = 0")
    stored = tables.high_water_marks(first, "event_type", "ts")
    return tables.raise_marks(stored, tables.high_water_marks(t.events.where("user_id % 2 = 1"), "event_type", "ts"))


@query(
    "dense_report_rows",
    "K12",
    f"""WITH {fixtures.PROFILE_SQL} SELECT c_custkey, segment || chr(9) || '0.7' AS segment, coalesce(codes, '') || chr(9) AS codes, chr(9) AS missing FROM profile""",
)
def dense_report_rows(t):
    scored = fixtures.tagged(t).withColumn("confidence", F.create_map(F.lit("segment"), F.lit("0.7")))
    return sinks.dense_rows(scored, "c_custkey", ["segment", "codes", "missing"], confidence="confidence")


@query(
    "flat_struct_rows",
    "K13 X20",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'name=' || c_name || ',nation=' || CAST(c_nationkey AS VARCHAR) AS who FROM customer",
)
def flat_struct_rows(t):
    rows = t.customer.select("c_custkey", F.struct(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")).alias("who"))
    return sinks.flat_rows(rows)


@query(
    "versioned_view",
    "K8",
    "SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey = 5",
)
def versioned_view(t):
    rows = t.supplier.select("s_suppkey", "s_name", F.col("s_nationkey").cast("string").alias("version"))
    return sinks.publish_version(t.spark, rows, "supplier_current", "version", "5")


@query(
    "kafka_records",
    "K6",
    "SELECT CAST(event_id AS VARCHAR) || '|' || event_type AS value FROM events",
)
def kafka_records(t):
    return sinks.kafka_records(t.events.select(F.concat_ws("|", F.col("event_id").cast("string"), "event_type").alias("line")))


@query(
    "kafka_send_counts",
    "K6",
    "SELECT count(*) FILTER (event_id % 9 <> 0) AS ok, count(*) FILTER (event_id % 9 = 0) AS failed FROM events",
)
def kafka_send_counts(t):
    """Records go to a written table in place of a topic; rows without a value are counted as they pass."""
    path = scratch_path(t.spark, "topic")
    lines = t.events.select(F.when(F.col("event_id") % 9 != 0, F.concat_ws("|", F.col("event_id").cast("string"), "event_type")).alias("line"))
    seen = sinks.send(lines, lambda records: records.write.parquet(path))
    sent = t.spark.read.parquet(path).agg(F.count("value").alias("ok"))
    return sent.withColumn("failed", F.lit(seen["failed"])).where(F.col("ok") == seen["ok"])


@query(
    "observed_write",
    "K10 K9",
    "SELECT count(*) AS n, max(ts) AS newest, count(DISTINCT event_type) AS kinds, min(value) AS least FROM events",
)
def observed_write(t):
    """Marks and counts of a written table, from the pass that writes it."""
    path = scratch_path(t.spark, "observed")
    metrics = {"n": F.count(F.lit(1)), "newest": F.max("ts"), "least": F.min("value")}
    seen = sinks.observed(t.events, lambda rows: rows.write.parquet(path), **metrics)
    written = t.spark.read.parquet(path).agg(F.count_distinct("event_type").alias("kinds"), F.count(F.lit(1)).alias("_n"))
    kind = t.events.schema["ts"].dataType
    return written.where(F.col("_n") == seen["n"]).select(F.lit(seen["n"]).alias("n"), F.lit(seen["newest"]).cast(kind).alias("newest"), "kinds", F.lit(seen["least"]).alias("least"))


@query(
    "consistency_report",
    "A44",
    f"""WITH {fixtures.PROFILE_SQL}, s AS (SELECT c_custkey, unnest(['segment', 'codes', 'packed']) AS tag, unnest([segment, codes, 'a,b=1,2']) AS value FROM profile),
p AS (SELECT * FROM s WHERE trim(value) <> '' QUALIFY row_number() OVER (PARTITION BY tag ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey) <= 200)
SELECT tag, count(*) AS sampled, count(*) FILTER (tag = 'segment' AND value = 'BUILDING') AS mismatched FROM p GROUP BY tag""",
)
def consistency_report(t):
    cells = F.array(
        *[F.struct(F.lit(n).alias("tag"), v.alias("value")) for n, v in (("segment", F.col("segment")), ("codes", F.col("codes")), ("packed", F.lit("a,b=1,2")))]
    )
    stored = fixtures.profile(t).select("c_custkey", F.explode(cells).alias("c")).select("c_custkey", "c.*")
    changed = (
        F.when((F.col("tag") == "segment") & (F.col("value") == "BUILDING"), "MOVED")
        .when(F.col("tag") == "packed", "b,a=2,1")
        .otherwise(F.col("value"))
    )
    return checks.consistency(stored, stored.withColumn("value", changed), "c_custkey", 200)


@query(
    "missing_partitions",
    "A48",
    """WITH d AS (SELECT DISTINCT CASE WHEN o_totalprice > 200000 THEN '' ELSE 'draft ' END || o_orderpriority AS source, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT source, CAST(day AS DATE) AS day FROM (SELECT DISTINCT o_orderpriority AS source FROM orders), (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-07-31', INTERVAL 1 DAY)) AS day)
WHERE (source, CAST(day AS DATE)) NOT IN (SELECT (source, day) FROM d)""",
)
def missing_partitions(t):
    # Smaller orders are present under a source that is not expected.
    kind = F.when(F.col("o_totalprice") > 200000, "").otherwise("draft ")
    present = t.orders.select(F.concat(kind, "o_orderpriority").alias("source"), F.to_date("o_orderdate").alias("day"))
    days = F.sequence(F.lit(date(1995, 1, 1)), F.lit(date(2001, 7, 31)))
    expected = t.orders.select(F.col("o_orderpriority").alias("source")).distinct().select("source", F.explode(days).alias("day"))
    return checks.missing_partitions(expected, present, ["source", "day"])


PROFILED = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority")


# The profile has no form for timestamps; the order's day is text.
ORDERS_TEXT = "(SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders)"


def _profile_sql():
    parts = []
    for i, (name, kind) in enumerate(zip(PROFILED, ("bigint", "bigint", "double", "string", "string", "string"), strict=True)):
        blank = f"{name} IS NULL OR trim(CAST({name} AS VARCHAR)) = ''"
        head = (
            f"SELECT {i + 1} AS column_index, '{name}' AS column_name, '{kind}' AS column_type, count(*) FILTER ({blank}) AS blank_cnt,"
            f" count(*) FILTER (NOT ({blank})) AS valid_cnt, count(DISTINCT {name}) AS distinct_cnt"
        )
        if kind == "string":
            ends = [
                f"(SELECT string_agg(v || ':' || CAST(n AS VARCHAR), ',' ORDER BY n {o}, v) FROM (SELECT {name} AS v, count(*) AS n FROM {ORDERS_TEXT} GROUP BY 1 ORDER BY n {o}, v LIMIT 5))"
                for o in ("DESC", "ASC")
            ]
            numbers = ", ".join(["NULL::DOUBLE"] * 11)
            parts.append(f"{head}, {numbers}, {ends[0]}, {ends[1]} FROM {ORDERS_TEXT}")
        else:
            levels = ", ".join(f"CAST(quantile_disc({name}, {p}) AS DOUBLE) AS p{round(p * 100)}" for p in profile.PROFILE_LEVELS)
            parts.append(
                f"{head}, round(avg({name}), 6) AS mean, CAST(min({name}) AS DOUBLE) AS min, CAST(max({name}) AS DOUBLE) AS max, round(stddev_pop({name}), 6) AS stddev, {levels},"
                f" NULL::VARCHAR AS top_values, NULL::VARCHAR AS bottom_values FROM {ORDERS_TEXT}"
            )
    return " UNION ALL ".join(parts)


@query("column_profile", "A47", _profile_sql())
def column_profile(t):
    report = profile.column_profile(t.orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")).select(*PROFILED))
    return report.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


@query(
    "grouped_quantiles",
    "A47",
    """SELECT l_returnflag, unnest([0.25, 0.5, 0.95]::DOUBLE[]) AS level, unnest(quantile_disc(l_extendedprice, [0.25, 0.5, 0.95])) AS price FROM lineitem GROUP BY l_returnflag""",
)
def grouped_quantiles(t):
    counts = t.lineitem.groupBy("l_returnflag", F.col("l_extendedprice").alias("price")).agg(F.count("*").alias("n"))
    return checks.exact_quantiles(counts, "l_returnflag", "price", "n", [0.25, 0.5, 0.95])


@query(
    "code_derivation",
    "X22",
    """SELECT n_nationkey + 100 * r_regionkey AS code, n_name || '_' || r_name AS name FROM nation, region""",
)
def code_derivation(t):
    kinds = t.region.agg(F.sort_array(F.collect_list(F.struct("r_regionkey", "r_name")))).scalar()
    derived = t.nation.select("n_nationkey", "n_name", F.explode(kinds).alias("k"))
    return derived.select(
        (F.col("n_nationkey") + 100 * F.col("k.r_regionkey")).cast("long").alias("code"), F.concat_ws("_", "n_name", "k.r_name").alias("name")
    )


@query(
    "size_based_files",
    "K10",
    "SELECT greatest(1, count(*) // 10000) AS files FROM lineitem",
)
def size_based_files(t):
    path = scratch_path(t.spark, "sized")
    sinks.write_sized(t.lineitem.select("l_orderkey", "l_linenumber"), path, 10000)
    files = t.spark.read.parquet(path).select(F.input_file_name().alias("file")).distinct()
    return files.agg(F.count("*").alias("files"))
