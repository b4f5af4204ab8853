"""Activity bitmaps, interval filters, lifecycle, churn, health and score bands."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from cohortloom.functions import bitmaps
from cohortloom.operators import activity, distinct, lifecycle
from cohortloom.operators.activity import IntervalRule
from cohortloom.plans import fixtures
from cohortloom.plans.registry import query
from cohortloom.session import scratch_path
from cohortloom.sources import sinks

CURRENT = fixtures.CURRENT
STATUS = fixtures.STATUS_SQL

# Two months ago stand-in: half of the days are moved to the previous November.
CODED_SQL = f"""{STATUS}, coded AS (SELECT user_id, app, CASE WHEN event_id % 2 = 0 THEN day ELSE CAST(day - INTERVAL 2 MONTH AS DATE) END AS day,
  CASE status WHEN 'uninstall' THEN -1 WHEN 'install' THEN 1 WHEN 'active' THEN 3 WHEN 'click' THEN 2 ELSE 0 END AS code FROM daily),
marks AS (SELECT *, code IN (-1, 0, 1, 2) AS installed, code = 3 AS active, code = -1 AS uninstall, code = 1 AS new_install FROM coded)"""


def _coded(t):
    rows = fixtures.daily(t)
    day = F.when(F.col("event_id") % 2 == 0, F.col("day")).otherwise(F.add_months("day", -2))
    code = (
        F.when(F.col("status") == "uninstall", -1)
        .when(F.col("status") == "install", 1)
        .when(F.col("status") == "active", 3)
        .when(F.col("status") == "click", 2)
        .otherwise(0)
    )
    return rows.select("user_id", "app", day.alias("day"), code.alias("code"))


def _bitmaps(t, rows=None, current=CURRENT):
    return activity.build_bitmaps(_coded(t) if rows is None else rows, "user_id", "app", "code", "day", current)


def _bits_sql(flag: str, where: str) -> str:
    return f"CAST(bit_or(CASE WHEN {flag} AND {where} THEN 1 << (CAST(date_part('day', day) AS INTEGER) - 1) ELSE 0 END) AS BIGINT)"


NOW, NOVEMBER = "date_part('month', day) = 1", "date_part('month', day) = 11"
BITMAP_COLUMNS_SQL = ", ".join(
    f"CASE WHEN bool_or({s}) THEN {_bits_sql(s, NOW)} END AS {s}_now, CASE WHEN bool_or({s}) THEN {_bits_sql(s, NOVEMBER)} END AS {s}_november"
    for s in activity.STATUSES
)


def _shown(df):
    columns = [
        F.col(s)[slot].cast("long").alias(f"{s}_{name}")
        for s in activity.STATUSES
        for slot, name in ((0, "now"), (11, "november"))
    ]
    return df.select("user_id", "app", "upper_time", *columns)


@query(
    "activity_bitmaps",
    "A26 X13",
    f"WITH {CODED_SQL} SELECT user_id, app, max(day) AS upper_time, {BITMAP_COLUMNS_SQL} FROM marks GROUP BY user_id, app",
)
def activity_bitmaps(t):
    return _shown(_bitmaps(t))


@query(
    "bitmap_earlier_day",
    "A26",
    f"WITH {CODED_SQL} SELECT user_id, app, max(day) AS upper_time, {BITMAP_COLUMNS_SQL} FROM marks WHERE day <= DATE '2024-01-12' GROUP BY user_id, app",
)
def bitmap_earlier_day(t):
    return _shown(_bitmaps(t, current=date(2024, 1, 12)))


@query(
    "bitmap_increment",
    "A27",
    f"WITH {CODED_SQL} SELECT user_id, app, max(day) AS upper_time, {BITMAP_COLUMNS_SQL} FROM marks GROUP BY user_id, app",
)
def bitmap_increment(t):
    # The last day arrives twice: a repeated run must not change the result.
    rows = _coded(t)
    before = _bitmaps(t, rows.where(F.col("day") != F.lit(CURRENT)))
    today = rows.where(F.col("day") == F.lit(CURRENT))
    once = activity.add_day(before, today, "user_id", "app", "code", CURRENT)
    return _shown(activity.add_day(once, today, "user_id", "app", "code", CURRENT))


@query(
    "bitmap_month_end",
    "A27",
    f"""WITH {CODED_SQL}, m AS (SELECT user_id, app, max(day) AS upper_time, CAST(bit_or(CASE WHEN active AND {NOW} THEN 1 << (CAST(date_part('day', day) AS INTEGER) - 1) ELSE 0 END) AS BIGINT) AS b, bool_or(active) AS seen FROM marks GROUP BY user_id, app)
SELECT user_id, app, upper_time, CASE WHEN seen THEN 0 END AS active_now, CASE WHEN seen THEN b END AS active_january FROM m""",
)
def bitmap_month_end(t):
    state = _bitmaps(t)
    none = _coded(t).where("code = 99")
    closed = activity.add_day(state, none, "user_id", "app", "code", date(2024, 1, 31))
    return closed.select(
        "user_id", "app", "upper_time", F.col("active")[0].cast("long").alias("active_now"), F.col("active")[1].cast("long").alias("active_january")
    )


def _hits_sql(items, status, start, end):
    listed = ", ".join(f"'{i.lower()}'" for i in items)
    return (
        f"SELECT user_id, count(DISTINCT lower(app)) AS h FROM marks WHERE {status} AND lower(app) IN ({listed}) "
        f"AND day BETWEEN DATE '{start}' AND DATE '{end}' GROUP BY user_id"
    )


ITEMS = ("App-1", "APP-2", "app-5")
FIRST = _hits_sql(ITEMS, "active", "2023-11-10", "2024-01-12")
SECOND = _hits_sql(("app-3", "app-4"), "uninstall", "2024-01-02", "2024-01-09")


def _seeds(t):
    """Customers with their multiplicity in orders: duplicate seeds must stay."""
    return t.orders.select(F.col("o_custkey").alias("user_id"), "o_orderkey")


def _interval(t, seeds, *rules):
    return activity.activity_filter(seeds, _bitmaps(t), "user_id", "app", list(rules), CURRENT)


def _rule(restrict, include=True):
    return IntervalRule(ITEMS, "active", date(2023, 11, 10), date(2024, 1, 12), restrict, include)


@query(
    "interval_filter_any",
    "F16 F14",
    f"WITH {CODED_SQL}, h AS ({FIRST}) SELECT o_custkey AS user_id, o_orderkey FROM orders JOIN h ON user_id = o_custkey WHERE h >= 1",
)
def interval_filter_any(t):
    return _interval(t, _seeds(t), _rule("0"))


@query(
    "interval_filter_all",
    "F16",
    f"WITH {CODED_SQL}, h AS ({FIRST}) SELECT o_custkey AS user_id, o_orderkey FROM orders JOIN h ON user_id = o_custkey WHERE h = 3",
)
def interval_filter_all(t):
    return _interval(t, _seeds(t), _rule("1"))


@query(
    "interval_filter_range",
    "F16",
    f"WITH {CODED_SQL}, h AS ({FIRST}) SELECT user_id FROM h WHERE h >= 1 AND h < 3",
)
def interval_filter_range(t):
    return _interval(t, None, _rule("1,3"))


@query(
    "interval_filter_exclude",
    "F16",
    f"WITH {CODED_SQL}, h AS ({FIRST}) SELECT o_custkey AS user_id, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM h)",
)
def interval_filter_exclude(t):
    return _interval(t, _seeds(t), _rule("0", include=False))


@query(
    "interval_rule_conjunction",
    "F16 J17",
    f"""WITH {CODED_SQL}, a AS ({FIRST}), b AS ({SECOND})
SELECT o_custkey AS user_id, o_orderkey FROM orders JOIN a ON a.user_id = o_custkey WHERE a.h >= 2 AND a.h < 4 AND o_custkey NOT IN (SELECT user_id FROM b)""",
)
def interval_rule_conjunction(t):
    second = IntervalRule(("app-3", "app-4"), "uninstall", date(2024, 1, 2), date(2024, 1, 9), "0", include=False)
    return _interval(t, _seeds(t), _rule("2,4"), second)


@query(
    "interval_filter_by_list",
    "F16",
    f"""WITH {CODED_SQL}, s AS (SELECT o_custkey AS user_id, o_orderkey, 'App-' || CAST(o_orderkey % 8 AS VARCHAR) || '|APP-' || CAST(o_custkey % 8 AS VARCHAR) AS list FROM orders),
x AS (SELECT user_id, o_orderkey, list, unnest(list_distinct(string_split(lower(list), '|'))) AS item FROM s),
h AS (SELECT DISTINCT user_id, lower(app) AS item FROM marks WHERE active AND day BETWEEN DATE '2023-11-10' AND DATE '2024-01-25')
SELECT user_id, o_orderkey, list FROM x LEFT JOIN h USING (user_id, item) GROUP BY ALL HAVING count(h.item) = count(*)""".replace(
        "count(h.item)", "count(CASE WHEN (user_id, item) IN (SELECT (user_id, item) FROM h) THEN 1 END)"
    ).replace("FROM x LEFT JOIN h USING (user_id, item)", "FROM x"),
)
def interval_filter_by_list(t):
    seeds = t.orders.select(
        F.col("o_custkey").alias("user_id"),
        "o_orderkey",
        F.concat(
            F.lit("App-"), (F.col("o_orderkey") % 8).cast("string"), F.lit("|APP-"), (F.col("o_custkey") % 8).cast("string")
        ).alias("list"),
    )
    return activity.activity_filter_by_list(
        seeds, _bitmaps(t), "user_id", "app", "list", r"\|", "active", date(2023, 11, 10), date(2024, 1, 25), CURRENT, "1"
    )


OLD_SQL = f"""{CODED_SQL}, old AS (SELECT * REPLACE (day - CAST(user_id % 3 AS INTEGER) * 400 AS day) FROM marks)"""


@query(
    "interval_filter_clamped",
    "F14 F16",
    f"""WITH {OLD_SQL}, h AS (SELECT user_id, count(DISTINCT lower(app)) AS h FROM old WHERE active AND lower(app) IN ('app-1', 'app-2', 'app-5')
  AND day BETWEEN DATE '2023-01-01' AND DATE '2024-01-31' GROUP BY user_id)
SELECT o_custkey AS user_id, o_orderkey FROM orders JOIN h ON user_id = o_custkey""",
)
def interval_filter_clamped(t):
    """A rule from 2021 to 2025: only the days of the thirteen months up to the current one count."""
    rows = _coded(t).withColumn("day", F.date_sub("day", (F.col("user_id") % 3).cast("int") * 400))
    rule = IntervalRule(ITEMS, "active", date(2021, 1, 1), date(2025, 12, 31))
    return activity.activity_filter(_seeds(t), _bitmaps(t, rows), "user_id", "app", [rule], CURRENT)


@query(
    "rule_conjunction",
    "J17",
    """SELECT c_custkey FROM customer WHERE c_acctbal > 4000 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)""",
)
def rule_conjunction(t):
    results = [
        t.customer.where("c_acctbal > 4000").select("c_custkey"),
        t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")),
        t.orders.where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")),
    ]
    return activity.satisfied_rules(results, ["c_custkey"])


@query(
    "bitmap_day_counts",
    "X13",
    f"WITH {CODED_SQL} SELECT user_id, app, count(DISTINCT day) AS active_days FROM marks WHERE active GROUP BY ALL",
)
def bitmap_day_counts(t):
    seen = _bitmaps(t).where("active is not null")
    return seen.select("user_id", "app", bitmaps.set_bits(F.col("active")).cast("long").alias("active_days"))


# The days of three quarters of the users are moved back, so that the long windows have something to tell; the
# last days of the data lie after ``TODAY``.
TODAY = date(2024, 1, 25)
DAYS = [TODAY - timedelta(days=i) for i in (4, 3, 2, 1, 0)]


def _classes_sql(days):
    listed = ", ".join(f"DATE '{d}'" for d in days)
    return f"""{STATUS}, shifted AS (SELECT * REPLACE (day - CAST(user_id % 4 AS INTEGER) * 35 AS day) FROM daily), days AS (SELECT unnest([{listed}]) AS d),
i AS (SELECT d, app, user_id,
  count(DISTINCT day) FILTER (status = 'active' AND d - day < 90) AS cnt_day_90,
  count(DISTINCT day) FILTER (status = 'active' AND d - day < 30) AS cnt_day_30,
  count(DISTINCT day) FILTER (status = 'active' AND d - day < 7) AS cnt_day_7,
  CASE WHEN max(CASE WHEN status IN ('install', 'uninstall') THEN CAST(day AS VARCHAR) || status END) LIKE '%uninstall' THEN 1 ELSE 0 END AS uninstall_flag,
  max(CASE WHEN status = 'install' AND d - day < 30 THEN 1 ELSE 0 END) AS install_flag,
  arg_max(duration, CAST(day AS VARCHAR) || lpad(CAST(duration AS VARCHAR), 12, '0')) AS duration
  FROM shifted JOIN days ON day <= d GROUP BY ALL),
classes AS (SELECT *, CASE WHEN cnt_day_90 = 0 OR uninstall_flag = 1 THEN 4 WHEN install_flag > 0 THEN 1 WHEN cnt_day_90 > 0 AND cnt_day_90 < 3 THEN 3 WHEN cnt_day_90 >= 3 THEN 2 ELSE 0 END AS user_type FROM i),
counts AS (SELECT d, app, count(*) FILTER (user_type = 1) AS new, count(*) FILTER (user_type = 2) AS active,
  count(*) FILTER (user_type = 3) AS silent, count(*) FILTER (user_type = 4) AS lost,
  count(*) FILTER (user_type = 1 AND cnt_day_30 >= 10) AS new_often, count(*) FILTER (user_type = 1 AND cnt_day_30 < 10) AS new_seldom,
  count(*) FILTER (user_type = 2 AND cnt_day_90 >= 30) AS active_often, count(*) FILTER (user_type = 2 AND cnt_day_90 < 30) AS active_seldom,
  count(*) FILTER (user_type = 2 AND cnt_day_7 = 0) AS active_not_this_week,
  count(*) FILTER (user_type = 3 AND duration < 600000) AS silent_short, count(*) FILTER (user_type = 3 AND duration >= 600000) AS silent_long
  FROM classes GROUP BY d, app)"""


def _classes(t, today=TODAY):
    rows = fixtures.daily(t).withColumn("day", F.date_sub("day", (F.col("user_id") % 4).cast("int") * 35))
    return lifecycle.lifecycle_class(lifecycle.lifecycle_inputs(rows, "app", "user_id", "day", "status", "duration", today))


@query(
    "lifecycle_classes",
    "A13",
    f"WITH {_classes_sql([TODAY])} SELECT app, user_id, cnt_day_90, cnt_day_30, cnt_day_7, uninstall_flag, install_flag, duration, user_type FROM classes",
)
def lifecycle_classes(t):
    return _classes(t)


@query("lifecycle_counts", "A14", f"WITH {_classes_sql([TODAY])} SELECT * EXCLUDE (d) FROM counts")
def lifecycle_counts(t):
    return lifecycle.lifecycle_counts(_classes(t), "app")


@query(
    "health_score",
    "A15",
    f"""WITH {_classes_sql(DAYS)}, r AS (SELECT c.*, CASE WHEN p.app IS NOT NULL AND c.new > 0 THEN c.new / (p.new + p.active + p.silent + p.lost) ELSE 0 END AS growth
  FROM counts c LEFT JOIN counts p ON p.app = c.app AND p.d = c.d - 1),
a AS (SELECT app, avg(growth) AS a FROM r WHERE d < DATE '{TODAY}' AND d >= DATE '{TODAY}' - 90 GROUP BY app),
x AS (SELECT r.app, growth, a, new / CASE WHEN lost <> 0 THEN lost ELSE 1 END AS nr, active / CASE WHEN silent <> 0 THEN silent ELSE 1 END AS ar FROM r LEFT JOIN a USING (app) WHERE d = DATE '{TODAY}'),
s AS (SELECT app, growth, ((CASE WHEN nr >= 1 THEN 100 WHEN nr < 0.5 THEN 0 ELSE 100 - (1 - nr) * 2 END) + (CASE WHEN ar >= 1 THEN 100 WHEN ar < 0.5 THEN 0 ELSE 100 - (1 - ar) * 2 END)) / 2 AS comp,
  CASE WHEN coalesce(a, 0) - growth <= 0.05 THEN 100 ELSE growth / (a - 0.05) END AS gv FROM x)
SELECT app, round(gv, 6) AS growth_score, round(comp, 6) AS class_score, round((gv + comp) / 2, 6) AS score, round(growth, 6) AS growth FROM s""",
)
def health_score(t):
    """Five daily runs: each counts its own day, reads the day before from the stored table and adds a partition."""
    path = scratch_path(t.spark, "health")
    for day in DAYS:
        lifecycle.store_day(t.spark, path, lifecycle.lifecycle_counts(_classes(t, day), "app"), "app", day)
    scored = lifecycle.stored_health(t.spark, path, "app", TODAY)
    return scored.select("app", *[F.round(c, 6).alias(c) for c in scored.columns if c != "app"])


@query(
    "active_device_counts",
    "A16",
    f"""WITH {STATUS} SELECT app, user_id % 2 AS plat, count(DISTINCT user_id) AS device_cnt, lower(app) AS app_key FROM daily WHERE status = 'active' GROUP BY ALL""",
)
def active_device_counts(t):
    rows = fixtures.daily(t)
    apps = rows.select("app", F.lower("app").alias("app_key")).distinct()
    active = rows.where("status = 'active'").withColumn("plat", F.col("user_id") % 2)
    return lifecycle.active_counts(active, "app", "plat", "user_id", apps)


WEEK = [date(2024, 1, 8) + timedelta(days=i) for i in range(7)]


@query(
    "weekly_counts_from_days",
    "A2 A16 A19",
    f"""WITH {STATUS}, w AS (SELECT * FROM daily WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14')
SELECT app, count(DISTINCT user_id) FILTER (status = 'active') AS active, count(DISTINCT user_id) FILTER (status <> 'uninstall') AS installed FROM w WHERE status <> 'uninstall' GROUP BY app""",
)
def weekly_counts_from_days(t):
    """Distinct users of a week from seven stored daily states."""
    path = scratch_path(t.spark, "distinct-days")
    for day in WEEK:
        rows = fixtures.daily(t).where((F.col("day") == F.lit(day)) & (F.col("status") != "uninstall"))
        kinds = F.when(F.col("status") == "active", F.array(F.lit("installed"), F.lit("active"))).otherwise(F.array(F.lit("installed")))
        state = distinct.day_state(rows.withColumn("kind", F.explode(kinds)), ["app", "kind"], "user_id")
        sinks.overwrite_with(state, path, {"day": day.isoformat()})
    week = distinct.merged(t.spark.read.parquet(path), ["app", "kind"])
    counted = distinct.counts(week, ["app", "kind"])
    per_kind = [F.coalesce(F.max(F.when(F.col("kind") == k, F.col("cnt"))), F.lit(0)).alias(k) for k in ("active", "installed")]
    return counted.groupBy("app").agg(*per_kind)


NET_SQL = f"""{STATUS}, m AS (SELECT app, user_id, day, CASE WHEN status = 'uninstall' THEN 1 ELSE 0 END AS u, CASE WHEN status = 'install' THEN 1 ELSE 0 END AS i FROM daily WHERE status IN ('install', 'uninstall')),
net AS (SELECT app, user_id, day, CASE WHEN sum(u) > sum(i) THEN 1 ELSE 0 END AS uninstall, CASE WHEN sum(u) < sum(i) THEN 1 ELSE 0 END AS install FROM m GROUP BY app, user_id, day HAVING sum(u) <> sum(i))"""


def _daily_net(t):
    marks = lifecycle.daily_marks(fixtures.daily(t), "app", "user_id", "day", "status")
    sums = marks.withColumn("pair", F.struct("user_id", "day"))
    return lifecycle.net_state(sums, "app", "pair").select("app", "pair.*", "uninstall", "install")


@query("daily_net_state", "A18", f"WITH {NET_SQL} SELECT * FROM net")
def daily_net_state(t):
    return _daily_net(t)


@query(
    "daily_churn",
    "A19",
    f"""WITH {NET_SQL}, b AS (SELECT app, count(DISTINCT user_id) AS installed FROM daily WHERE day = DATE '2024-01-10' AND status <> 'uninstall' GROUP BY app),
l AS (SELECT app, count(*) AS uninstall FROM net WHERE day = DATE '2024-01-10' AND uninstall > install GROUP BY app)
SELECT app, coalesce(uninstall, 0) AS uninstall, coalesce(installed, 0) AS installed FROM b FULL JOIN l USING (app)""",
)
def daily_churn(t):
    on = F.col("day") == F.lit(date(2024, 1, 10))
    installed = lifecycle.installed_counts(fixtures.daily(t).where(on & (F.col("status") != "uninstall")), "app", "user_id")
    return lifecycle.churn_counts(_daily_net(t).where(on), installed, "app")


@query(
    "weekly_churn",
    "A20",
    f"""WITH {NET_SQL}, b AS (SELECT app, count(DISTINCT user_id) AS installed FROM daily WHERE day = DATE '2024-01-08' AND status <> 'uninstall' GROUP BY app),
l AS (SELECT app, count(*) AS uninstall FROM (SELECT app, user_id FROM net WHERE day BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY ALL HAVING sum(uninstall) > sum(install)) GROUP BY app)
SELECT app, coalesce(uninstall, 0) AS uninstall, coalesce(installed, 0) AS installed FROM b FULL JOIN l USING (app)""",
)
def weekly_churn(t):
    first, last = date(2024, 1, 8), date(2024, 1, 14)
    start = fixtures.daily(t).where((F.col("day") == F.lit(first)) & (F.col("status") != "uninstall"))
    base = lifecycle.installed_counts(start, "app", "user_id")
    return lifecycle.window_churn(_daily_net(t), base, "app", "user_id", "day", first, last)


@query(
    "cumulative_churn",
    "A21",
    f"""WITH {NET_SQL}, c AS (SELECT DISTINCT app, user_id FROM daily WHERE day = DATE '2024-01-01'),
r AS (SELECT app, user_id, CASE WHEN sum(uninstall) > sum(install) THEN 1 ELSE 0 END AS u, CASE WHEN sum(uninstall) < sum(install) THEN 1 ELSE 0 END AS i FROM net GROUP BY ALL HAVING sum(uninstall) <> sum(install)),
x AS (SELECT app, user_id, 0 AS u, 1 AS i FROM c UNION ALL SELECT app, user_id, u, i FROM r),
s AS (SELECT app, user_id, sum(u) AS u, sum(i) AS i FROM x GROUP BY ALL)
SELECT app, count(*) FILTER (u > 0) AS uninstall, count(*) FILTER (i > 0) AS installed, round(count(*) FILTER (u > 0) / count(*) FILTER (i > 0) * 100, 1) AS percent FROM s GROUP BY app""",
)
def cumulative_churn(t):
    cohort = fixtures.daily(t).where(F.col("day") == F.lit(date(2024, 1, 1))).select("app", "user_id").distinct()
    running = lifecycle.net_state(_daily_net(t), "app", "user_id")
    return lifecycle.cumulative_churn(cohort, running, "app", "user_id")


@query(
    "new_keys",
    "J9",
    """SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01')""",
)
def new_keys(t):
    recent = t.orders.where(F.col("o_orderdate") >= "2001-01-01")
    return lifecycle.new_apps(recent, t.orders.where(F.col("o_orderdate") < "2001-01-01"), "o_custkey")


SCORES_SQL = "scores AS (SELECT user_id, event_type, (event_id % 1000) / 1000.0 AS p FROM events)"
BAND_SQL = "CASE WHEN p >= 0.9 THEN '0.9' WHEN p >= 0.7 THEN '0.7' WHEN p >= 0.6 THEN '0.6' WHEN p >= 0.5 THEN '0.5' END"


@query(
    "score_bands",
    "A41",
    f"""WITH {SCORES_SQL}, b AS (SELECT user_id, event_type, max(p) AS p FROM scores WHERE p >= 0.5 GROUP BY ALL)
SELECT user_id, string_agg(event_type || '=' || {BAND_SQL}, ';' ORDER BY event_type) AS flags FROM b GROUP BY user_id""",
)
def score_bands(t):
    scores = t.events.select("user_id", "event_type", ((F.col("event_id") % 1000) / 1000.0).alias("p"))
    return lifecycle.band_maps(scores, "user_id", "event_type", "p").select("user_id", fixtures.map_text(F.col("flags")).alias("flags"))


@query(
    "score_band_columns",
    "A41 W1",
    f"""WITH scores AS (SELECT event_type, CAST(ts AS DATE) AS run, (event_id % 1000) / 1000.0 AS p FROM events),
b AS (SELECT event_type, {BAND_SQL} AS band FROM scores QUALIFY run = max(run) OVER (PARTITION BY event_type)),
n AS (SELECT event_type, band, count(*) AS cnt FROM b GROUP BY event_type, band),
c AS (SELECT event_type, band, cnt * 100 / sum(cnt) OVER (PARTITION BY event_type) AS pc FROM n)
SELECT event_type, round(max(pc) FILTER (band = '0.9'), 4) AS percent_90, round(max(pc) FILTER (band = '0.7'), 4) AS percent_70, round(max(pc) FILTER (band = '0.5'), 4) AS percent_50,
  NULL::DOUBLE AS percent_20 FROM c WHERE band IS NOT NULL GROUP BY event_type""",
)
def score_band_columns(t):
    scores = t.events.select("event_type", F.to_date("ts").alias("run"), ((F.col("event_id") % 1000) / 1000.0).alias("p"))
    shares = lifecycle.band_percentages(scores, "event_type", "p", "run")
    return lifecycle.band_columns(shares, "event_type", {"0.9": "percent_90", "0.7": "percent_70", "0.5": "percent_50", "0.2": "percent_20"})
