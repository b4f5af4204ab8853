"""Lifecycle classes, churn counts, health score and score bands."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.sources.sinks import overwrite_with

# Fixed class codes.
NEW, ACTIVE, SILENT, LOST = 1, 2, 3, 4


def lifecycle_inputs(daily: DataFrame, app: str, entity: str, day: str, status: str, duration: str, today) -> DataFrame:
    """Per (app, entity): active days in the last 90/30/7 days, whether the last install state is
    uninstalled, whether installed in the last 30 days, and the latest duration.
    ``status``: active, install, uninstall; one aggregate over the daily rows up to ``today``."""
    daily = daily.where(F.col(day) <= F.lit(today))
    age = F.datediff(F.lit(today), F.col(day))
    active = F.col(status) == "active"

    def day_bits(low: int, high: int) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), age - low)
        return F.coalesce(F.bit_or(F.when(active & (age >= low) & (age < high), bit)), F.lit(0).cast("long"))

    # Active days as bits by age: the buffer stays two longs per pair, no distinct is needed.
    recent, older = day_bits(0, 60), day_bits(60, 90)
    changes = F.when(F.col(status).isin("install", "uninstall"), F.struct(F.col(day), F.col(status)))
    return daily.groupBy(app, entity).agg(
        (F.bit_count(recent) + F.bit_count(older)).alias("cnt_day_90"),
        F.bit_count(recent.bitwiseAND(F.lit((1 << 30) - 1))).alias("cnt_day_30"),
        F.bit_count(recent.bitwiseAND(F.lit((1 << 7) - 1))).alias("cnt_day_7"),
        F.coalesce((F.max(changes)[status] == "uninstall").cast("int"), F.lit(0)).alias("uninstall_flag"),
        F.coalesce(
            F.max(F.when((F.col(status) == "install") & (age >= 0) & (age < 30), 1)), F.lit(0)
        ).alias("install_flag"),
        F.coalesce(F.max(F.struct(F.col(day), F.col(duration)))[duration], F.lit(0)).alias("duration"),
    )


def lifecycle_class(df: DataFrame) -> DataFrame:
    """Lost: not seen in 90 days or uninstalled; new: installed in 30 days; silent: 1-2 active days;
    active: 3 or more; otherwise 0."""
    seen = F.col("cnt_day_90")
    klass = (
        F.when((seen == 0) | (F.col("uninstall_flag") == 1), LOST)
        .when(F.col("install_flag") > 0, NEW)
        .when((seen > 0) & (seen < 3), SILENT)
        .when(seen >= 3, ACTIVE)
        .otherwise(0)
    )
    return df.withColumn("user_type", klass)


# Fixed bounds of the sub-classes: days of activity, and milliseconds of use.
OFTEN_IN_30, OFTEN_IN_90, SHORT_USE = 10, 30, 600000


def lifecycle_counts(classes: DataFrame, app: str) -> DataFrame:
    """Class and sub-class counts per app in one partial aggregate."""
    kind = F.col("user_type")
    often_new = (kind == NEW) & (F.col("cnt_day_30") >= OFTEN_IN_30)
    often_active = (kind == ACTIVE) & (F.col("cnt_day_90") >= OFTEN_IN_90)
    short_silent = (kind == SILENT) & (F.col("duration") < SHORT_USE)
    counted = {
        "new": kind == NEW,
        "active": kind == ACTIVE,
        "silent": kind == SILENT,
        "lost": kind == LOST,
        "new_often": often_new,
        "new_seldom": (kind == NEW) & ~often_new,
        "active_often": often_active,
        "active_seldom": (kind == ACTIVE) & ~often_active,
        "active_not_this_week": (kind == ACTIVE) & (F.col("cnt_day_7") == 0),
        "silent_short": short_silent,
        "silent_long": (kind == SILENT) & ~short_silent,
    }
    return classes.groupBy(app).agg(*[F.count_if(c).alias(n) for n, c in counted.items()])


def _ratio_score(ratio: Column) -> Column:
    return F.when(ratio >= 1, 100.0).when(ratio < 0.5, 0.0).otherwise(100 - (1 - ratio) * 2)


# Fixed tolerance of the growth score, and days of its average.
GROWTH_TOLERANCE, GROWTH_DAYS = 0.05, 90


def growth_rates(counts: DataFrame, app: str, day: str) -> DataFrame:
    """``counts`` of each day plus ``growth``: new entities against all of the day before; 0 without a day
    before or without new ones. One row per (app, day)."""
    before = counts.select(F.col(app), F.date_add(day, 1).alias(day), _everyone().alias("_base"))
    return counts.join(before, [app, day], "left").withColumn("growth", _growth()).drop("_base")


def _everyone() -> Column:
    return F.col("new") + F.col("active") + F.col("silent") + F.col("lost")


def _growth() -> Column:
    return F.when(F.col("_base").isNotNull() & (F.col("new") > 0), F.try_divide("new", "_base")).otherwise(F.lit(0.0))


def _with_growth(counts: DataFrame, yesterday: DataFrame | None, app: str) -> DataFrame:
    if yesterday is None:
        return counts.withColumn("growth", F.lit(0.0))
    before = yesterday.select(F.col(app), _everyone().alias("_base"))
    return counts.join(before, app, "left").withColumn("growth", _growth()).drop("_base")


def health_score(rates: DataFrame, app: str, day: str, today) -> DataFrame:
    """Health per app on ``today`` from the daily table of ``growth_rates``: how new compares with lost and
    active with silent, and today's growth against its average over the ``GROWTH_DAYS`` days before."""
    age = F.datediff(F.lit(today), F.col(day))
    average = rates.where((age > 0) & (age <= GROWTH_DAYS)).groupBy(app).agg(F.avg("growth").alias("_avg"))
    new_ratio = F.col("new") / F.when(F.col("lost") != 0, F.col("lost")).otherwise(1)
    active_ratio = F.col("active") / F.when(F.col("silent") != 0, F.col("silent")).otherwise(1)
    gap = F.coalesce("_avg", F.lit(0.0)) - F.col("growth")
    scored = rates.where(age == 0).join(average, app, "left").select(
        app,
        F.when(gap <= GROWTH_TOLERANCE, 100.0).otherwise(F.col("growth") / (F.col("_avg") - GROWTH_TOLERANCE)).alias("growth_score"),
        ((_ratio_score(new_ratio) + _ratio_score(active_ratio)) / 2).alias("class_score"),
        "growth",
    )
    return scored.withColumn("score", (F.col("growth_score") + F.col("class_score")) / 2)


def store_day(spark: SparkSession, path: str, counts: DataFrame, app: str, today: date) -> None:
    """Writes a day's ``lifecycle_counts`` with their ``growth`` as partition ``day`` of the stored table, which is
    read for the day before only. Running a day again replaces its partition."""
    rates = _with_growth(counts, _stored_days(spark, path, today - timedelta(days=1), today - timedelta(days=1)), app)
    overwrite_with(rates, path, {"day": today.isoformat()})


def stored_health(spark: SparkSession, path: str, app: str, today: date) -> DataFrame:
    """``health_score`` of a day from the stored table: its own partition and the ``GROWTH_DAYS`` before it."""
    return health_score(_stored_days(spark, path, today - timedelta(days=GROWTH_DAYS), today), app, "day", today)


def _stored_days(spark: SparkSession, path: str, first: date, last: date) -> DataFrame | None:
    """The rows of the days from ``first`` to ``last``; other partitions are not listed. None before the first write."""
    try:
        table = spark.read.option("basePath", path).parquet(path)
    except AnalysisException:
        return None
    return table.where(F.col("day").between(F.lit(first), F.lit(last)))


def active_counts(daily: DataFrame, app: str, platform: str, entity: str, apps: DataFrame) -> DataFrame:
    """Distinct active entities per (app, platform) for the apps of a key table (app, app_key)."""
    pairs = daily.select(app, platform, entity).distinct().groupBy(app, platform)
    return pairs.agg(F.count(entity).alias("device_cnt")).join(apps, app)


def net_state(df: DataFrame, app: str, entity: str) -> DataFrame:
    """Sum of uninstall and install marks per (app, entity); equal sums drop, the rest become 1/0 flags."""
    sums = df.groupBy(app, entity).agg(F.sum("uninstall").alias("_u"), F.sum("install").alias("_i"))
    return sums.where("_u != _i").select(
        app, entity, (F.col("_u") > F.col("_i")).cast("int").alias("uninstall"), (F.col("_u") < F.col("_i")).cast("int").alias("install")
    )


def daily_marks(daily: DataFrame, app: str, entity: str, day: str, status: str) -> DataFrame:
    """0/1 marks of install and uninstall rows."""
    return daily.where(F.col(status).isin("install", "uninstall")).select(
        app,
        entity,
        day,
        (F.col(status) == "uninstall").cast("int").alias("uninstall"),
        (F.col(status) == "install").cast("int").alias("install"),
    )


def churn_counts(states: DataFrame, installed: DataFrame, app: str) -> DataFrame:
    """Entities whose net state is uninstalled, next to the installed count per app."""
    lost = states.where("uninstall > install").groupBy(app).agg(F.count("*").alias("uninstall"))
    both = lost.unionByName(installed.select(app, F.col("cnt").alias("installed")), allowMissingColumns=True)
    return both.groupBy(app).agg(
        F.coalesce(F.sum("uninstall"), F.lit(0)).alias("uninstall"),
        F.coalesce(F.sum("installed"), F.lit(0)).alias("installed"),
    )


def installed_counts(daily: DataFrame, app: str, entity: str) -> DataFrame:
    return daily.select(app, entity).distinct().groupBy(app).agg(F.count(entity).alias("cnt"))


def window_churn(daily_states: DataFrame, base: DataFrame, app: str, entity: str, day: str, start, end) -> DataFrame:
    """Net state over a window of days against the installed base of its first day."""
    window = daily_states.where(F.col(day).between(F.lit(start), F.lit(end)))
    return churn_counts(net_state(window, app, entity), base, app)


def cumulative_churn(cohort: DataFrame, states: DataFrame, app: str, entity: str) -> DataFrame:
    """Base cohort plus running net states: lost and remaining entities and the lost percentage.
    ``cohort`` rows count as one install each."""
    base = cohort.select(app, entity, F.lit(0).alias("uninstall"), F.lit(1).alias("install"))
    sums = base.unionByName(states.select(app, entity, "uninstall", "install")).groupBy(app, entity).agg(
        F.sum("uninstall").alias("u"), F.sum("install").alias("i")
    )
    counts = sums.groupBy(app).agg(F.count_if(F.col("u") > 0).alias("uninstall"), F.count_if(F.col("i") > 0).alias("installed"))
    return counts.withColumn("percent", F.round(F.try_divide("uninstall", "installed") * 100, 1))


def new_apps(today: DataFrame, yesterday: DataFrame, app: str) -> DataFrame:
    return today.select(app).distinct().join(yesterday.select(app).distinct(), app, "left_anti")


# Fixed probability bands, highest first.
BANDS = (0.9, 0.7, 0.6, 0.5)


def score_band(probability: Column) -> Column:
    """Text of the highest band reached; null below the lowest."""
    out = F.lit(None).cast("string")
    for band in sorted(BANDS):
        out = F.when(probability >= band, F.lit(str(band))).otherwise(out)
    return out


def band_maps(scores: DataFrame, entity: str, item: str, probability: str) -> DataFrame:
    """Per entity ``map<item, band>`` of its banded items; an item scored twice keeps its highest."""
    banded = scores.where(F.col(probability) >= min(BANDS)).groupBy(entity, item).agg(
        F.max(probability).alias("_p")
    )
    entry = F.struct(F.col(item), score_band(F.col("_p")).alias("flag"))
    return banded.groupBy(entity).agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("flags"))


def band_percentages(scores: DataFrame, item: str, probability: str, run: str) -> DataFrame:
    """(item, band, cnt, percent) over the scores of each item's latest run; scores below the lowest band
    count in the total alone."""
    newest = scores.groupBy(F.col(item).alias("_item")).agg(F.max(run).alias("_run"))
    latest = scores.join(newest, (F.col(item) == F.col("_item")) & (F.col(run) == F.col("_run")))
    counts = latest.groupBy(item, score_band(F.col(probability)).alias("band")).agg(F.count("*").alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy(item))  # a row per band
    return counts.select(item, "band", "cnt", F.round(F.col("cnt") * 100 / total, 4).alias("percent")).where("band is not null")


def band_columns(shares: DataFrame, item: str, levels: Mapping[str, str]) -> DataFrame:
    """One row per item with the percentage of each named band; a band without scores is null."""
    columns = [F.max(F.when(F.col("band") == k, F.col("percent"))).alias(n) for k, n in levels.items()]
    return shares.groupBy(item).agg(*columns)
