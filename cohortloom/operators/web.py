"""URL rows: cleaning, root domains, tag assignment and matcher patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import urls
from cohortloom.operators import ranking


def parse_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """Cleaned ``url`` with protocol_type, host, file, path, query0."""
    cleaned = df.withColumn(url, urls.clean_url(F.col(url)))
    parts = urls.url_parts(F.col(url))
    return cleaned.withColumns(
        {
            "protocol_type": urls.protocol(F.col(url)),
            "host": parts["host"],
            "file": parts["file"],
            "path": parts["path"],
            "query0": parts["query"],
        }
    )


def root_domain(df: DataFrame, suffixes: DataFrame, host: str = "host") -> DataFrame:
    """``root_domain`` and ``url_regexp`` of parsed rows. A public suffix of two labels wins over one of one
    label; without either the host itself. ``suffixes``: domain."""
    dim = suffixes.select(F.lower("domain").alias("_suffix")).distinct()
    one = F.substring_index(host, ".", -1)
    two = F.substring_index(host, ".", -2)
    labels = F.size(F.split(host, r"\."))
    three = F.when(labels > 2, F.substring_index(host, ".", -3)).otherwise("")
    hit1 = dim.select(F.col("_suffix").alias("_s1"), F.lit(True).alias("_h1"))
    hit2 = dim.select(F.col("_suffix").alias("_s2"), F.lit(True).alias("_h2"))
    joined = (
        df.withColumn("_s1", one)
        .withColumn("_s2", two)
        .join(hit1, "_s1", "left")
        .join(hit2, "_s2", "left")
    )
    root = F.when(F.col("_h2"), three).when(F.col("_h1"), two).otherwise(F.col(host))
    return (
        joined.withColumn("root_domain", root)
        .withColumn("url_regexp", F.concat(F.col(host), F.coalesce("file", F.lit(""))))
        .drop("_s1", "_s2", "_h1", "_h2")
    )


def assign_tags(rows: DataFrame, id_: str, tags: DataFrame, used: DataFrame, tag: str, order: str) -> DataFrame:
    """The n-th distinct id takes the n-th unused tag (``order`` ascending). Numbering is distributed, not
    a single-task window."""
    free = tags.join(used.select(tag).distinct(), tag, "left_anti").select(tag, order)
    free = ranking.global_index(free, [order, tag], "_n").select(tag, "_n")
    ids = ranking.global_index(rows.select(id_).distinct(), [id_], "_n")
    return rows.join(ids.join(free, "_n").drop("_n"), id_)


def pattern_rows(tagged: DataFrame) -> DataFrame:
    """Distinct (tag, pattern) with the greatest id."""
    pattern = urls.matcher_pattern(F.col("url_regexp"), F.col("host"), F.coalesce("path", F.lit("")), F.col("url_key"))
    return tagged.groupBy("tag", F.lower(pattern).alias("pattern")).agg(F.max("id").alias("id"))


def pattern_rollup(tagged: DataFrame) -> DataFrame:
    """Per tag its distinct patterns as one sorted csv text, and the greatest id. Rows are reduced to
    distinct patterns before the text is built; :func:`pattern_rows` is the form to store."""
    return pattern_rows(tagged).groupBy("tag").agg(
        F.array_join(F.sort_array(F.collect_list("pattern")), ",").alias("pattern"), F.max("id").alias("tag_group_id")
    )


def repeated_urls(rows: DataFrame, history: DataFrame, tag: str = "tag") -> DataFrame:
    """Tags whose (url_regexp, url_key) occurs twice in the input or already in the history."""
    keys = ["url_regexp", "url_key"]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    known = history.select(*keys).distinct().withColumn("_n", F.lit(2).cast("long"))
    repeated = counts.unionByName(known).groupBy(*keys).agg(F.max("_n").alias("_n")).where("_n > 1")
    return rows.join(repeated, keys, "left_semi").select(tag).distinct()
