"""URL cleaning, root domains, tag assignment and matcher patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.functions import urls
from cohortloom.operators import web
from cohortloom.plans.registry import query

# The page URLs get the noise that the cleaning removes: blanks, quotes, a trailing star, no protocol.
RAW_SQL = """raw AS (SELECT page_id AS id, CASE page_id % 4 WHEN 0 THEN ' "' || url || '" ' WHEN 1 THEN url || '*' WHEN 2 THEN regexp_replace(url, '^https?://', '') ELSE url END AS url,
  CASE WHEN page_id % 3 = 0 THEN '' ELSE 'k' || CAST(page_id % 5 AS VARCHAR) END AS url_key FROM pages)"""
PARSED_SQL = f"""{RAW_SQL}, c AS (SELECT id, url_key, regexp_replace(regexp_replace(regexp_replace(trim(url), '"', '', 'g'), '\\*$', ''), '/$', '') AS url FROM raw),
f AS (SELECT *, regexp_extract(url, '^(https|http)') AS protocol_type, regexp_replace(url, '^https?://', '') AS body FROM c),
parsed AS (SELECT id, url_key, url, protocol_type, regexp_extract(body, '^[^/?#]*') AS host, regexp_replace(regexp_extract(body, '^[^/?#]*([^#]*)', 1), '^/\\*', '/') AS file,
  regexp_replace(regexp_extract(body, '^[^/?#]*([^?#]*)', 1), '^/\\*', '/') AS path, nullif(regexp_extract(body, '\\?([^#]*)', 1), '') AS query0 FROM f)"""
SUFFIX_SQL = "suffix AS (SELECT unnest(['com', 'org', 'example.net']) AS domain)"
ROOT_SQL = f"""{PARSED_SQL}, {SUFFIX_SQL}, l AS (SELECT *, string_split(host, '.') AS labels FROM parsed),
rooted AS (SELECT l.*, CASE WHEN d2.domain IS NOT NULL THEN CASE WHEN len(labels) > 2 THEN array_to_string(labels[-3:], '.') ELSE '' END
  WHEN d1.domain IS NOT NULL THEN array_to_string(labels[-2:], '.') ELSE host END AS root_domain, host || file AS url_regexp
  FROM l LEFT JOIN suffix d1 ON labels[-1] = d1.domain LEFT JOIN suffix d2 ON array_to_string(labels[-2:], '.') = d2.domain)"""


def _raw(t):
    number = F.col("page_id") % 4
    noisy = (
        F.when(number == 0, F.concat(F.lit(' "'), F.col("url"), F.lit('" ')))
        .when(number == 1, F.concat(F.col("url"), F.lit("*")))
        .when(number == 2, F.regexp_replace("url", "^https?://", ""))
        .otherwise(F.col("url"))
    )
    key = F.when(F.col("page_id") % 3 == 0, "").otherwise(F.concat(F.lit("k"), (F.col("page_id") % 5).cast("string")))
    return t.pages.select(F.col("page_id").alias("id"), noisy.alias("url"), key.alias("url_key"))


def _rooted(t):
    suffixes = t.spark.createDataFrame([("com",), ("org",), ("COM",), ("example.net",)], "domain string")
    return web.root_domain(web.parse_urls(_raw(t)), suffixes)


@query("url_parts", "X15", f"WITH {PARSED_SQL} SELECT id, url, protocol_type, host, file, path, query0 FROM parsed")
def url_parts(t):
    return web.parse_urls(_raw(t)).select("id", "url", "protocol_type", "host", "file", "path", "query0")


@query("root_domains", "J16", f"WITH {ROOT_SQL} SELECT id, host, root_domain, url_regexp FROM rooted")
def root_domains(t):
    return _rooted(t).select("id", "host", "root_domain", "url_regexp")


@query(
    "screen_patterns",
    "X16",
    f"""WITH {ROOT_SQL} SELECT id, root_domain || '~' || host || '~~~' || CASE WHEN protocol_type = 'https' THEN '' ELSE path END || '~1' AS pattern FROM rooted""",
)
def screen_patterns(t):
    pattern = urls.screen_pattern(F.col("root_domain"), F.col("host"), F.col("protocol_type"), F.col("path"))
    return _rooted(t).select("id", pattern.alias("pattern"))


PATTERN_SQL = f"""{ROOT_SQL}, p AS (SELECT root_domain AS tag, lower(CASE WHEN url_key = '' THEN url_regexp ELSE host || path || '|' || url_key END) AS pattern, max(id) AS id FROM rooted GROUP BY ALL)"""


@query("pattern_rows", "A39 X16", f"WITH {PATTERN_SQL} SELECT tag, pattern, id FROM p")
def pattern_rows(t):
    return web.pattern_rows(_rooted(t).withColumn("tag", F.col("root_domain")))


@query(
    "pattern_rollup",
    "A39",
    f"WITH {PATTERN_SQL} SELECT tag, string_agg(pattern, ',' ORDER BY pattern) AS pattern, max(id) AS tag_group_id FROM p GROUP BY tag",
)
def pattern_rollup(t):
    return web.pattern_rollup(_rooted(t).withColumn("tag", F.col("root_domain")))


@query(
    "tag_assignment",
    "J14 W4 W5",
    """WITH free AS (SELECT p_name || CAST(p_partkey AS VARCHAR) AS tag, row_number() OVER (ORDER BY p_partkey) AS n FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier)),
ids AS (SELECT page_id, url, dense_rank() OVER (ORDER BY page_id) AS n FROM pages) SELECT page_id, url, tag FROM ids JOIN free USING (n)""",
)
def tag_assignment(t):
    named = F.concat(F.col("p_name"), F.col("p_partkey").cast("string"))
    tags = t.part.select(named.alias("tag"), F.col("p_partkey").alias("rn"))
    taken = t.part.join(t.supplier, F.col("p_partkey") == F.col("s_suppkey")).select(named.alias("tag"))
    return web.assign_tags(t.pages.select("page_id", "url"), "page_id", tags, taken, "tag", "rn")


@query(
    "repeated_urls",
    "A46",
    """WITH n AS (SELECT page_id, regexp_replace(url, '[0-9]+.*$', '') AS url_regexp, CAST(page_id % 2 AS VARCHAR) AS url_key FROM pages),
h AS (SELECT DISTINCT url_regexp, url_key FROM n WHERE page_id % 10 = 0),
c AS (SELECT url_regexp, url_key FROM n WHERE page_id % 10 <> 0 GROUP BY ALL HAVING count(*) > 1)
SELECT DISTINCT page_id AS tag FROM n WHERE page_id % 10 <> 0 AND ((url_regexp, url_key) IN (SELECT (url_regexp, url_key) FROM h) OR (url_regexp, url_key) IN (SELECT (url_regexp, url_key) FROM c))""",
)
def repeated_urls(t):
    rows = t.pages.select(
        F.col("page_id").alias("tag"),
        F.regexp_replace("url", "[0-9]+.*$", "").alias("url_regexp"),
        (F.col("page_id") % 2).cast("string").alias("url_key"),
    )
    stored = F.col("tag") % 10 == 0
    return web.repeated_urls(rows.where(~stored), rows.where(stored))
