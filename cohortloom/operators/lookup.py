"""Looking seed keys up in mappings and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions import keys as K
from cohortloom.functions import maps, text
from cohortloom.operators.ranking import latest_per_key
from cohortloom.session import scratch_path


def match(
    seeds: DataFrame, mapping: DataFrame, key: str, canonical_key: Column | None = None, keep_unmatched: bool = True
) -> DataFrame:
    """Seeds joined to mapping rows on the canonical key; a left join keeps seeds without a match.
    The mapping has one row per key, so no seed row multiplies; Spark broadcasts the smaller side
    when its measured size is below its threshold and splits skewed seeds otherwise."""
    looked = seeds.withColumn("_key", F.col(key) if canonical_key is None else canonical_key)
    right = mapping.withColumnRenamed(key, "_key")
    return looked.join(right, "_key", "left" if keep_unmatched else "inner").drop("_key")


def latest_matches(matched: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Each id array cut to its newest entries; ``limit < 0`` keeps all."""
    for column, limit in limits.items():
        matched = matched.withColumn(column, maps.latest_ids(F.col(column), limit))
    return matched


def match_rows(seeds: DataFrame, state: DataFrame, key: str, canonical_key: Column | None = None) -> DataFrame:
    """All matches in long form: every seed row with each (id, first_seen, last_seen) of its key."""
    looked = seeds.withColumn("_key", F.col(key) if canonical_key is None else canonical_key)
    return looked.join(state.withColumnRenamed(key, "_key"), "_key").drop("_key")


def best_candidate(seeds: DataFrame, ids: str, weights: DataFrame, row: Sequence[str], weight: str = "weight") -> DataFrame:
    """Per seed row the candidate id with the greatest weight (missing = 0), ties by greater id; seeds
    without candidates stay with null, and equal seed rows all stay. ``weights``: id, weight.

    Equal seed rows (``row`` and ``ids``) have the same answer: they are counted, matched once, and
    repeated by their count."""
    counted = seeds.groupBy(*row, ids).agg(F.count("*").alias("_copies"))
    candidates = counted.select(*row, ids, "_copies", F.explode_outer(F.transform(ids, lambda s: s["id"])).alias("id"))
    scored = candidates.join(weights, "id", "left")
    best = F.max(F.when(F.col("id").isNotNull(), F.struct(F.coalesce(F.col(weight), F.lit(0)).alias("w"), "id")))
    chosen = scored.groupBy(*row, ids).agg(best.alias("b"), F.max("_copies").alias("_copies"))
    again = chosen.select(*row, "b", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))
    return again.select(*row, F.col("b.id").alias("best_id"), F.col("b.w").alias("best_weight"))


def hub_join(hub: DataFrame, results: DataFrame, key: str, order: Sequence[str], prefer: str) -> DataFrame:
    """Hub rows reduced to one per key (greatest ``order``), results joined, maps merged, empty lists
    dropped. ``prefer`` = ``left`` lets the hub row win, ``right`` the result."""
    one = latest_per_key(hub, [key], order)
    joined = one.join(results.withColumnRenamed("feature", "_result"), key, "left")
    merged = maps.merge_maps(F.col("feature"), F.col("_result"), prefer)
    return joined.withColumn("feature", maps.drop_empty_lists(merged)).drop("_result")


def attributes_for_seeds(seeds: DataFrame, attributes: DataFrame, key: str, kind: str | None = None) -> DataFrame:
    """Every seed row with the attributes of its key; the join key may be a digest of the plain one."""
    if kind is None:
        return seeds.join(attributes, key, "left")
    hashed = seeds.withColumn("_digest", K.digest(F.col(key).cast("string"), kind))
    right = attributes.withColumn("_digest", K.digest(F.col(key).cast("string"), kind)).drop(key)
    return hashed.join(right, "_digest", "left").drop("_digest")


def cleaned_name_lookup(
    df: DataFrame,
    name: str,
    dim: DataFrame,
    dim_name: str,
    suffix: str,
    exceptions: Mapping[str, str],
    code: str,
    default: str,
) -> DataFrame:
    """Name without its suffix looked up in a dimension reduced to one row per name; ``default`` when
    nothing matches."""
    rest = [c for c in dim.columns if c != dim_name]
    one = dim.where(F.length(dim_name) > 0).groupBy(F.col(dim_name).alias("_name")).agg(F.min(F.struct(*rest)).alias("_d"))
    cleaned = df.withColumn("_name", text.strip_suffix(F.col(name), suffix, dict(exceptions)))
    joined = cleaned.join(one, "_name", "left").withColumn(code, F.coalesce(F.col(f"_d.{code}"), F.lit(default)))
    return joined.drop("_name", "_d")


def digest_dictionary(keys_held: DataFrame, key: str) -> DataFrame:
    """(plain, kind, digest) of keys already held."""
    plain = F.col(key).cast("string")
    kinds = ["md5", "md5_16", "sha256"]
    cells = F.array(*[F.struct(F.lit(k).alias("kind"), K.digest(plain, k).alias("digest")) for k in kinds])
    return keys_held.select(key).distinct().select(key, F.explode(cells).alias("c")).select(key, "c.kind", "c.digest")


def translate_digest(mapping: DataFrame, column: str, dictionary: DataFrame, kind_from: str, kind_to: str, key: str) -> DataFrame:
    """Replace a digest column by another digest of the same known key; unknown digests drop."""
    source = dictionary.where(F.col("kind") == kind_from).select(key, F.col("digest").alias(column))
    target = dictionary.where(F.col("kind") == kind_to).select(key, F.col("digest").alias("_to"))
    pairs = source.join(target, key).select(column, "_to")
    return mapping.join(pairs, column).withColumn(column, F.col("_to")).drop("_to")


def prefix_members(df: DataFrame, key: str, prefixes: DataFrame, prefix: str, width: int) -> DataFrame:
    """Rows whose first ``width`` characters are in a prefix list."""
    cleaned = F.substring(F.regexp_replace(F.lower(key), "[^0-9a-z]", ""), 1, width)
    return df.withColumn(prefix, cleaned).join(prefixes, prefix, "left_semi").drop(prefix)


def prefix_dimension(df: DataFrame, key: str, dim: DataFrame, prefix: str, width: int, code: str, default: str) -> DataFrame:
    """Distinct numeric keys with the dimension row of their prefix, ``default`` code without one.
    ``dim`` has one row per prefix."""
    numeric = df.where(F.col(key).rlike("^[0-9]+$")).select(key).distinct()
    joined = numeric.withColumn(prefix, F.substring(key, 1, width)).join(dim, prefix, "left")
    return joined.withColumn(code, F.coalesce(code, F.lit(default)))


def latest_with_profile(mapping: DataFrame, key: str, profile: DataFrame, entity: str) -> DataFrame:
    """Latest id of each mapping row with its profile and ``match_flag`` 1/0."""
    newest = mapping.select(key, F.element_at(maps.latest_ids(F.col("ids"), 1), 1)["id"].alias(entity))
    known = profile.withColumn("_hit", F.lit(1))
    return newest.join(known, entity, "left").withColumn("match_flag", F.coalesce("_hit", F.lit(0))).drop("_hit")


def exploded_matches(matched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(id_type, id) of every matched id."""

    def typed(name: str) -> Column:
        return F.transform(name, lambda s: F.struct(F.lit(name).alias("id_type"), s["id"].cast("string").alias("id")))

    cells = [typed(c) for c in columns]
    empty = F.array().cast("array<struct<id_type:string,id:string>>")
    return matched.select(F.explode(F.concat(*[F.coalesce(c, empty) for c in cells])).alias("m")).select("m.*")


def match_counts(matched: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct matched ids per output type."""
    return exploded_matches(matched, columns).distinct().groupBy("id_type").agg(F.count("id").alias("match_cnt"))


def translate_map(df: DataFrame, key: str, tags: str, names: DataFrame) -> DataFrame:
    """Map keys and csv values translated by a code table (kind = key/value, code, name); unknown codes
    stay. Long-form joins instead of a driver dictionary, so the code table may be of any size."""
    pairs = df.select(key, F.explode(tags).alias("k", "v"))
    key_names = names.where("kind = 'key'").select(F.col("code").alias("k"), F.col("name").alias("_kn"))
    value_names = names.where("kind = 'value'").select(F.col("code").alias("_code"), F.col("name").alias("_vn"))
    cells = pairs.select(key, "k", F.posexplode(F.split("v", ",")).alias("_pos", "_code"))
    named = cells.join(value_names, "_code", "left").withColumn("_v", F.coalesce("_vn", "_code"))
    parts = F.sort_array(F.collect_list(F.struct("_pos", "_v")))
    csv = F.array_join(F.transform(parts, lambda p: p["_v"]), ",")
    values = named.groupBy(key, "k").agg(csv.alias("value"))
    return values.join(key_names, "k", "left").select(key, F.coalesce("_kn", "k").alias("tag"), "value")


# Lines of up to two to this power levels; more can only be a cycle.
MOST_DOUBLINGS = 24


def parent_at_level(categories: DataFrame, id_: str, parent: str, level: str, target: int) -> DataFrame:
    """(id, ancestor) at ``target`` level; ids above that level, or whose line ends below it, get null.

    Each round doubles how far a row has climbed, until no row climbs further; a line that comes
    back to itself is an error. ``categories`` has one row per id. The rounds are written tables: a
    checkpoint would keep the size that Spark guesses for a join, and square it every round.
    """
    spark = categories.sparkSession
    # A pointer that has reached its level, or whose parent is unknown, stays where it is.
    base = categories.select(F.col(id_).alias("_id"), F.col(level).alias("_level"), F.col(parent).alias("_parent"))
    known = base.select(F.col("_id").alias("_parent"), F.lit(True).alias("_known"))
    climbs = (F.col("_level") > target) & F.col("_known").isNotNull()
    steps = base.join(known, "_parent", "left").select("_id", "_level", F.when(climbs, F.col("_parent")).otherwise(F.col("_id")).alias("_to"))
    moved, rounds, levels = None, 0, base.select(F.col("_id").alias("_to"), F.col("_level").alias("_at"))
    while True:
        path = scratch_path(spark, "climb")
        steps.write.parquet(path)
        steps = spark.read.parquet(path)
        now = steps.agg(F.count_if(F.col("_to") != F.col("_id")), F.sum(F.xxhash64("_id", "_to").cast("decimal(38,0)"))).first()
        if now == moved:
            break
        moved, rounds = now, rounds + 1
        if rounds > MOST_DOUBLINGS:
            raise ValueError("the parents form a cycle")
        far = steps.select(F.col("_id").alias("_to"), F.col("_to").alias("_far"))
        steps = steps.join(far, "_to").select("_id", "_level", F.col("_far").alias("_to"))
    ends = steps.join(levels, "_to")
    stuck = ends.join(base.select(F.col("_id").alias("_to"), F.col("_parent").alias("_next")).join(known.select(F.col("_parent").alias("_next"), "_known"), "_next"), "_to")
    if not stuck.where(F.col("_at") > target).isEmpty():
        raise ValueError("the parents form a cycle")
    return ends.select(F.col("_id").alias(id_), F.when(F.col("_at") == target, F.col("_to")).alias("ancestor"))
