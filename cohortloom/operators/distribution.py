"""Label distributions, penetration, population index, calibration and portrait counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import ranking
from cohortloom.operators.filters import drop_junk_shares
from cohortloom.session import cut_lineage


def label_pairs(df: DataFrame, key: str, labels: Sequence[str], tags: str = "tags") -> DataFrame:
    """(key, label, value): every requested label once per csv value, ``-1``, blank and missing
    values as ``unknown``. Values of one entity and label are distinct."""
    return _label_cells(df, key, [F.lit(name) for name in labels], tags)


def _label_cells(df: DataFrame, key: str, labels: Sequence[Column], tags: str) -> DataFrame:
    wanted = [F.struct(n.alias("label"), F.try_element_at(F.col(tags), n).alias("csv")) for n in labels]
    csv = F.col("p.csv")
    value = F.when(csv.isNull() | F.trim(csv).isin("", "-1"), "unknown").otherwise(csv)
    return df.select(key, F.explode(F.array(*wanted)).alias("p")).select(
        key, F.col("p.label").alias("label"), F.explode(F.array_distinct(F.split(value, ","))).alias("value")
    )


def label_distribution(df: DataFrame, key: str, labels: Sequence[str], tags: str = "tags") -> DataFrame:
    """cnt and share of entities per (label, value). ``df`` has one row per entity. The denominator
    is entities, so a multi-valued label may add up to more than 1.

    A null label rides along and counts the entities themselves, so the input is read once: the
    scalar total and the rows share one shuffle of counts. The final test mentions ``cnt`` to stay
    above the aggregate; pushed below, it would split the plan in two.
    """
    cells = _label_cells(df, key, [*[F.lit(n) for n in labels], F.lit(None).cast("string")], tags)
    counts = cells.groupBy("label", "value").agg(F.count("*").alias("cnt"))
    total = counts.agg(F.sum(F.when(F.col("label").isNull(), F.col("cnt")))).scalar()
    shares = counts.withColumn("percent", F.round(F.col("cnt") / total, 4).cast("decimal(5,4)"))
    return shares.where(F.when(F.col("label").isNotNull(), F.col("cnt")) > 0)


def distinct_entities(df: DataFrame, groups: Sequence[str], key: str, name: str = "cnt") -> DataFrame:
    """Distinct entities per group: (group, key) pairs are reduced before they are counted, so a
    hot group spreads over its keys."""
    return df.select(*groups, key).distinct().groupBy(*groups).agg(F.count(key).alias(name))


def penetration(df: DataFrame, item: str, key: str) -> DataFrame:
    """Distinct entities per item over all distinct entities."""
    pairs = df.select(item, key).distinct()
    total = df.select(key).distinct().agg(F.count(key)).scalar()
    return pairs.groupBy(item).agg(F.count(key).alias("cnt")).withColumn("penetration", F.col("cnt") / total)


def population_index(population: DataFrame, seeds: DataFrame, item: str, key: str) -> DataFrame:
    """TGI of the items of the population's entities among ``seeds`` (column ``key``): sample penetration over
    population penetration x 100. The population is reduced once to distinct (item, key) with a sample
    mark; both counts and both totals come from that."""
    chosen = seeds.select(key).distinct().withColumn("_in", F.lit(True))
    pairs = cut_lineage(population.select(item, key).distinct().join(chosen, key, "left"))
    entities = pairs.select(key, "_in").distinct().agg(F.count(key).alias("everyone"), F.count(F.when(F.col(key).isNotNull(), F.col("_in"))).alias("sample")).first()
    counts = pairs.groupBy(item).agg(F.count(key).alias("_population"), F.count("_in").alias("cnt")).where("cnt > 0")
    shares = counts.select(
        item, "cnt", (F.col("cnt") / F.lit(entities["sample"])).alias("penetration"), (F.col("_population") / F.lit(entities["everyone"])).alias("population_share")
    )
    return shares.withColumn("tgi", F.col("penetration") / F.col("population_share") * 100)


def index_against(shares: DataFrame, base: DataFrame, item: str) -> DataFrame:
    """TGI against a given ``population_share`` per item; items without a share drop out."""
    return shares.join(base.where(F.col("population_share") > 0), item).withColumn(
        "tgi", F.col("penetration") / F.col("population_share") * 100
    )


def stacked_metrics(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two metric sets side by side, zero where a key is missing: one shuffle by union + max."""
    metrics = [c for c in (*left.columns, *right.columns) if c not in keys]
    both = left.unionByName(right, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.coalesce(F.max(m), F.lit(0)).alias(m) for m in metrics])


def attribute_counts(df: DataFrame, groups: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """(group, label, value, cnt) of all attributes in one pass: unpivot, then one partial aggregate."""
    ids = [F.col(g) for g in groups]
    long = df.select(*ids, *[F.col(a).cast("string").alias(a) for a in attributes]).unpivot(
        ids, [F.col(a) for a in attributes], "label", "value"
    )
    return long.groupBy(*groups, "label", "value").agg(F.count("*").alias("cnt"))


def with_totals(df: DataFrame, within: Sequence[str], totals: Mapping[str, str]) -> DataFrame:
    """Sums over the group as columns (new name -> measure). Totals are aggregated and joined back
    (null-safe) rather than windowed, so a label with very many values never meets in one task.
    ``df`` is read twice: pass a stored or checkpointed frame of counts, not the raw rows."""
    sums = [F.sum(measure).alias(name) for name, measure in totals.items()]
    if not within:
        for name, measure in totals.items():
            df = df.withColumn(name, df.agg(F.sum(measure)).scalar())
        return df
    grouped = df.groupBy(*[F.col(c).alias(f"_t_{c}") for c in within]).agg(*sums)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in within])
    return df.join(grouped, same).drop(*[f"_t_{c}" for c in within])


def with_share(df: DataFrame, within: Sequence[str], measure: str, name: str = "share") -> DataFrame:
    """``measure`` over its sum in the group; reads ``df`` as :func:`with_totals` does."""
    summed = with_totals(df, within, {"_total": measure})
    return summed.withColumn(name, F.col(measure) / F.col("_total")).drop("_total")


def attribute_shares(df: DataFrame, groups: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Counts of :func:`attribute_counts` with their share inside (groups, label). The counts are
    checkpointed, so the rows are scanned once."""
    return with_share(cut_lineage(attribute_counts(df, groups, attributes)), [*groups, "label"], "cnt")


def calibrate(
    observed: DataFrame, ratios: DataFrame, totals: DataFrame, groups: Sequence[str]
) -> DataFrame:
    """Expected counts in a population b that was not observed.

    ``observed``: groups, label, value, cnt, share. ``ratios``: label, value, ratio_a, ratio_b.
    ``totals``: groups, total_b. index = share / ratio_a * ratio_b; weight = index / sum(index);
    cnt_b = weight * total_b; final = (cnt + cnt_b) / (sum cnt + sum cnt_b).
    """
    indexed = (
        observed.join(ratios, ["label", "value"])
        .join(totals, list(groups))
        .withColumn("index", F.col("share") / F.col("ratio_a") * F.col("ratio_b"))
    )
    # The weights of a label add up to 1, hence sum(cnt_b) = total_b.
    summed = with_totals(indexed, [*groups, "label"], {"_index": "index", "_cnt": "cnt"})
    return (
        summed.withColumn("weight", F.col("index") / F.col("_index"))
        .withColumn("cnt_b", F.col("weight") * F.col("total_b"))
        .withColumn("final_share", (F.col("cnt") + F.col("cnt_b")) / (F.col("_cnt") + F.col("total_b")))
        .drop("_index", "_cnt")
    )


def counter_stack(df: DataFrame, groups: Sequence[str], counters: Mapping[str, Column]) -> DataFrame:
    """Several distinct counts per group at once. Pairs (counter, value) are made distinct first and
    counted after, so a hot group spreads over its values; null values are not counted."""
    cells = [F.struct(F.lit(n).alias("n"), v.cast("string").alias("v")) for n, v in counters.items()]
    pairs = df.select(*groups, F.explode(F.array(*cells)).alias("c")).where("c.v is not null").distinct()
    return pairs.groupBy(*groups).agg(*[F.count_if(F.col("c.n") == n).alias(n) for n in counters])


def renormalise(df: DataFrame, groups: Sequence[str], value: str = "value", share: str = "share") -> DataFrame:
    """Junk labels dropped, then share over the sum of shares per label as decimal(21,19)."""
    kept = drop_junk_shares(df, value, share)
    shared = with_share(kept, [*groups, "label"], share, "final_share")
    return shared.withColumn("final_share", F.col("final_share").cast("decimal(21,19)"))


def multi_value_share(df: DataFrame, key: str, column: str, separator: str = ",") -> DataFrame:
    """Share of entities holding each value of a csv column; not renormalised."""
    total = df.select(key).distinct().agg(F.count(key)).scalar()
    values = df.select(key, F.explode(F.split(F.col(column), separator)).alias("value")).distinct()
    return values.groupBy("value").agg(F.count(key).alias("cnt")).withColumn("share", F.col("cnt") / total)


def value_count_maps(df: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One ``map<value, count>`` column per input column. Counting comes first, so the collected
    list holds one entry per distinct value: meant for coded columns."""
    counts = attribute_counts(df, groups, columns).where("value is not null")
    entries = [
        F.map_from_entries(
            F.sort_array(F.collect_list(F.when(F.col("label") == c, F.struct("value", "cnt"))))
        ).alias(c)
        for c in columns
    ]
    return counts.groupBy(*groups).agg(*entries)


def map_text(mapping: Column, pair: str = ",", kv: str = ":") -> Column:
    """``k:v,k:v`` in key order."""
    entries = F.sort_array(F.map_entries(mapping))
    return F.array_join(
        F.transform(entries, lambda e: F.concat_ws(kv, e["key"].cast("string"), e["value"].cast("string"))), pair
    )


def value_index(
    counts: DataFrame, segment: str, label: str, value: str, cnt: str, values: DataFrame
) -> DataFrame:
    """TGI per (segment, label, value): share inside the segment over share in total x 100, zero for
    listed (label, value) pairs a segment lacks."""
    counts = cut_lineage(counts)
    by_label = counts.groupBy(F.col(label).alias("_l")).agg(F.sum(cnt).alias("_label"))
    by_value = counts.groupBy(F.col(label).alias("_vl"), F.col(value).alias("_v")).agg(F.sum(cnt).alias("_value"))
    totals = (
        with_totals(counts, [segment, label], {"_segment": cnt})
        .join(by_label, F.col(label) == F.col("_l"))
        .join(by_value, (F.col(label) == F.col("_vl")) & F.col(value).eqNullSafe(F.col("_v")))
    )
    tgi = F.col(cnt) / F.col("_segment") / (F.col("_value") / F.col("_label")) * 100
    scored = totals.select(segment, label, value, tgi.alias("tgi"))
    # Every segment x the listed values of its labels: a join on the label, not a cross join.
    grid = counts.select(segment, label).distinct().join(values.select(label, value).distinct(), label)
    return grid.join(scored, [segment, label, value], "left").withColumn("tgi", F.coalesce("tgi", F.lit(0.0)))


def top_values_text(counts: DataFrame, groups: Sequence[str], value: str, cnt: str, k: int = 30) -> DataFrame:
    """The ``k`` most frequent values per group as ``value:cnt`` text, ties by value."""
    top = ranking.top_k_per_group(counts, groups, [F.desc(cnt), F.asc(value)], k)
    parts = F.sort_array(F.collect_list(F.struct("rn", value, cnt)))
    text = F.array_join(F.transform(parts, lambda p: F.concat_ws(":", p[value], p[cnt].cast("string"))), ",")
    return top.groupBy(*groups).agg(text.alias("top_values"))


def portrait_merge(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Sparse metric frames merged by ``max`` per key."""
    from cohortloom.operators.sets import padded_union

    both = padded_union(*parts)
    metrics = [c for c in both.columns if c not in keys]
    return both.groupBy(*keys).agg(*[F.max(m).alias(m) for m in metrics])


def fill_counts(df: DataFrame, labels: Sequence[str], tags: str = "tags") -> DataFrame:
    """Entities with a non-blank, non ``-1`` value per requested label."""
    cells = [
        F.struct(F.lit(n).alias("label"), F.try_element_at(F.col(tags), F.lit(n)).alias("v")) for n in labels
    ]
    filled = F.coalesce((F.trim("c.v") != "") & (F.col("c.v") != "-1"), F.lit(False))
    return (
        df.select(F.explode(F.array(*cells)).alias("c"))
        .groupBy("c.label")
        .agg(F.count_if(filled).alias("filled"), F.count("*").alias("entities"))
    )


def enrich_list(df: DataFrame, key: str, column: str, dim: DataFrame, item: str, info: DataFrame) -> DataFrame:
    """Explode a csv list and add category and info; both sides reduced to one row per item by max."""
    items = df.select(key, F.explode(F.split(F.col(column), ",")).alias(item))
    for side in (dim, info):
        rest = [c for c in side.columns if c != item]
        # One struct, so that all columns come from the same row.
        one = side.groupBy(item).agg(F.max(F.struct(*rest)).alias("_r")).select(item, "_r.*")
        items = items.join(one, item, "left")
    return items


def expand_categories(df: DataFrame, key: str, column: str, parents: DataFrame) -> DataFrame:
    """For each id of a csv list the id itself and both category ids, sorted distinct csv.
    ``parents``: id, category_1, category_2."""
    ids = df.select(key, F.explode(F.split(F.col(column), ",")).alias("id"))
    joined = ids.join(parents, "id", "left")
    expanded = joined.select(key, F.explode(F.array("id", "category_1", "category_2")).alias("v"))
    distinct = expanded.where("v is not null").distinct()
    return distinct.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("v")), ",").alias("ids"))


def normalise_region(column: Column, domestic: Sequence[str], foreign: str = "foreign") -> Column:
    """Blank to ``unknown``, anything outside the domestic list to ``foreign``."""
    return (
        F.when(column.isNull() | (F.trim(column) == ""), "unknown")
        .when(column.isin(list(domestic)), column)
        .otherwise(foreign)
    )
