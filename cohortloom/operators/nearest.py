"""The nearest place of each type, where places may lie dense.

Places in cells of the distance grid with few of a type are searched where the points are: a task holds the points of a cell and the
places around it, and hands on the nearest place of each type, never the pairs. A cell with more than
``leaf`` of a type is the root of a tree of quarter cells, down to cells with few; a point descends it cell by
cell. Each child knows the box of its places and one place of them: the place gives a distance that the nearest one
cannot exceed, the box one that it cannot undercut, and children beyond the best distance known are left. So a point
beside a cell that holds a third of all places looks at a small part of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.functions import geo
from cohortloom.session import scratch_path

#: Places of one type in a cell that is not divided.
LEAF = 16_384
#: Points, and places around them, that a task searches at once. The types of a cell with more places are dealt over tasks.
POINT_ROWS = 250_000
PLACE_ROWS = 250_000
#: Points that are searched together, and distances held at once.
CHUNK_ROWS = 256
CHUNK_CELLS = 2_000_000
#: Halvings of a grid cell: places that are nearer than a millionth of its side stay together.
MOST_DEPTH = 20
#: Metres by which bounds are relaxed, for the rounding of distances.
SLACK = 0.001

_SPOT = ("lat", "lon", "poi_type")
_CELL = ("poi_type", "_row", "_column")
_PLACE = ("poi_name", "poi_lat", "poi_lon")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _best(df: DataFrame) -> DataFrame:
    best = F.max(F.struct((-F.col("distance")).alias("d"), "poi_name", "poi_lat", "poi_lon")).alias("b")
    return df.groupBy(*_SPOT).agg(best).select(*_SPOT, "b.poi_name", "b.poi_lat", "b.poi_lon", (-F.col("b.d")).alias("distance"))


def _on_sphere(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    a, o = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(a) * np.cos(o), np.cos(a) * np.sin(o), np.sin(a)], axis=1)


def nearest_pairs(spots: np.ndarray, places: np.ndarray, kinds: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (spot, place) of the nearest place of each kind and all that are as near but for the slack, ordered by spot and kind.

    Both are points of the unit sphere, measured by their chord, and ``kinds`` ascends. A chunk of spots lies within a radius
    of its middle: a place that is nearest to one of them is at most two radii further from the middle than the nearest one.
    """
    slack, out = SLACK / geo.EARTH_RADIUS_M, []
    starts = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
    lengths = np.diff(np.r_[starts, len(kinds)])
    for at in range(0, len(spots), CHUNK_ROWS):
        chunk = spots[at : at + CHUNK_ROWS]
        middle = chunk.mean(axis=0)
        radius = np.sqrt(((chunk - middle) ** 2).sum(axis=1).max())
        far = np.sqrt(((places - middle) ** 2).sum(axis=1))
        reach = np.minimum(np.minimum.reduceat(far, starts) + 2 * radius, most + radius) + slack
        near = np.flatnonzero(far <= np.repeat(reach, lengths))
        if not len(near):
            continue
        some = places[near]
        first = np.flatnonzero(np.r_[True, kinds[near][1:] != kinds[near][:-1]])
        width = np.diff(np.r_[first, len(near)])
        step = max(1, CHUNK_CELLS // len(near))
        for row in range(0, len(chunk), step):
            own = chunk[row : row + step]
            gaps = np.sqrt(sum((own[:, None, d] - some[None, :, d]) ** 2 for d in range(3)))
            best = np.minimum(np.minimum.reduceat(gaps, first, axis=1), most)
            spot, place = np.nonzero(gaps <= np.repeat(best, width, axis=1) + slack)
            out.append((spot + at + row, near[place]))
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])) if out else (empty, empty)


def _searched(max_metres: float, names: Sequence[str]):
    """Points and places of one task, as (lat, lon, poi_type, places): what may be the nearest place of the type."""
    most = 2 * math.sin(min(max_metres / (2 * geo.EARTH_RADIUS_M), math.pi / 2))

    def known(table: pa.Table, lat: str, lon: str) -> tuple[pa.Table, np.ndarray]:
        at = _on_sphere(*(np.asarray(table.column(c).cast(pa.float64())) for c in (lat, lon)))
        kept = np.flatnonzero(np.isfinite(at).all(axis=1))
        return table.take(kept), at[kept]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        left, spots = known(left, "lat", "lon")
        right, places = known(right, "poi_lat", "poi_lon")
        if left.num_rows and right.num_rows:
            kinds = np.asarray(right.column("poi_type").combine_chunks().dictionary_encode().indices)
            by_kind = np.argsort(kinds, kind="stable")
            # Points in rows of latitude, as many rows as chunks along one.
            lat, lon = (np.asarray(left.column(c).cast(pa.float64())) for c in ("lat", "lon"))
            height = (lat.max() - lat.min()) / math.sqrt(len(lat) / CHUNK_ROWS) or 1.0
            by_place = np.lexsort((lon, np.floor((lat - lat.min()) / height)))
            spot, place = nearest_pairs(spots[by_place], places[by_kind], kinds[by_kind], most)
            spot, place = by_place[spot], by_kind[place]
        else:
            spot = place = np.zeros(0, dtype=np.int64)
            kinds = np.zeros(0, dtype=np.int64)
        first = np.flatnonzero(np.r_[True, (spot[1:] != spot[:-1]) | (kinds[place][1:] != kinds[place][:-1])]) if len(spot) else spot
        own, found = left.take(spot[first]), right.take(place).select(names).combine_chunks()
        one = pa.StructArray.from_arrays([found.column(n).combine_chunks() for n in names], list(names))
        lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(place)].astype(np.int32)), one)
        return pa.table([own.column("lat"), own.column("lon"), right.column("poi_type").take(place[first]), lists], ["lat", "lon", "poi_type", "places"])

    return search


def _search(spots: DataFrame, pois: DataFrame, on: Sequence[str], max_metres: float) -> DataFrame:
    """For (lat, lon) and each type the nearest of the places with the same key ``on``, if nearer than ``max_metres``.

    A task holds the points and places of one key; a key with many points deals them over tasks, one with many
    places its types. Such keys are few: one per ``POINT_ROWS`` points or ``PLACE_ROWS`` places at most.
    """
    on = list(on)
    one = F.count(F.lit(1))
    turns = spots.groupBy(*on).agg(F.ceil(one / POINT_ROWS).cast("int").alias("_turns")).where("_turns > 1")
    lanes = pois.groupBy(*on).agg(F.ceil(one / PLACE_ROWS).cast("int").alias("_lanes")).where("_lanes > 1")
    hot = F.broadcast(turns.join(lanes, on, "full").select(*on, *[F.coalesce(c, F.lit(1)).alias(c) for c in ("_turns", "_lanes")]))

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(count, F.lit(1)) - 1))

    def one_of(count: str, *columns: str) -> Column:
        return F.pmod(F.xxhash64(*columns), F.coalesce(count, F.lit(1))).cast("int")

    left = spots.select(*on, "lat", "lon").join(hot, on, "left").withColumn("_turn", one_of("_turns", "lat", "lon")).withColumn("_lane", each("_lanes")).drop("_turns", "_lanes")
    right = pois.select(*on, *([] if "poi_type" in on else ["poi_type"]), *_PLACE).join(hot, on, "left")
    right = right.withColumn("_lane", one_of("_lanes", "poi_type")).withColumn("_turn", each("_turns")).drop("_turns", "_lanes")
    keys = [*on, "_turn", "_lane"]
    types = {f.name: f.dataType.simpleString() for f in [*spots.schema, *pois.schema]}
    fields = ", ".join(f"{c}: {types[c]}" for c in _PLACE)
    schema = f"lat {types['lat']}, lon {types['lon']}, poi_type {types['poi_type']}, places array<struct<{fields}>>"
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_searched(max_metres, _PLACE), schema)

    # Measured, rounded and compared here: mostly one place a row.
    def measured(p: Column) -> Column:
        distance = geo.haversine_m(F.col("lat"), F.col("lon"), p["poi_lat"], p["poi_lon"])
        return F.struct((-distance).alias("d"), *[p[c].alias(c) for c in _PLACE])

    best = found.select(*_SPOT, F.array_max(F.transform("places", measured)).alias("b"))
    return best.select(*_SPOT, *[f"b.{c}" for c in _PLACE], (-F.col("b.d")).alias("distance")).where(F.col("distance") < max_metres)


def _in_cells(spots: DataFrame, pois: DataFrame, max_metres: float) -> DataFrame:
    """The nearest place of each type among those in the nine cells around each point."""
    placed = spots.withColumn("_row", geo.grid_row(F.col("lat"), max_metres))
    placed = placed.withColumn("_column", geo.grid_column(F.col("lon"), geo.grid_columns(F.col("_row"), max_metres)))
    around = pois.select("poi_type", *_PLACE, F.explode(geo.neighbour_cells(F.col("poi_lat"), F.col("poi_lon"), max_metres)).alias("_c"))
    around = around.select("poi_type", *_PLACE, F.col("_c.row").alias("_row"), F.col("_c.column").alias("_column"))
    return _search(placed, around, ["_row", "_column"], max_metres)


def _normal(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def _celled(pois: DataFrame, max_metres: float) -> DataFrame:
    """Places with their grid cell and their place in it, as halvings in both directions."""
    row = geo.grid_row(F.col("poi_lat"), max_metres)
    columns = geo.grid_columns(F.col("_row"), max_metres)
    up = (F.col("poi_lat") + 90.0) / geo.grid_rows_degrees(max_metres) - F.col("_row")
    right = (_normal(F.col("poi_lon")) + 180.0) / 360.0 * columns - F.col("_column")

    def halvings(part: Column) -> Column:
        return F.least(F.greatest(F.floor(part * (1 << MOST_DEPTH)), F.lit(0)), F.lit((1 << MOST_DEPTH) - 1)).cast("int")

    celled = pois.withColumn("_row", row).withColumn("_column", geo.grid_column(F.col("poi_lon"), columns))
    return celled.withColumn("_y", halvings(up)).withColumn("_x", halvings(right))


def _at(depth: int) -> list[Column]:
    return [F.shiftright(c, MOST_DEPTH - depth).alias(c) for c in ("_y", "_x")]


def _nodes(inner: DataFrame, depth: int, leaf: int) -> DataFrame:
    """Cells of one depth: how many places, their box, one of them, and whether they are divided further."""
    lon = _normal(F.col("poi_lon"))
    one = F.max(F.struct("poi_name", "poi_lat", "poi_lon"))
    out = inner.select(*_CELL, *_at(depth), "poi_name", "poi_lat", "poi_lon").groupBy(*_CELL, "_y", "_x").agg(
        F.count(F.lit(1)).alias("_n"), F.min("poi_lat").alias("_south"), F.max("poi_lat").alias("_north"),
        F.min(lon).alias("_west"), F.max(lon).alias("_east"), one.alias("_one"),
    )
    return out.withColumn("_dense", (F.col("_n") > leaf) & F.lit(depth < MOST_DEPTH))


def _least_metres(lat: Column, lon: Column) -> Column:
    """A distance to the box that no point of it undercuts: to its parallels, or to its nearer meridian."""
    beside = F.greatest(F.col("_south") - lat, lat - F.col("_north"), F.lit(0.0))
    outside = (_normal(lon) < F.col("_west")) | (_normal(lon) > F.col("_east"))

    def to_meridian(edge: Column) -> Column:
        return F.asin(F.least(F.lit(1.0), F.abs(F.sin(F.radians(lon - edge)) * F.cos(F.radians(lat)))))

    across = F.when(outside, F.least(to_meridian(F.col("_west")), to_meridian(F.col("_east")))).otherwise(0.0)
    return F.greatest(F.radians(beside), across) * geo.EARTH_RADIUS_M - SLACK


def nearest_per_type(points: DataFrame, pois: DataFrame, max_metres: float, leaf: int = LEAF) -> DataFrame:
    """(lat, lon, poi_type, poi_name, poi_lat, poi_lon, distance): the nearest POI of each type nearer than
    ``max_metres`` for every distinct coordinate, ties by greater name.

    Equal coordinates are asked once, and POIs at one spot and of one type are reduced to the greatest name.
    """
    spots = points.select("lat", "lon").where("lat is not null and lon is not null").distinct()
    unique = pois.groupBy("poi_type", "poi_lat", "poi_lon").agg(F.max("poi_name").alias("poi_name"))
    celled = _stored(_celled(unique.where("poi_type is not null and poi_lat is not null and poi_lon is not null"), max_metres), "places")
    crowded = celled.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > leaf).select(*_CELL)
    if crowded.isEmpty():
        return _in_cells(spots, celled, max_metres)

    sparse = celled.join(crowded, list(_CELL), "left_anti").select("poi_type", *_PLACE)
    inner = _stored(celled.join(crowded, list(_CELL), "left_semi"), "crowded")
    spots = _stored(spots, "spots")
    found = [_stored(_in_cells(spots, sparse, max_metres), "found")]

    # The cells around every crowded one, and the spots in them.
    around = inner.select(*_CELL, F.explode(geo.neighbour_cells(F.col("poi_lat"), F.col("poi_lon"), max_metres)).alias("_c")).distinct()
    around = around.select(*_CELL, F.col("_c.row").alias("_own_row"), F.col("_c.column").alias("_own_column"))
    own_row = geo.grid_row(F.col("lat"), max_metres)
    placed = spots.withColumn("_own_row", own_row)
    placed = placed.withColumn("_own_column", geo.grid_column(F.col("lon"), geo.grid_columns(F.col("_own_row"), max_metres)))
    open_cells = placed.join(around, ["_own_row", "_own_column"]).select("lat", "lon", *_CELL, F.lit(0).alias("_y"), F.lit(0).alias("_x"))
    known = found[0].select(*_SPOT, F.col("distance").alias("_known"))
    open_cells = _stored(open_cells.join(known, list(_SPOT), "left").withColumn("_known", F.coalesce("_known", F.lit(float(max_metres)))), "open")

    for depth in range(1, MOST_DEPTH + 1):
        nodes = _stored(_nodes(inner, depth, leaf), "nodes")
        child = nodes.withColumn("_up", F.shiftright("_y", 1)).withColumn("_left", F.shiftright("_x", 1)).withColumnRenamed("_y", "_ny").withColumnRenamed("_x", "_nx")
        met = open_cells.withColumnRenamed("_y", "_up").withColumnRenamed("_x", "_left").join(child, [*_CELL, "_up", "_left"])
        one = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("_one.poi_lat"), F.col("_one.poi_lon"))
        met = met.withColumn("_least", _least_metres(F.col("lat"), F.col("lon"))).where(F.col("_least") <= F.col("_known"))
        bound = F.min(F.least("_known", one)).over(Window.partitionBy(*_SPOT))
        met = _stored(met.withColumn("_known", bound).where(F.col("_least") <= F.col("_known")).select("lat", "lon", *_CELL, F.col("_ny").alias("_y"), F.col("_nx").alias("_x"), "_known", "_dense"), "open")
        leaves = met.where("not _dense").select("lat", "lon", *_CELL, "_y", "_x")
        if not leaves.isEmpty():
            here = inner.select(*_CELL, *_at(depth), *_PLACE)
            found.append(_stored(_search(leaves, here, [*_CELL, "_y", "_x"], max_metres), "found"))
        open_cells = met.where("_dense").drop("_dense")
        # Divided further: the places of dense cells only.
        dense = nodes.where("_dense").select(*_CELL, "_y", "_x")
        if dense.isEmpty():
            break
        on = [inner[c] == dense[c] for c in _CELL] + [F.shiftright(inner[c], MOST_DEPTH - depth) == dense[c] for c in ("_y", "_x")]
        inner = _stored(inner.join(dense, on, "left_semi"), "crowded")

    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return _best(out)
