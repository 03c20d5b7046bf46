"""The k places nearest to each point, through a tree of cells that is as deep as places are dense.

The unit sphere lies in a cube that is halved in every direction, level by level, and places are counted per cell of
every level. A point starts at the deepest cell around it that holds k places: they are at most that cell's
diagonal away, so the cells twice as wide next to it hold the answer. Of these, cells that lie farther away than
the k nearest can, judged by the counts and the corners of the others, are dropped; cells with many places are replaced
by smaller ones, and judged again, until all that are left hold few. Only their places are measured.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from larder.functions.geo import haversine_km
from larder.operators.ranking import top_per_key
from larder.session import materialize

#: Cells of the deepest level are some twelve metres wide.
LEVELS = 20
_AXES = ("_x", "_y", "_z")
#: A cell with many places is replaced by cells so many levels deeper at most.
_DEEPER = 3
#: Relative and absolute allowance (in Earth radii) for rounding when distances are compared with those of corners.
_SLACK = (1 + 1e-9, 1e-12)


def most_places(k: int) -> int:
    """Cells with more places than this are split."""
    return max(32, 4 * k)


def _on_sphere(lat: Column, lon: Column) -> dict[str, Column]:
    """Coordinates on the unit sphere: near places are near in all three, across poles and date line too."""
    a, o = F.radians(lat), F.radians(lon)
    return {"_x": F.cos(a) * F.cos(o), "_y": F.cos(a) * F.sin(o), "_z": F.sin(a)}


def _with_cells(df: DataFrame) -> DataFrame:
    """Adds the numbers of the deepest cell along each axis (``_cx``, ``_cy``, ``_cz``)."""
    last = (1 << LEVELS) - 1
    return df.withColumns({f"_c{c[1]}": F.least(F.floor((F.col(c) + 1) * (1 << LEVELS - 1)), F.lit(last)).cast("long") for c in _AXES})


def _shifted(level: Column, steps: tuple[Column, ...] | None = None) -> list[Column]:
    """Cell numbers at a level, moved by so many cells along each axis."""
    own = [F.call_function("shiftright", F.col(f"_c{c[1]}"), (F.lit(LEVELS) - level).cast("int")) for c in _AXES]
    return [n + s for n, s in zip(own, steps)] if steps else own


def _packed(numbers: list[Column]) -> Column:
    return reduce(lambda code, n: code * (1 << LEVELS) + n, numbers)


def _unpacked(cell: Column) -> list[Column]:
    return [F.shiftright(cell, 2 * LEVELS), F.shiftright(cell, LEVELS) % (1 << LEVELS), cell % (1 << LEVELS)]


def _judged(frontier: DataFrame, k: int) -> DataFrame:
    """The cells of each point that may hold one of its k nearest, by the distances of their nearest and farthest corners."""
    size = F.lit(2.0) / F.pow(F.lit(2.0), F.col("level"))
    near, far = F.lit(0.0), F.lit(0.0)
    for axis, n in zip(_AXES, _unpacked(F.col("cell"))):
        low = n * size - 1
        below, above = low - F.col(axis), F.col(axis) - low - size
        near += F.pow(F.greatest(below, above, F.lit(0.0)), 2)
        far += F.pow(F.greatest(F.abs(below), F.abs(above)), 2)
    spot = Window.partitionBy("_lat", "_lon")
    within = F.sum("n").over(spot.orderBy("_far", "level", "cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = frontier.withColumns({"_near": F.sqrt(near), "_far": F.sqrt(far)}).withColumn("_within", within)
    enough = F.min(F.when(F.col("_within") >= k, F.col("_far"))).over(spot)
    kept = known.withColumn("_enough", enough).where(F.col("_enough").isNull() | (F.col("_near") <= F.col("_enough") * _SLACK[0] + _SLACK[1]))
    return kept.drop("_near", "_far", "_within", "_enough")


def cells_to_search(known: DataFrame, spots: DataFrame, k: int) -> DataFrame:
    """``level``, ``cell`` and its number of places ``n`` for every spot; all its k nearest places lie in these cells."""
    level = F.col("level")
    counted = known.select(*[f"_c{c[1]}" for c in _AXES], F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level"))
    counts = materialize(counted.groupBy(level, _packed(_shifted(level)).alias("cell")).agg(F.count("*").alias("n")), "cells")

    full = counts.where(F.col("n") >= k).drop("n")
    around = spots.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(LEVELS)))).withColumn("cell", _packed(_shifted(level)))
    deepest = around.join(full, ["level", "cell"]).groupBy("_lat", "_lon").agg(F.max("level").alias("level"))
    start = spots.join(deepest, ["_lat", "_lon"], "left").withColumn("level", F.greatest(F.coalesce("level", F.lit(0)) - 1, F.lit(0)))
    for axis in _AXES:
        start = start.withColumn(f"_d{axis[1]}", F.explode(F.array(*map(F.lit, (-1, 0, 1)))))
    numbers = _shifted(level, tuple(F.col(f"_d{axis[1]}") for axis in _AXES))
    edge = F.call_function("shiftleft", F.lit(1), level)
    inside = reduce(lambda a, b: a & b, [(n >= 0) & (n < edge) for n in numbers])
    start = start.where(inside).withColumn("cell", _packed(numbers))
    frontier = start.select("_lat", "_lon", *_AXES, "level", "cell").join(counts, ["level", "cell"])

    jump = F.explode(F.sequence(F.lit(1), F.lit(_DEEPER))).alias("jump")
    children = counts.select("*", jump).where(level >= F.col("jump")).select(
        (level - F.col("jump")).alias("level"), _packed([F.call_function("shiftright", n, F.col("jump")) for n in _unpacked(F.col("cell"))]).alias("cell"),
        "jump", F.col("cell").alias("child"), F.col("n").alias("n_child"))
    many = (F.col("n") > most_places(k)) & (level < LEVELS)
    # On a surface a cell has four children that hold places.
    wanted = F.ceil(F.log(4.0, F.col("n") / most_places(k)))
    while True:
        frontier = materialize(_judged(frontier, k), "frontier")
        split = frontier.where(many)
        if split.isEmpty():
            return frontier
        split = split.withColumn("jump", F.least(wanted, F.lit(_DEEPER), F.lit(LEVELS) - level).cast("int")).drop("n")
        parts = split.join(children, ["level", "cell", "jump"]).select(
            "_lat", "_lon", *_AXES, (level + F.col("jump")).alias("level"), F.col("child").alias("cell"), F.col("n_child").alias("n"))
        frontier = frontier.where(~many).select(*parts.columns).unionByName(parts)


def nearest(
    places: DataFrame, points: DataFrame, k: int, place_key: str, lat: str = "latitude", lon: str = "longitude",
) -> DataFrame:
    """The k places closest to each point (``point_id``, ``lat``, ``lon``), nearest first, ties by place key.

    Points with the same coordinates are looked up once, and of places with the same coordinates no more than k are
    compared, which is all that can be among the nearest. A point meets the places of a few cells with at most
    ``most_places`` each, however dense places are; more only where they lie within metres of each other. The number of
    rounds grows with the jumps in density around a point, not with the tables. Places and points without
    coordinates are left out.
    """
    here = [F.col(c).cast("double") for c in (lat, lon)]
    located = places.where(here[0].isNotNull() & here[1].isNotNull()).withColumns({"_plat": here[0], "_plon": here[1]})
    located = top_per_key(located, ["_plat", "_plon"], [F.col(place_key)], k)
    known = materialize(_with_cells(located.withColumns(_on_sphere(F.col("_plat"), F.col("_plon")))), "places")
    asked = points.where("lat is not null and lon is not null").select(
        "point_id", F.col("lat").cast("double").alias("_lat"), F.col("lon").cast("double").alias("_lon"))
    spots = asked.select("_lat", "_lon").distinct()
    spots = materialize(_with_cells(spots.withColumns(_on_sphere(F.col("_lat"), F.col("_lon")))), "points")
    searched = cells_to_search(known, spots, k).select("_lat", "_lon", "level", "cell")
    levels = [r.level for r in searched.select("level").distinct().collect()]  # at most 21 numbers
    level = F.col("level")
    keyed = known.withColumn("level", F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")))
    keyed = keyed.withColumn("cell", _packed(_shifted(level))).drop(*_AXES, *[f"_c{c[1]}" for c in _AXES])
    # Both sides of a place's cell: few places, so a cell with many points can be split between tasks.
    found = searched.join(keyed, ["level", "cell"]).drop("level", "cell").withColumn(
        "distance_km", haversine_km(F.col("_lat"), F.col("_lon"), F.col("_plat"), F.col("_plon")))
    best = top_per_key(found.drop("_plat", "_plon"), ["_lat", "_lon"], [F.col("distance_km"), F.col(place_key)], k)
    return asked.join(best, ["_lat", "_lon"]).drop("_lat", "_lon")
