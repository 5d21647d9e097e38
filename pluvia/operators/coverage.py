"""Areas of polygons in boxes that may overlap, and weights to a coverage footprint.

Everything meets in tiles: boxes are cut at tile borders, rings are cut into the tiles' rows first (a strip keeps the
vertices of its row only) and then meet the boxes of each tile in an equi-join, so what is shuffled grows with vertices and
pairs, not with their product.  A union of boxes is cut into disjoint ones tile by tile: the box edges make slabs, and within
a slab the boxes' extents are merged.

Boxes have south, north, west, east; boxes without area and NULL rings are ignored; a ring is a simple polygon of at least
three points (structs lat, lon), the rings of a unit do not overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .fits import in_tasks

SIDES = ["south", "north", "west", "east"]
_RING = "array<struct<lat:double,lon:double>>"


def half(ring: np.ndarray, axis: int, sign: int, bound: float) -> np.ndarray:
    """What of a ring (rows lat, lon) lies on one side of a parallel or meridian."""
    if len(ring) < 3:
        return ring[:0]
    after = np.roll(ring, -1, axis=0)
    here, there = sign * (ring[:, axis] - bound), sign * (after[:, axis] - bound)
    crosses = here * there < 0
    share = np.where(crosses, here / np.where(crosses, here - there, 1.0), 0.0)
    cut = ring + share[:, None] * (after - ring)
    # Each side gives its first end, if that stays, and then the point at which it crosses the bound.
    return np.stack([ring, cut], axis=1).reshape(-1, 2)[np.stack([here >= 0, crosses], axis=1).ravel()]


def area_inside(ring: np.ndarray, box: tuple[float, float, float, float]) -> float:
    """Area of a ring within south, north, west, east."""
    for axis, sign, bound in ((0, 1, box[0]), (0, -1, box[1]), (1, 1, box[2]), (1, -1, box[3])):
        ring = half(ring, axis, sign, bound)
    after = np.roll(ring, -1, axis=0)
    return abs(float((ring[:, 1] * after[:, 0] - after[:, 1] * ring[:, 0]).sum())) / 2


def _strips(row: dict, tile: float) -> list[dict]:
    """The ring cut into the tiles' rows."""
    rest, out = np.array([[v["lat"], v["lon"]] for v in row["ring"]], float), []
    i = int(np.floor(rest[:, 0].min() / tile))
    while len(rest) >= 3:
        part, rest = half(rest, 0, -1, (i + 1) * tile), half(rest, 0, 1, (i + 1) * tile)
        if len(part) >= 3:
            out.append({"target_id": row["target_id"], "_i": i, "ring": [{"lat": a, "lon": b} for a, b in part.tolist()]})
        i += 1
    return out


def tiles(boxes: DataFrame, size: tuple[float, float]) -> DataFrame:
    """The boxes cut at tile borders, with the tile's row and column _i, _j."""
    span = lambda lo, hi, step: F.explode(F.sequence(F.floor(F.col(lo) / step), F.greatest(F.floor(F.col(lo) / step), F.ceil(F.col(hi) / step) - 1)))
    full = boxes.filter("south < north AND west < east").withColumn("_i", span("south", "north", size[0])).withColumn("_j", span("west", "east", size[1]))
    cut = full.withColumns({
        "south": F.greatest("south", F.col("_i") * size[0]), "north": F.least("north", (F.col("_i") + 1) * size[0]),
        "west": F.greatest("west", F.col("_j") * size[1]), "east": F.least("east", (F.col("_j") + 1) * size[1])})
    return cut.filter("south < north AND west < east")


def overlap_areas(boxes: DataFrame, keys: list[str], units: DataFrame, size: tuple[float, float]) -> DataFrame:
    """keys, target_id, area: what of each unit (target_id, rings) lies in each box (keys, sides), in square degrees."""
    rings = units.select("target_id", F.explode("rings").alias("ring")).filter(F.size("ring") > 2)
    kind = dict(units.dtypes)["target_id"]
    strips = in_tasks(rings, f"target_id {kind}, _i bigint, ring {_RING}", lambda row: _strips(row, size[0]))
    lon = lambda f: F.floor(f(F.transform("ring", lambda v: v["lon"])) / size[1])
    placed = strips.withColumn("_j", F.explode(F.sequence(lon(F.array_min), lon(F.array_max))))

    @F.pandas_udf("double")
    def area(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for lats, lons, *sides in batches:
            each = zip(lats, lons, *sides, strict=True)
            yield pd.Series([area_inside(np.column_stack([p, q]), box) for p, q, *box in each], dtype=float)

    points = lambda of: F.transform("ring", lambda v: v[of])
    within = tiles(boxes.select(*keys, *SIDES), size).join(placed, ["_i", "_j"]).select(*keys, "target_id", area(points("lat"), points("lon"), *SIDES).alias("area"))
    return within.groupBy(*keys, "target_id").agg(F.sum("area").alias("area")).filter("area > 0")


def disjoint_boxes(boxes: DataFrame, size: tuple[float, float]) -> DataFrame:
    """Boxes without overlap that cover what ``boxes`` cover."""
    cut = tiles(boxes.select(*SIDES).distinct(), size)
    tile = ["_i", "_j"]
    edges = cut.select(*tile, F.explode(F.array("south", "north")).alias("lo")).distinct()
    slabs = edges.withColumn("hi", F.lead("lo").over(Window.partitionBy(*tile).orderBy("lo"))).filter("hi IS NOT NULL")
    slab = [*tile, "lo", "hi"]
    spans = cut.join(slabs, tile).filter("south <= lo AND hi <= north").select(*slab, "west", "east")
    order = Window.partitionBy(*slab).orderBy("west", "east")
    far = F.max("east").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = spans.withColumn("_new", (far.isNull() | (F.col("west") > far)).cast("int"))
    islands = begins.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = islands.groupBy(*slab, "_island").agg(F.min("west").alias("west"), F.max("east").alias("east"))
    return merged.select(F.col("lo").alias("south"), F.col("hi").alias("north"), "west", "east")


def cell_boxes(cells: DataFrame, half_lat: float, half_lon: float, keys: list[str] = ()) -> DataFrame:
    """Boxes around cell centres (keys, lat, lon); repeated cells are one."""
    side = lambda c, d: (F.col(c) + d)
    return cells.select(*keys, "lat", "lon").distinct().select(
        *keys, side("lat", -half_lat).alias("south"), side("lat", half_lat).alias("north"), side("lon", -half_lon).alias("west"), side("lon", half_lon).alias("east"))


def shared_boxes(left: DataFrame, right: DataFrame, keys: list[str], size: tuple[float, float]) -> DataFrame:
    """keys of ``left`` and the boxes that it has in common with the boxes of ``right``."""
    other = tiles(right.select(*SIDES), size).select("_i", "_j", *[F.col(s).alias(f"_{s}") for s in SIDES])
    met = tiles(left.select(*keys, *SIDES), size).join(other, ["_i", "_j"])
    inner = {"south": F.greatest, "north": F.least, "west": F.greatest, "east": F.least}
    return met.select(*keys, *[f(F.col(s), F.col(f"_{s}")).alias(s) for s, f in inner.items()]).filter("south < north AND west < east")


def weights_to_coverage(
    cells: DataFrame, half_lat: float, half_lon: float, units: DataFrame, covered: DataFrame, size: tuple[float, float] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """source_id, target_id, weight of a grid's cells (source_id, lat, lon) by their share of each unit's part within the
    boxes ``covered``, which may overlap; one in sum a unit.  And the units (target_id) of which nothing is covered."""
    size = size or (16 * half_lat, 16 * half_lon)
    pieces = shared_boxes(cell_boxes(cells, half_lat, half_lon, ["source_id"]), disjoint_boxes(covered, size), ["source_id"], size)
    areas = overlap_areas(pieces, ["source_id"], units, size)
    weights = areas.select("source_id", "target_id", (F.col("area") / F.sum("area").over(Window.partitionBy("target_id"))).alias("weight"))
    return weights, units.select("target_id").distinct().join(areas, "target_id", "left_anti")


def ring_area(ring: Column) -> Column:
    """Area of a ring by the shoelace formula."""
    at = lambda i: F.get(ring, i % F.size(ring))
    cross = lambda i: at(i)["lon"] * at(i + 1)["lat"] - at(i + 1)["lon"] * at(i)["lat"]
    return F.abs(F.aggregate(F.sequence(F.lit(0), F.size(ring) - 1), F.lit(0.0), lambda s, i: s + cross(i))) / 2


def uncovered(units: DataFrame, covered: DataFrame, size: tuple[float, float]) -> DataFrame:
    """target_id, area, missing_frac: the share of each unit outside of the boxes ``covered``, which may overlap; NULL
    without area."""
    inside = overlap_areas(disjoint_boxes(covered, size), [], units, size)
    whole = units.select("target_id", F.aggregate(F.filter(F.coalesce("rings", F.array().cast(f"array<{_RING}>")), lambda r: F.size(r) > 2), F.lit(0.0), lambda s, r: s + ring_area(r)).alias("area"))
    share = 1 - F.coalesce("_inside", F.lit(0.0)) / F.nullif(F.col("area"), F.lit(0.0))
    out = whole.join(inside.withColumnRenamed("area", "_inside"), "target_id", "left")
    return out.select("target_id", "area", F.when(share.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), share))).alias("missing_frac"))
