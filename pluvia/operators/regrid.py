"""Regridding: box and polygon overlaps, weights, and observed weighted means.  Boxes are axis-aligned in degrees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .coverage import cell_boxes, overlap_areas
from .relations import missing_ids


def weighted_mean(cells: DataFrame, weights: DataFrame, meta: list[str], x: str = "x") -> DataFrame:
    """source_id, meta…, x and (source_id, target_id, weight) -> target_id, meta…, x: the mean of the observed
    cells, weights renormalised; NULL if none is observed."""
    seen = F.col(x).isNotNull()
    num = F.sum(F.when(seen, F.col("weight") * F.col(x)).otherwise(0.0))
    den = F.sum(F.when(seen, F.col("weight")).otherwise(0.0))
    return cells.join(weights, "source_id").groupBy("target_id", *meta).agg((num / F.nullif(den, F.lit(0.0))).alias(x))


def require_sources(cells: DataFrame, weights: DataFrame) -> DataFrame:
    """``cells``; raises if a source with a weight is not among them."""
    if lost := [r[0] for r in missing_ids(weights.filter("weight > 0"), cells, "source_id").limit(5).collect()]:
        raise ValueError(f"the cells lack sources such as {lost}")
    return cells


def renormalise(weights: DataFrame, target: str = "target_id") -> DataFrame:
    return weights.withColumn("weight", F.col("weight") / F.nullif(F.sum("weight").over(Window.partitionBy(target)), F.lit(0.0)))


def check_weights(weights: DataFrame) -> DataFrame:
    """Weights that break the contract, with the reason: missing or negative, repeated pairs, targets without weight."""
    bad = weights.filter("weight IS NULL OR weight < 0 OR isnan(weight)").select("source_id", "target_id", F.lit("weight").alias("reason"))
    twice = weights.groupBy("source_id", "target_id").count().filter("count > 1").select("source_id", "target_id", F.lit("repeated").alias("reason"))
    empty = weights.groupBy("target_id").agg(F.sum("weight").alias("w")).filter("coalesce(w, 0) <= 0").select(F.lit(None).cast("string").alias("source_id"), F.col("target_id").cast("string"), F.lit("no weight").alias("reason"))
    text = lambda df: df.select(F.col("source_id").cast("string"), F.col("target_id").cast("string"), "reason")
    return text(bad).unionByName(text(twice)).unionByName(empty)


def box_weights(cells: DataFrame, units: DataFrame, half_lat: float, half_lon: float, least: float = 1e-5) -> DataFrame:
    """Share of each cell box (source_id, lat, lon as centre) that lies in each unit box (target_id, south, north,
    west, east).  Candidates meet in the grid's own rows and columns, so the join is an equi-join."""
    span = lambda low, high, step: F.explode(F.sequence(F.floor(low / step), F.floor(high / step)))
    boxes = cells.select("source_id", (F.col("lat") - half_lat).alias("s"), (F.col("lat") + half_lat).alias("n"), (F.col("lon") - half_lon).alias("w"), (F.col("lon") + half_lon).alias("e"))
    a = boxes.withColumn("_i", span(F.col("s"), F.col("n"), 2 * half_lat)).withColumn("_j", span(F.col("w"), F.col("e"), 2 * half_lon))
    b = units.withColumn("_i", span(F.col("south"), F.col("north"), 2 * half_lat)).withColumn("_j", span(F.col("west"), F.col("east"), 2 * half_lon))
    wide = lambda lo1, hi1, lo2, hi2: F.greatest(F.lit(0.0), F.least(hi1, hi2) - F.greatest(lo1, lo2))
    area = wide(F.col("s"), F.col("n"), F.col("south"), F.col("north")) * wide(F.col("w"), F.col("e"), F.col("west"), F.col("east"))
    return (
        a.join(b, ["_i", "_j"]).select("source_id", "target_id", (area / (4 * half_lat * half_lon)).alias("weight"))
        .distinct().filter(F.col("weight") > least)
    )


def missing_fraction(weights: DataFrame, units: DataFrame, cell_area: float) -> DataFrame:
    """target_id, area, missing_frac: what of a unit no cell covers (cells are disjoint, so overlaps add up)."""
    covered = weights.groupBy("target_id").agg((F.sum("weight") * cell_area).alias("covered"))
    area = (F.col("north") - F.col("south")) * (F.col("east") - F.col("west"))
    return units.join(covered, "target_id", "left").select(
        "target_id", area.alias("area"), F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.coalesce("covered", F.lit(0.0)) / area)).alias("missing_frac"))


def coverage(per_unit: DataFrame, x: str = "missing_frac", eps: float = 1e-9) -> DataFrame:
    """n_units, n_affected and quantiles of a per-unit value."""
    q = F.percentile(x, F.array(*[F.lit(v) for v in (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)]))
    return per_unit.agg(F.count(F.lit(1)).alias("n_units"), F.count_if(F.col(x) > eps).alias("n_affected"), q.alias("_q")).select(
        "n_units", "n_affected", *[F.get("_q", F.lit(i)).alias(n) for i, n in enumerate(("min", "p05", "p25", "median", "p75", "p95", "max"))])


def polygon_centroid(vertices):
    """(lat, lon) of a polygon given as an array of structs lat, lon (shoelace formula)."""
    n = F.size(vertices)
    at = lambda i: F.get(vertices, i)
    ring = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        at(i)["lat"].alias("y"), at(i)["lon"].alias("x"), at((i + 1) % n)["lat"].alias("v"), at((i + 1) % n)["lon"].alias("u")))
    cross = lambda s: s["x"] * s["v"] - s["u"] * s["y"]
    area = F.aggregate(ring, F.lit(0.0), lambda a, s: a + cross(s)) / 2
    y = F.aggregate(ring, F.lit(0.0), lambda a, s: a + (s["y"] + s["v"]) * cross(s)) / (6 * area)
    x = F.aggregate(ring, F.lit(0.0), lambda a, s: a + (s["x"] + s["u"]) * cross(s)) / (6 * area)
    return y, x


def polygon_weights(cells: DataFrame, units: DataFrame, half_lat: float, half_lon: float, least: float = 1e-5) -> DataFrame:
    """source_id, target_id, weight: share of each cell box (source_id, lat, lon as centre) within each unit.

    ``units`` has target_id and ``rings``, an array of simple rings (arrays of structs lat, lon) that do not overlap,
    as the parts of a unit; see :mod:`.coverage`.  A ring of under three points, or NULL, has no area.  Repeated cells
    are one cell."""
    areas = overlap_areas(cell_boxes(cells, half_lat, half_lon, ["source_id"]), ["source_id"], units, (4 * half_lat, 4 * half_lon))
    return areas.select("source_id", "target_id", (F.col("area") / (4 * half_lat * half_lon)).alias("weight")).filter(F.col("weight") > least)


def valid_cells(values: DataFrame, x: str = "x") -> DataFrame:
    """lat, lon of the cells with a finite value at any time."""
    finite = F.col(x).isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return values.groupBy("lat", "lon").agg(F.max(finite).alias("_ok")).filter("_ok").select("lat", "lon")


def restrict(weights: DataFrame, cells: DataFrame, valid: DataFrame, digits: int = 5) -> tuple[DataFrame, DataFrame]:
    """Weights of the valid cells only, renormalised to one a unit; and the units (target_id) that lose all of theirs.

    Cells are compared by their coordinates, rounded to ``digits``."""
    place = [F.round("lat", digits).alias("_y"), F.round("lon", digits).alias("_x")]
    good = cells.select("source_id", *place).join(valid.select(*place).distinct(), ["_y", "_x"], "left_semi").select("source_id").distinct()
    kept = weights.join(good, "source_id", "left_semi")
    return renormalise(kept), weights.select("target_id").distinct().join(kept, "target_id", "left_anti")


def cell_units(cells: DataFrame, half_lat: float, half_lon: float) -> DataFrame:
    """Each cell as a unit of its own: target_id, rings (its box)."""
    corner = lambda dy, dx: F.struct((F.col("lat") + dy).alias("lat"), (F.col("lon") + dx).alias("lon"))
    box = F.array(corner(-half_lat, -half_lon), corner(-half_lat, half_lon), corner(half_lat, half_lon), corner(half_lat, -half_lon))
    return cells.select(F.col("source_id").alias("target_id"), F.array(box).alias("rings"))
