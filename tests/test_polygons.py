import math

import numpy as np
from pyspark.sql import functions as F

from pluvia.operators import regrid as G

RINGS = "target_id int, rings array<array<struct<lat:double,lon:double>>>"


def grid(spark, n=8):
    return spark.createDataFrame([(i * n + j, i + 0.5, j + 0.5) for i in range(n) for j in range(n)], "source_id int, lat double, lon double")


def inside(ring, y, x):
    """Even-odd rule for arrays of points."""
    hit = np.zeros(len(y), bool)
    for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1], strict=True):
        with np.errstate(divide="ignore", invalid="ignore"):
            hit ^= ((a > y) != (c > y)) & (x < (d - b) * (y - a) / (c - a) + b)
    return hit


def test_polygons_equal_counted_points(spark):
    star = [(4 + (3.3 if k % 2 else 1.2) * math.cos(k * math.pi / 5), 4 + (3.3 if k % 2 else 1.2) * math.sin(k * math.pi / 5)) for k in range(10)]
    hook = [(0.2, 0.3), (0.2, 5.7), (2.9, 5.7), (2.9, 4.1), (1.1, 4.1), (1.1, 0.3)]
    got = {(r["target_id"], r["source_id"]): r["weight"] for r in G.polygon_weights(grid(spark), spark.createDataFrame([(1, [star]), (2, [hook[::-1]])], RINGS), 0.5, 0.5).collect()}
    step = (np.arange(200) + 0.5) / 200
    y, x = (m.ravel() for m in np.meshgrid(step, step))
    for unit, ring in ((1, star), (2, hook)):
        for i in range(8):
            for j in range(8):
                assert abs(got.get((unit, i * 8 + j), 0.0) - inside(ring, y + i, x + j).mean()) < 0.006
    shoelace = abs(sum(a * d - c * b for (a, b), (c, d) in zip(star, star[1:] + star[:1], strict=True))) / 2
    assert abs(sum(w for (u, _), w in got.items() if u == 1) - shoelace) < 1e-9


def test_units_without_area(spark):
    units = spark.createDataFrame([(1, None), (2, []), (3, [None]), (4, [[(1.0, 1.0), (2.0, 2.0)]]), (5, [[(20.0, 20.0), (20.0, 21.0), (21.0, 21.0)]])], RINGS)
    assert G.polygon_weights(grid(spark), units, 0.5, 0.5).count() == 0
    assert G.polygon_weights(grid(spark).limit(0), units, 0.5, 0.5).count() == 0


def test_cell_units_cover_themselves(spark):
    cells = grid(spark, 3)
    got = {(r["source_id"], r["target_id"]): r["weight"] for r in G.polygon_weights(cells.unionByName(cells), G.cell_units(cells, 0.5, 0.5), 0.5, 0.5).collect()}
    assert set(got) == {(k, k) for k in range(9)} and all(abs(w - 1) < 1e-12 for w in got.values())


def test_restrict(spark):
    cells = grid(spark, 2)
    weights = spark.createDataFrame([(0, 1, 0.5), (1, 1, 0.25), (2, 1, 0.25), (3, 2, 1.0)], "source_id int, target_id int, weight double")
    x = F.when(F.col("source_id") == 0, 1.0).when(F.col("source_id") == 1, float("nan")).when(F.col("source_id") == 2, 0.0)
    values = cells.select(F.col("lat") + 1e-7, F.col("lon"), x.alias("x")).toDF("lat", "lon", "x")
    kept, lost = G.restrict(weights, cells, G.valid_cells(values.unionByName(values.withColumn("x", F.lit(None).cast("double")))))
    assert {(r["source_id"], r["target_id"]): round(r["weight"], 9) for r in kept.collect()} == {(0, 1): 0.666666667, (2, 1): 0.333333333}
    assert [r["target_id"] for r in lost.collect()] == [2]
