import numpy as np

from pluvia.operators import coverage as V
from tests.test_polygons import RINGS, grid, inside

SIDES = "south double, north double, west double, east double"


def test_footprint_equals_counted_points(spark):
    rnd = np.random.default_rng(2)
    lo = rnd.integers(0, 60, (25, 2)) / 10
    boxes = [(a, a + h, b, b + w) for (a, b), (h, w) in zip(lo.tolist(), (rnd.integers(3, 25, (25, 2)) / 10).tolist(), strict=True)] + [(1.0, 1.0, 0.0, 9.0)]
    hook = [(0.25, 0.35), (0.25, 5.75), (2.95, 5.75), (2.95, 4.15), (1.15, 4.15), (1.15, 0.35)]
    far = [(50.0, 50.0), (50.0, 51.0), (51.0, 51.0)]
    covered = spark.createDataFrame(boxes + boxes[:3], SIDES)
    units = spark.createDataFrame([(1, [hook]), (2, [far]), (3, None)], RINGS)
    y, x = (m.ravel() for m in np.meshgrid((np.arange(1600) + 0.5) / 200, (np.arange(1600) + 0.5) / 200))
    seen = np.zeros(len(y), bool)
    for s, n, w, e in boxes:
        seen |= (y > s) & (y < n) & (x > w) & (x < e)
    parts = V.disjoint_boxes(covered, (2.0, 1.5)).collect()
    count = np.zeros(len(y), int)
    for r in parts:
        count += (y > r["south"]) & (y < r["north"]) & (x > r["west"]) & (x < r["east"])
    assert count.max() == 1 and (count.astype(bool) == seen).all()
    hit = inside(hook, y, x)
    weights, lost = V.weights_to_coverage(grid(spark), 0.5, 0.5, units, covered, (2.0, 1.5))
    got = {r["source_id"]: r["weight"] for r in weights.collect()}
    assert abs(sum(got.values()) - 1) < 1e-12 and sorted(r[0] for r in lost.collect()) == [2, 3]
    for k in range(64):
        cell = (np.floor(y) == k // 8) & (np.floor(x) == k % 8)
        assert abs(got.get(k, 0.0) - (cell & hit & seen).sum() / (hit & seen).sum()) < 0.002
    missing = {r["target_id"]: r["missing_frac"] for r in V.uncovered(units, covered, (2.0, 1.5)).collect()}
    assert abs(missing[1] - 1 + (hit & seen).sum() / hit.sum()) < 0.002 and missing[2] == 1.0 and missing[3] is None


def test_strips_keep_their_own_vertices():
    ring = [{"lat": float(np.sin(t) * 10), "lon": float(np.cos(t) * 10)} for t in np.linspace(0, 2 * np.pi, 2000, endpoint=False)]
    strips = V._strips({"target_id": 1, "ring": ring}, 0.5)
    assert sum(len(s["ring"]) for s in strips) < 2000 + 8 * len(strips)


def test_missing_sources_are_an_error(spark):
    import pytest

    from pluvia.operators import regrid as G

    weights = spark.createDataFrame([(1, 9, 0.5), (2, 9, 0.5), (3, 9, 0.0)], "source_id int, target_id int, weight double")
    cells = spark.createDataFrame([(1, 1.0), (2, None)], "source_id int, x double")
    assert G.require_sources(cells, weights).count() == 2
    with pytest.raises(ValueError, match="lack sources"):
        G.require_sources(cells.filter("source_id = 1"), weights)
