import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.sources import grids as G
from tests.test_polygons import RINGS

DAY = datetime.date(2001, 5, 1)


def make(path, days=70, lat=(10.0, 10.5, 11.0), lon=(70.0, 70.5), record=True, first=DAY, seed=0, **more):
    v = np.random.default_rng(seed).integers(0, 50, (days, len(lat), len(lon))) / 4
    v[3, 1, 0] = np.nan
    path.write_bytes(G.encode(v, [first + datetime.timedelta(k) for k in range(days)], np.array(lat), np.array(lon), record=record, **more))
    return v


@pytest.mark.parametrize("record", [True, False])
def test_scan_gives_what_was_written(spark, tmp_path, record):
    v = make(tmp_path / "rain_2001.nc", record=record)
    got = {(r["time"], r["lat"], r["lon"]): r["rain"] for r in G.scan(spark, [f"file://{tmp_path}/rain_2001.nc"], slab_days=20).collect()}
    assert len(got) == v.size and got[DAY + datetime.timedelta(3), 10.5, 70.0] is None
    for (k, i, j), x in np.ndenumerate(v):
        assert np.isnan(x) or got[DAY + datetime.timedelta(k), 10.0 + i / 2, 70.0 + j / 2] == x


def test_bounds_prune_slabs_and_cells(spark, tmp_path):
    make(tmp_path / "a.nc")
    options = {"paths": str(tmp_path / "a.nc"), "slab_days": "10"}
    assert len(G.GridReader(options).partitions()) == 7
    reader = G.GridReader(options | {"from": "2001-05-12", "to": "2001-05-15", "south": "10.4"})
    assert [(p.first, p.last) for p in reader.partitions()] == [(10, 20)]
    days = G.scan(spark, [str(tmp_path / "a.nc")], slab_days=10, from_="2001-05-12", to="2001-05-15", south=10.4)
    assert days.count() == 4 * 2 * 2 and days.rdd.getNumPartitions() == 1


def test_filters_of_the_query_are_pushed(spark, tmp_path):
    make(tmp_path / "a.nc")
    rows = G.scan(spark, [str(tmp_path / "a.nc")], slab_days=10).filter((F.col("time") >= datetime.date(2001, 6, 25)) & (F.col("lat") > 10.0))
    assert rows.rdd.getNumPartitions() == 2 and rows.count() == 15 * 2 * 2


def test_gaps_and_unknown_names_raise(tmp_path):
    days = [DAY, DAY + datetime.timedelta(2)]
    (tmp_path / "gap.nc").write_bytes(G.encode(np.zeros((2, 1, 1)), days, np.array([1.0]), np.array([2.0])))
    with pytest.raises(ValueError, match="contiguous"):
        G.GridReader({"paths": str(tmp_path / "gap.nc")}).partitions()
    assert len(G.GridReader({"paths": str(tmp_path / "gap.nc"), "daily": "false"}).partitions()) == 1
    with pytest.raises(ValueError, match="no variable"):
        G.GridReader({"paths": str(tmp_path / "gap.nc"), "variable": "snow"}).partitions()
    with pytest.raises(ValueError, match="units"):
        G.dates(np.array([1.0]), "fortnights since 2001-01-01")
    assert G.dates(np.array([24.0, 47.0]), "hours since 2001-01-01 00:00:00") == [datetime.date(2001, 1, 2)] * 2


def test_sink_matrix_and_round_trip(spark, tmp_path):
    rows = [(2001 + k // 40, datetime.date(2001 + k // 40, 6, 1) + datetime.timedelta(k % 40), 1.0 + c, 5.0, float(k * c)) for k in range(80) for c in range(3) if (k, c) != (7, 1)]
    df = spark.createDataFrame(rows, "year int, time date, lat double, lon double, x double")
    files = sorted(r["path"] for r in G.write_grids(df, f"file://{tmp_path}/out").collect())
    assert len(files) == 2
    got = G.scan(spark, files, "x")
    assert sorted((r["time"], r["lat"], r["x"]) for r in got.filter("x IS NOT NULL").collect()) == sorted((r[1], r[2], r[4]) for r in rows)
    cell = {r["lat"]: r for r in G.matrix(got.filter(F.year("time") == 2001), datetime.date(2001, 6, 5), "x").collect()}
    assert cell[2.0]["start"] == datetime.date(2001, 6, 5) and cell[2.0]["values"] == [0.0 if k == 7 else float(k) for k in range(4, 40)]


def test_each_grid_has_its_own_weights(spark, tmp_path):
    a = make(tmp_path / "a.nc", days=5)
    b = make(tmp_path / "b.nc", days=5, lat=(10.0, 11.0), lon=(70.0, 71.0), first=datetime.date(2002, 5, 1), seed=1)
    c = make(tmp_path / "c.nc", days=5, first=datetime.date(2003, 5, 1), seed=2)
    scan = G.scan(spark, [str(tmp_path / f"{n}.nc") for n in "abc"])
    assert scan.select("grid").distinct().count() == 2
    units = spark.createDataFrame([(1, [[(9.75, 69.75), (9.75, 70.25), (10.75, 70.25), (10.75, 69.75)]])], RINGS)
    got = {r["time"]: r["rain"] for r in G.regrid_by_grid(scan, units).collect()}
    assert len(got) == 15
    for v, first in ((a, DAY), (c, datetime.date(2003, 5, 1))):  # the unit is the first two cells of the first column
        for k in range(5):
            assert got[first + datetime.timedelta(k)] == pytest.approx(np.nanmean(v[k, :2, 0]))
    for k in range(5):  # three quarters of the unit lie in the first cell, one in the second
        w = np.array([0.75, 0.25]) * ~np.isnan(b[k, :, 0])
        assert got[datetime.date(2002, 5, 1) + datetime.timedelta(k)] == pytest.approx((w * np.nan_to_num(b[k, :, 0])).sum() / w.sum())
