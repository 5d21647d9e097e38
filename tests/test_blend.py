import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.functions import ids as I
from pluvia.operators import checks as K
from pluvia.operators import evaluation as E
from pluvia.operators import models as L
from pluvia.operators import onset as O
from pluvia.operators import relations as R
from pluvia.plans import blend, tables


def test_nearest_looks_beyond_neighbouring_cells(spark):
    points = spark.createDataFrame([(1, 0.99, 0.99), (2, 80.0, -170.0), (3, -0.9, -0.9)], "k int, lat double, lon double")
    targets = spark.createDataFrame([(7, -0.9, -0.9), (8, 0.99, 2.05), (9, -0.9, -0.9)], "t int, lat double, lon double")
    got = {r["k"]: (r["t"], r["gap"]) for r in R.nearest(points, targets, "k", "t").collect()}
    assert got[1][0] == 8 and got[1][1] == pytest.approx(1.06**2) and got[2][0] in (7, 8, 9) and got[3] == (7, 0.0)
    exact = min(((80 - a) ** 2 + (-170 - b) ** 2, t) for t, a, b in [(7, -0.9, -0.9), (8, 0.99, 2.05)])
    assert got[2] == (exact[1], pytest.approx(exact[0]))
    assert R.nearest(points, targets.filter("false"), "k", "t").filter("t IS NULL").count() == 3


def test_units_without_rain_have_no_probabilities(spark):
    rows = spark.createDataFrame([(1, 1, [None, None], None), (1, 2, [None, None], None), (2, 1, [0.0, None], 1), (2, 2, [None, None], None)], "id int, number int, rain array<double>, onset int")
    got = {r["id"]: r["p_onset"] for r in O.onset_probabilities(rows, ["id"], ["onset"], 2, rain="rain").collect()}
    assert got == {1: None, 2: [0.5, 0.0]}
    long = rows.select("id", "number", F.posexplode("rain").alias("lead", "x"))
    stats = {(r["id"], r["lead"]): r["frac_raining"] for r in O.ensemble_stats(long, ["id", "lead"]).collect()}
    assert stats == {(1, 0): None, (1, 1): None, (2, 0): 0.0, (2, 1): 0.0}


def test_row_rps_is_null_without_support(spark):
    rows = spark.createDataFrame([(1, [0.2, 0.2], 1), (2, [0.0, 0.0], 1), (3, [None, 1.0], 1), (4, [1.0, 0.0], None), (5, [0.0, 3.0], 1)], "k int, p array<double>, y int")
    got = {r["k"]: r["s"] for r in rows.select("k", E.row_rps(F.col("p"), F.col("y")).alias("s")).collect()}
    assert got == {1: pytest.approx(0.25), 2: None, 3: None, 4: None, 5: pytest.approx(1.0)}


def test_platt_export_and_cell_fits_equal_numpy(spark, sf):
    rows = tables.probabilities(spark, sf).limit(800).cache()
    data = rows.collect()
    for r in E.platt_export(rows, tables.BINS).collect():
        p = np.clip([d["p"][r["bin"] - 1] for d in data], 1e-6, 1 - 1e-6)
        want = L.newton_1d(np.log(p / (1 - p)), np.array([float(d["y"] == r["bin"]) for d in data]))
        assert (r["intercept"], r["slope"]) == pytest.approx(want, abs=1e-6)
    assert [tuple(r)[1:] for r in E.platt_export(rows.limit(5), 2).collect()] == [(0.0, 1.0)] * 2
    flat = rows.select((F.col("id") % 3).alias("id"), "year", F.round(F.get("p", F.lit(0)), 2).alias("score"), (F.col("y") == 1).cast("int").alias("label"))
    own = flat.collect()
    fits = E.cell_fits(flat, ["id"]).collect()
    assert len(fits) == len({(r["id"], r["year"]) for r in own})
    for r in fits:
        train = [d for d in own if d["id"] == r["id"] and d["year"] != r["test_year"]]
        want = L.newton_1d(np.array([d["score"] for d in train]), np.array([float(d["label"]) for d in train]))
        assert (r["intercept"], r["slope"]) == pytest.approx(want, abs=1e-6)


def test_a_fit_is_stored_and_applied_later(spark, tmp_path):
    rnd = np.random.default_rng(1)
    rows = [(int(2000 + k % 4), float(a), float(b), int(rnd.integers(0, 3))) for k, (a, b) in enumerate(rnd.normal(size=(400, 2)))]
    df = spark.createDataFrame(rows, "year int, u double, v double, y int")
    model = L.final_fit(df, ["u", "v"], "y", {2003})
    L.bundle(spark, model).write.parquet(str(tmp_path / "fit"))
    again = L.from_bundle(spark.read.parquet(str(tmp_path / "fit")))
    a, b = (np.array([r["p"] for r in L.apply_multinomial(df, m).select("u", "v", "p").orderBy("u").collect()]) for m in (model, again))
    assert np.allclose(a, b) and np.allclose(a.sum(axis=1), 1)
    with pytest.raises(ValueError, match="lack"):
        L.final_fit(df.withColumn("y", F.when(F.col("year") == 2003, 3).otherwise(F.col("y"))), ["u", "v"], "y", {2003})
    with pytest.raises(ValueError):
        L.from_bundle(L.bundle(spark, model).filter("class > 0 OR position < 1"))


def test_checks(spark):
    assert K.horizon_policy(28) == (38, "legacy") and K.horizon_policy(28, 40, "Truncate") == (40, "truncate")
    for bad in ((28, None, "exact"), (28, 40, "legacy"), (28, 0), (28, True)):
        with pytest.raises(ValueError):
            K.horizon_policy(*bad)
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, [1.0, None, 3.0]), (4, None)], "id int, rain array<double>")
    bad = lambda policy: {r["id"]: r["problem"] for r in K.horizon_gaps(rows, "rain", 2, policy).collect()}
    assert bad("legacy") == {2: "too short", 4: "too short"}
    assert bad("exact") == {2: "too short", 3: "too long", 4: "too short"} and bad("truncate")[3] == "missing value"
    with pytest.raises(ValueError, match="too short"):
        K.require_horizon(rows, "rain", 2, "exact", ["id"])
    table = spark.createDataFrame([(1, None, "2026-05-01"), (2, None, "2026-05-02")], "a int, b double, time string").withColumn("time", F.to_date("time"))
    with pytest.raises(ValueError, match=r"m: missing columns \['c'\]; m: b: too short a horizon"):
        K.require_features(table, {"m": ["a", "b", "c"]}, {"b": "too short a horizon"})
    assert K.issued_on(table, "2026-05-02").count() == 1
    with pytest.raises(ValueError, match="2026-05-01"):
        K.issued_on(table, "2026-06-01")
    assert K.valid_cells(table, ["a"], "b").count() == 0 and K.half_spacing(table, "a") == 0.5 and K.half_spacing(table.limit(1), "a") == 0.125


def test_ids_and_families(spark):
    grid = lambda step: spark.createDataFrame([(10 + i * step, 20 + j * step) for i in range(4) for j in range(4)], "lat double, lon double")
    assert [I.infer_digits(grid(s)) for s in (1.0, 0.25, 0.125)] == [0, 2, 3]
    with pytest.raises(ValueError):
        I.infer_digits(grid(1.0).filter("false"))
    rows = spark.createDataFrame([("1.5_2.5", None), ("b", None), ("c", 7.0), ("d", None)], "id string, lat double")
    got = {r["id"]: (r["lat"], r["lon"]) for r in R.resolve_location(rows, spark.createDataFrame([("b", 3.0, 4.0), ("c", 0.0, 1.0)], "id string, lat double, lon double")).collect()}
    assert got == {"1.5_2.5": (1.5, 2.5), "b": (3.0, 4.0), "c": (7.0, 1.0), "d": (None, None)}
    assert R.project_family(spark.createDataFrame([(1, 2, 3)], "id int, p_day_1 int, p_day_x int"), "p", "m", "raw").columns == ["id", "m_raw_day_1", "p_day_x"]
    joined = E.evaluation_join(spark.createDataFrame([(1, "t", 5), (9, "t", 6)], "id int, time string, week1 int"), spark.createDataFrame([(1, 2)], "id int, y int"), spark.createDataFrame([(1, "t", 8, 9)], "id int, time string, week1 int, clim int"), ["week1", "clim"])
    assert [r.asDict() for r in joined.collect()] == [{"id": 1, "time": "t", "week1": 5, "y": 2, "clim": 9}]


def test_blend_from_start_to_end(spark):
    sf = "/root/testdata/sf0.01"
    out = blend.blended(spark, sf)
    n = spark.read.parquet(f"{sf}/supplier.parquet").count() * len(tables.YEARS) * len(tables.ISSUES)
    got = out.collect()
    assert 0 < len(got) <= n and all(abs(sum(r["p"]) - 1) < 1e-9 and abs(sum(r["clim"]) - 1) < 1e-6 for r in got)
