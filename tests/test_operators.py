import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.functions import arrays as A
from pluvia.functions import ids as I
from pluvia.operators import climatology as C
from pluvia.operators import export as X
from pluvia.operators import metrics as M
from pluvia.operators import models as L
from pluvia.operators import regrid as G
from pluvia.operators import relations as R
from pluvia.operators.onset import OnsetRule
from pluvia.plans import queries as Q
from pluvia.plans import tables as T
from pluvia.sources import files
from pluvia.streaming import forecasts


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lits(xs):
    return F.array(*[F.lit(x).cast("double") for x in xs])


def test_array_functions(spark):
    assert value(spark, A.rolling_sums(lits([1, 2, None, 4, 5]), 2)) == [3, None, None, 9]
    assert value(spark, A.rolling_sums(lits([1]), 2)) == []
    assert value(spark, A.plus_bin(lits([0.2, None, 0.3]))) == pytest.approx(0.5)
    assert value(spark, A.softmax(lits([1000, 1000]))) == [0.5, 0.5]
    assert value(spark, A.softmax(lits([1, None]))) is None
    assert value(spark, A.clean_probs(lits([None, -1, 0]))) == pytest.approx([1 / 3] * 3)
    assert value(spark, A.max_period(lits([0.1, 0.4, 0.4]))) == 2
    assert value(spark, A.rps(lits([0.2, 0.3, 0.5]), lits([0, 1, 0]))) == pytest.approx(0.04 + 0.25)
    assert value(spark, A.logsumexp(lits([0, 0]))) == pytest.approx(np.log(2))
    assert value(spark, A.week_extreme(lits([1, None, 3, 4]), 2, 1, 3)) == 7
    with pytest.raises(ValueError):
        A.rain_transform(F.lit(1.0), "cube")


@pytest.mark.parametrize("p,target", [([0.5, 0.0, 0.5], 1.0), ([0.0, 0.0, 0.0], 0.0), ([0.0, 0.0, 0.0], 0.03), ([0.2, 0.1, 0.05], 0.35), ([0.0, 0.0, 0.5], 0.45), ([0.3, 0.3, 0.3], 2.0)])
def test_floor_keeps_the_sum(spark, p, target):
    low = 0.02
    got = value(spark, A.floor_probs(lits(p), F.lit(target), low))
    if target <= 1e-12:
        assert got == [0, 0, 0]
    elif target < 3 * low:
        assert got == pytest.approx([target / 3] * 3)
    else:
        assert min(got) >= low - 1e-12
        if sum(max(x, low) for x in p) >= min(target, 1):
            assert sum(got) == pytest.approx(min(target, 1), abs=1e-9)


def test_formula():
    assert L.expand_formula("a * b + c", 2) == [("a",), ("b",), ("a", "b"), ("c",)]
    assert L.expand_formula("p_qx * r", 2) == [("p_week1",), ("r",), ("p_week1", "r"), ("p_week2",), ("p_week2", "r")]
    assert L.expand_formula("p_qx", 3, {"p_week2"}) == [("p_week1",), ("p_week3",)]
    for bad in ("p_week4", "p_qx"):
        with pytest.raises(ValueError):
            L.expand_formula(bad, 1, {"p_week4", "p_week1"})


def test_multinomial_equals_newton(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(400, 2))
    z = np.column_stack([x @ [1.0, -0.5], x @ [-0.3, 0.8], np.zeros(400)])
    y = (z + rnd.gumbel(size=z.shape)).argmax(axis=1)
    table = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)] + [(None, 1.0, 0)], "a double, b double, y int")
    out = L.apply_multinomial(table, L.fit_multinomial(table, ["a", "b"], "y")).collect()
    assert out[-1]["p"] is None
    s = np.column_stack([np.ones(400), (x - x.mean(0)) / x.std(0)])
    w = np.zeros((3, 3))
    for _ in range(3000):
        p = np.exp(s @ w)
        p /= p.sum(axis=1, keepdims=True)
        w -= 2.0 * s.T @ (p - np.eye(3)[y]) / 400
    assert np.abs(np.array([r["p"] for r in out[:-1]]) - p).max() < 1e-3


def test_every_year_is_predicted(spark, sf):
    got = {(r["k"], r["bin"]): r["year"] for r in Q.multinom_cv(spark, sf).select("k", "bin", "year").collect()}
    years = {r["k"]: r["year"] for r in T.probabilities(spark, sf).select("k", "year").collect()}
    assert got == {(k, b): y for k, y in years.items() for b in range(T.BINS)}


def test_platt_and_fallback(spark):
    rnd = np.random.default_rng(1)
    score = rnd.uniform(size=600).round(3)
    label = (rnd.uniform(size=600) < 1 / (1 + np.exp(-(3 * score - 1)))).astype(int)
    rows = [(2000 + k % 3, 1, float(s), int(c)) for k, (s, c) in enumerate(zip(score, label))] + [(2000, 2, 0.5, 1)]
    out = L.platt_cross_validate(spark.createDataFrame(rows, "year int, bin int, score double, label int"), [2000, 2001, 2002]).collect()
    assert len(out) == 601 and [r["calibrated"] for r in out if r["bin"] == 2] == [0.5]
    a, b = L.newton_1d(score, label)
    full = 1 / (1 + np.exp(-(a + b * 0.5)))
    near = [r["calibrated"] for r in out if r["bin"] == 1 and abs(r["score"] - 0.5) < 0.01]
    assert all(abs(v - full) < 0.1 for v in near)


def test_platt_counts_rows_and_keeps_scores(spark):
    rng = np.random.default_rng(3)
    x = 0.5 + rng.random(60) * 1e-6  # distinct only beyond six digits
    rows = [(1, float(v), int(rng.random() < (0.2 if v < 0.5000005 else 0.8))) for v in x]
    lots = [(2, v, y, 100_000_000) for v, y in ((0.2, 0), (0.2, 1), (0.7, 1))]  # too many rows for one task
    first = L.platt_weights(spark.createDataFrame(rows, "g int, score double, label int"), ["g"]).first()
    a, b = L.newton_1d(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    p = [1 / (1 + np.exp(-(i + s * 0.5000009))) for i, s in ((a, b), (first["intercept"], first["slope"]))]
    assert p[0] == pytest.approx(p[1], abs=1e-3)
    got = L.platt_weights(spark.createDataFrame(lots, "g int, score double, label int, n long"), ["g"], n="n").first()
    assert got["intercept"] + got["slope"] * 0.2 == pytest.approx(0, abs=1e-6)


def test_kernels_are_weighted_by_equal_samples(spark):
    days = [3] * 4 + [9] * 7 + [20]
    df = spark.createDataFrame([(1, d) for d in days], "id int, onset_day int")
    fit = C.fit_kde(df, ["id"])
    r = fit.first()
    bw = np.std(days, ddof=1) * len(days) ** -0.2
    at = np.linspace(3 - 3 * bw, 20 + 3 * bw, C.GRID)
    pdf = np.exp(-0.5 * ((at[:, None] - np.array(days)) / bw) ** 2).sum(axis=1)
    assert r["n"] == 12 and r["cdf"] == pytest.approx(np.cumsum(pdf) / pdf.sum())
    assert C.equal_samples(df, ["id"]).select(F.size("_x")).first()[0] == 3


def test_kde_loyo_on_the_whole_grid(spark, sf):
    samples = [(r["id"], r["year"], r["onset_day"]) for r in T.onset_samples(spark, sf).collect()]
    got = {}
    for r in Q.kde_loyo_all(spark, sf).collect():
        got.setdefault((r["id"], r["test_year"]), {})[r["i"]] = (r["n"], r["q"])
    expected = {}
    for unit in {s[0] for s in samples}:
        for y in {s[1] for s in samples}:
            days = np.array([d for i, t, d in samples if i == unit and t != y], float)
            if len(days) >= C.MIN_SAMPLES and np.std(days) > 0:
                bw = np.std(days, ddof=1) * len(days) ** -0.2
                at = np.linspace(days.min() - 3 * bw, days.max() + 3 * bw, C.GRID)
                pdf = np.exp(-0.5 * ((at[:, None] - days) / bw) ** 2).sum(axis=1)
                expected[unit, y] = (len(days), np.cumsum(pdf) / pdf.sum())
    assert set(got) == set(expected)
    for k, (n, cdf) in expected.items():
        assert set(got[k]) == set(range(C.GRID)) and got[k][0][0] == n
        assert [got[k][i][1] for i in range(C.GRID)] == pytest.approx(cdf, abs=2e-8)


def test_missing_days_anywhere_drop_a_series(spark, sf):
    assert Q.missing_policy_drop_all(spark, sf).count() == 0  # (7 d + id) mod 31 is 0 on some of 184 days of every series
    rows = [(1, 2000, d, None if d == 150 else 1.0) for d in range(1, 185)] + [(2, 2000, d, 2.0) for d in range(1, 185)]
    got = R.missing_policy(spark.createDataFrame(rows, "id int, year int, d int, x double"), "drop", ["id", "year"])
    assert {r["id"] for r in got.collect()} == {2} and got.count() == 184


def test_mixing_weights_find_the_better_model(spark):
    good, bad = [0.7, 0.2, 0.1], [0.1, 0.2, 0.7]
    table = spark.createDataFrame([(good, bad, 1)] * 7 + [(good, bad, 2)] * 2 + [(good, bad, 3)], "g array<double>, b array<double>, y int")
    weights, loss = L.mixing_weights(table, ["g", "b"], "y", 3)
    assert weights["g"] == pytest.approx(1.0, abs=1e-3)
    direct = table.select(F.avg(A.rps(F.col("g"), A.one_hot(F.col("y"), 3)))).first()[0]
    assert loss == pytest.approx(direct, abs=1e-6)


def test_auc_and_pietra_edges(spark):
    rows = [("same", 1.0, 1), ("same", 1.0, 0), ("one", 1.0, 1), ("one", 2.0, 1), ("split", 0.0, 0), ("split", 1.0, 1)]
    table = spark.createDataFrame(rows, "g string, score double, label int")
    assert {r["g"]: r["auc"] for r in M.auc(table, ["g"]).collect()} == {"same": 0.5, "one": None, "split": 1.0}
    assert {r["g"]: r["pietra"] for r in M.pietra(table, ["g"]).collect()} == {"same": 0.0, "one": None, "split": 1.0}


def test_relations(spark):
    assert R.parse_years("2001, 2003:2005") == [2001, 2003, 2004, 2005] and R.parse_years("") == []
    left = spark.createDataFrame([("01",), ("2",)], "id string")
    with pytest.raises(ValueError, match="no threshold"):
        R.attach_thresholds(left, spark.createDataFrame([("01", 5.0)], "id string, threshold double"))
    with pytest.raises(ValueError, match="conflicting"):
        R.attach_thresholds(left, spark.createDataFrame([("01", 5.0), ("01", 6.0), ("2", 1.0)], "id string, threshold double"))
    assert R.attach_thresholds(left, 3).first()["threshold"] == 3.0
    bad = G.check_weights(spark.createDataFrame([("a", "t", 0.5), ("a", "t", 0.5), ("b", "u", 0.0), ("c", "t", -1.0)], "source_id string, target_id string, weight double"))
    assert {r["reason"] for r in bad.collect()} == {"weight", "repeated", "no weight"}


def test_constant_field_stays_constant(spark):
    cells = spark.createDataFrame([(k, d, 7.0 if (k + d) % 3 else None) for k in range(5) for d in range(4)] + [(k, 9, None) for k in range(5)], "source_id int, d int, x double")
    w = spark.createDataFrame([(k, t, float(k + t)) for k in range(5) for t in (1, 2)], "source_id int, target_id int, weight double")
    for r in G.weighted_mean(cells, w, ["d"]).collect():
        assert r["x"] is None if r["d"] == 9 else r["x"] == pytest.approx(7.0)


def test_centroid(spark):
    square = F.array(*[F.struct(F.lit(float(y)).alias("lat"), F.lit(float(x)).alias("lon")) for y, x in ((0, 0), (0, 4), (2, 4), (2, 0))])
    y, x = G.polygon_centroid(square)
    assert (value(spark, y), value(spark, x)) == (1.0, 2.0)


def test_ids(spark):
    assert value(spark, I.grid_id(F.lit(-0.001), F.lit(77.5), 2)) == "0_77.5"
    assert value(spark, I.grid_id(F.lit(8.0), F.lit(77.125), 2, fixed=True)) == "8.00_77.13"
    assert value(spark, I.parse_grid_id(F.lit("8.5_77"))[0]) == 8.5
    assert value(spark, I.parse_grid_id(F.lit("A_B"))[0]) is None
    assert value(spark, I.normal_id(F.lit("  "))) is None


def test_ids_round_like_the_reference(spark):
    xs = [5.125, 5.375, 5.625, 5.875, -5.125, 2.675, 1.005, 0.015, -0.001, 77.5, 179.995, 0.5, 1.5, 0.0]
    for digits in (0, 1, 2, 3):
        got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", I.format_coordinate(F.col("x"), digits, True, half_even=True).alias("s")).collect()
        assert {r["x"]: r["s"] for r in got} == {x: f"{round(x, digits) or 0.0:.{digits}f}" for x in xs}


def test_messages(spark):
    span = lambda p: tuple(value(spark, X.categorise(lits(p))))[:3]
    chances = ([0.7, 0.1, 0.1, 0], [0.5, 0.25, 0, 0], [0.1, 0.5, 0.25, 0], [0.1, 0.25, 0.25, 0.25], [0, 0, 0.375, 0.25], [0.2, 0.1, 0.3, 0.1])
    assert [span(p) for p in chances] == [(1, 1, 1), (1, 1, 2), (1, 2, 3), (2, 2, 4), (2, 3, 4), (3, 3, 3)]
    day = lambda d: F.lit(datetime.date.fromisoformat(d))
    assert value(spark, X.message(F.lit("X"), F.lit(1), F.lit(0.625), day("2026-06-02"), day("2026-06-08"))) == "X: season onset expected Jun 02 to Jun 08 (62%)"


def test_sources(spark, tmp_path):
    for name in ("rain_2001.bin", "rain_2003.bin", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    found = files.discover(spark, f"file://{tmp_path}", "^rain", 2002, 2010).collect()
    assert [r["year"] for r in found] == [2003]
    with pytest.raises(FileNotFoundError):
        files.discover(spark, f"file://{tmp_path}", "^snow")
    (tmp_path / "thr.csv").write_text("adm3_name,onset_threshold\r\n 007 ,20\r\n")
    assert files.read_thresholds(spark, f"file://{tmp_path}/thr.csv").collect() == [("007", 20.0)]
    assert files.read_thresholds(spark, "12.5") == 12.5
    (tmp_path / "ref.csv").write_text("i,Year,MOK\n0,2001,14\n")
    assert files.read_reference_onsets(spark, f"file://{tmp_path}/ref.csv").first()["ref_onset_date"] == datetime.date(2001, 5, 15)
    stage = files.write_stage(spark.createDataFrame([(1, 2001)], "id int, year int"), f"file://{tmp_path}/stage")
    assert stage.filter("year = 2001").count() == 1


def test_stream(spark, tmp_path):
    at = datetime.datetime(2026, 6, 1)
    rows = [("a", at, k, [0.0] * k + [9.0, 9.0] + [3.0] * 30) for k in range(3)] + [("a", at, 3, [0.0] * 30)]
    spark.createDataFrame(rows, forecasts.FORECAST).write.parquet(f"file://{tmp_path}/in")
    stream = forecasts.onsets(forecasts.read_forecasts(spark, f"file://{tmp_path}/in"), OnsetRule(window=2), 10.0)
    forecasts.write(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/mark").awaitTermination()
    assert {r["number"]: r["onset_lead"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()} == {0: 1, 1: 2, 2: 3, 3: None}
