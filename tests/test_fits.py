"""Grouped multinomial and logistic fits against NumPy, row by row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvia.operators import fits as N
from pluvia.operators import models as L
from pluvia.plans import queries as Q
from pluvia.plans import tables

SCHEMA = "k int, id string, cluster int, year int, a double, b double, label int"


def newton(x, y, classes, steps=60):
    """Class probabilities' weights of a multinomial fit on standardised columns, by damped Newton steps."""
    there = sorted(set(y))
    w = np.zeros((classes, x.shape[1]))
    loss_of = lambda w: -np.log(prob(x, w, there)[np.arange(len(y)), y]).sum()
    at = [k for k in there[1:]]
    for _ in range(steps):
        p = prob(x, w, there)
        g = np.concatenate([((p[:, k] - (y == k))[:, None] * x).sum(0) for k in at])
        h = np.block([[(x * (p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ x for b in at] for a in at])
        step, scale = np.linalg.solve(h + 1e-9 * np.eye(len(g)), g).reshape(len(at), -1), 1.0
        while scale > 1e-8:
            new = w.copy()
            new[at] -= scale * step
            if loss_of(new) <= loss_of(w) + 1e-12:
                break
            scale /= 2
        w = new
        if np.abs(step).max() < 1e-11:
            break
    return w, there


def prob(x, w, there):
    z = np.full((len(x), len(w)), -np.inf)
    z[:, there] = x @ w[there].T
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def brute(rows, group, classes, held=(), allowed=None):
    """k -> probabilities (None for classes without training rows, None without a fit)."""
    out = {}
    for g, year in {(group(r), r[3]) for r in rows if r[3] is not None and r[3] not in held}:
        scale = [r for r in rows if group(r) == g and r[3] not in held and None not in (r[4], r[5], r[6]) and (allowed is None or r[1] in allowed)]
        train, test = [r for r in scale if r[3] != year], [r for r in rows if group(r) == g and r[3] == year]
        y = np.array([r[6] for r in train])
        fit = None
        if len(set(y.tolist())) > 1:
            m = np.array([[r[4], r[5]] for r in scale]).mean(0)
            s = np.array([[r[4], r[5]] for r in scale]).std(0)
            x = lambda rs: np.column_stack([np.ones(len(rs)), (np.array([[r[4], r[5]] for r in rs], float) - m) / np.where(s > 0, s, 1)])  # noqa: E731, B023
            fit = newton(x(train), y, classes)
        for r in test:
            if fit is None or None in (r[4], r[5]):
                out[r[0]] = None
            else:
                p = prob(x([r]), *fit)[0]
                out[r[0]] = [float(p[k]) if k in fit[1] else None for k in range(classes)]
    return out


def table(spark):
    rnd = np.random.default_rng(5)
    rows = []
    for k in range(900):
        a, b = rnd.normal(size=2)
        z = np.array([0.6 * a, -0.5 * b, 0.3])
        unit = f"u{k % 5}"
        rows.append((k, unit, k % 5 // 2, 2000 + int(rnd.integers(0, 6)), float(a), float(b), int((z + rnd.gumbel(size=3)).argmax())))
    rows += [(900, "u0", 0, 2001, None, 1.0, 1), (901, "u0", 0, 2001, 0.5, 1.0, None), (902, "u1", 0, -1, 9.0, 9.0, 0), (903, "u1", 0, None, 9.0, 9.0, 0)]
    rows += [(910 + i, "lone", 7, 2000 + i, float(i), 1.0, 2) for i in range(3)] + [(920 + i, "two", 8, 2000 + i % 4, float(i % 7), float(i % 5), i % 2 if i % 4 else 2) for i in range(40)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def same(got, want):
    assert {r["k"] for r in got} == set(want)
    for r in got:
        w = want[r["k"]]
        assert (r["p"] is None) == (w is None), r
        if w is not None:
            assert r["p"] == [None if v is None else pytest.approx(v, abs=2e-6) for v in w]


def test_fits_of_units_and_clusters_equal_numpy(spark):
    rows, df = table(spark)
    rows = [r if r[3] is not None else (*r[:3], None, *r[4:]) for r in rows]
    for keys, group in ((["id"], lambda r: r[1]), (["cluster"], lambda r: r[2])):
        got = N.cross_validate_groups(df, keys, ["a", "b"], "label", 3).select("k", "p").collect()
        same(got, brute(rows, group, 3, held={-1}))


def test_slices_and_steps_give_the_same_fit(spark, monkeypatch):
    rows, df = table(spark)
    whole = {r["k"]: r["p"] for r in N.cross_validate_groups(df, ["cluster"], ["a", "b"], "label", 3).select("k", "p").collect()}
    of = N.fit_groups
    monkeypatch.setattr(N, "fit_groups", lambda *a, **b: of(*a, **b, slice_rows=50))
    for r in N.cross_validate_groups(df.filter("cluster < 3"), ["cluster"], ["a", "b"], "label", 3).select("k", "p").collect():
        assert r["p"] is None and whole[r["k"]] is None or r["p"] == pytest.approx(whole[r["k"]], abs=1e-8)


def test_allowed_units_and_true_holdouts(spark):
    rows, df = table(spark)
    rows = [r for r in rows if r[1] in ("u0", "u1", "u2")]
    df = df.filter("id IN ('u0', 'u1', 'u2')")
    allowed = spark.createDataFrame([("u0",), ("u2",), ("u2",)], "id string")
    got = L.cross_validate(df, ["a", "b"], "label", L.fold_years(df, {2003}), {2003}, allowed=allowed).select("k", "p").collect()
    same(got, brute(rows, lambda r: 0, 3, held={-1, 2003}, allowed={"u0", "u2"}))
    with pytest.raises(ValueError, match="lack"):
        L.cross_validate(df.filter("label <> 1 OR year = 2001"), ["a", "b"], "label", [2000, 2001])


def test_no_rows(spark):
    _, df = table(spark)
    assert N.cross_validate_groups(df.limit(0), ["id"], ["a", "b"], "label", 3).count() == 0


def test_calibrated_rows_equal_numpy(spark, sf):
    rows = tables.probabilities(spark, sf).filter("id < 6")
    data = rows.collect()
    allowed = spark.createDataFrame([(i,) for i in (0, 1, 2, 3)], "id long")
    years = L.fold_years(rows, {1997})
    got = {r["k"]: r["calibrated"] for r in L.platt_calibrated(rows, tables.BINS, years, {1997}, allowed).collect()}
    assert set(got) == {d["k"] for d in data if d["year"] in years} and len(years) > 4
    for year in years:
        train = [d for d in data if d["year"] not in (year, 1997) and d["id"] < 4]
        fits = [L.newton_1d(np.clip([d["p"][b] for d in train], 1e-6, 1 - 1e-6), np.array([float(d["y"] == b + 1) for d in train])) for b in range(tables.BINS)]
        for d in data:
            if d["year"] == year:
                q = np.array([1 / (1 + np.exp(-(i + s * v))) for (i, s), v in zip(fits, d["p"], strict=True)])
                assert got[d["k"]] == pytest.approx(q / q.sum(), abs=1e-6)


def test_registered_calibration_sums_to_one(spark, sf):
    sums = Q.platt_cv(spark, sf).groupBy("k").agg(F.sum("calibrated").alias("s")).agg(F.min("s"), F.max("s")).first()
    assert list(sums) == pytest.approx([1, 1], abs=1e-9)


def test_cells_of_the_registered_query_equal_numpy(spark, sf):
    df, names = L.design(Q._blend(spark, sf).filter("id < 3"), L.expand_formula("a_week1 + rain", 2))
    rows = [(r["k"], r["id"], 0, r["year"], r["x0"], r["x1"], r["label"]) for r in df.collect()]
    same(N.cross_validate_groups(df.drop("p", "q"), ["id"], names, "label", tables.BINS).select("k", "p").collect(), brute(rows, lambda r: r[1], tables.BINS, held={-1}))


def test_window_variants_of_a_formula():
    got = L.window_formulas("blend", "clim_qx * rain", 2, "clim", "clim{window}", [1900, 1990, 2000], 2020, {"clim_2000_2020_week2"})
    assert got == {
        "blend_1990_2020": [("clim_1990_2020_week1",), ("rain",), ("clim_1990_2020_week1", "rain"), ("clim_1990_2020_week2",), ("clim_1990_2020_week2", "rain")],
        "blend_2000_2020": [("clim_2000_2020_week1",), ("rain",), ("clim_2000_2020_week1", "rain")]}
    with pytest.raises(ValueError):
        L.window_formulas("blend", "rain", 2, "clim", "clim{window}", [1990], 2020)


@pytest.mark.parametrize("name", ["multinom_cv", "multinom_cv_allowed"])
def test_rows_meet_their_fit_unshuffled_and_are_predicted_in_batches(spark, sf, name):
    """Rows were dealt out by year, which is a task a year, and predicted by lambda functions a value at a time."""
    plan = Q.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    top = plan[: plan.index("Join")]
    assert "ArrowEvalPython" in top and "lambda" not in top
    assert "rightHint=(strategy=broadcast)" in plan[plan.index("Join") :].splitlines()[0]


def test_allowed_units_meet_counted_rows(spark, sf, monkeypatch):
    """Each row met the allowed units before equal rows were counted."""
    plans, of = [], N.cut
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    monkeypatch.setattr(N, "cut", lambda df: plans.append(plan(df)) or of(df))
    size = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(size)
    spark.conf.set(size, "-1")  # small units would be broadcast, and the semi-join pushed below the count
    try:
        Q.QUERIES["multinom_cv_allowed"](spark, sf)
    finally:
        spark.conf.set(size, before)
    left = [p[i + 1].split(":- ", 1)[1] for p in plans for i, line in enumerate(p) if "Join LeftSemi" in line]
    assert left and all(line.startswith("Aggregate") and "count(1)" in line for line in left), left


def test_rows_of_a_large_group_do_not_meet_in_a_task(spark, monkeypatch):
    """With predictors that differ in every row, all rows of a group were shuffled by its key to meet its mean and its totals."""
    df = spark.range(6000).select(
        F.col("id").alias("k"), (F.col("id") % 9).alias("id"), (F.col("id") % 5 + 2000).alias("year"), F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 7 % 3).cast("int").alias("label"))
    plans, of = {}, N.cut
    monkeypatch.setattr(N, "cut", lambda df: plans.update({c: df._jdf.queryExecution().executedPlan().toString() for c in df.columns}) or of(df))
    size = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(size)
    spark.conf.set(size, "16k")  # less than the rows, more than what a group has
    try:
        out = L.cross_validate(df, ["a", "b"], "label", L.fold_years(df), allowed=df.select("id").filter("id < 7"))
    finally:
        spark.conf.set(size, before)
    assert out.filter("p IS NOT NULL").count() == 6000
    for column in ("_n", "_s", "n", "rows"):  # counted rows, scale, terms, slices
        assert "SortMergeJoin" not in plans[column] and "ShuffledHashJoin" not in plans[column], column
        assert "BroadcastHashJoin" in plans[column], column


def test_constants_and_counted_rows_keep_their_scale(spark):
    rows = [(k, "u", 0, 2000 + k % 3, 0.1, float(k % 4), int(k % 7 < 3)) for k in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    same(N.cross_validate_groups(df, ["id"], ["a", "b"], "label", 2).select("k", "p").collect(), brute(rows, lambda r: r[1], 2))
