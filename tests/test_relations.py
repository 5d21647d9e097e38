import bisect
import random

import pytest
from pyspark.sql import functions as F

from pluvia.operators import onset as O
from pluvia.operators import relations as R


def test_fingerprint_sees_swaps_and_repeats(spark):
    make = lambda rows, cols="a int, b string": R.multiset_fingerprint(spark.createDataFrame(rows, cols)).first()
    rows = [(1, "x"), (2, "y"), (None, ""), (4, None)]
    one = make(rows)
    assert one == make(rows[::-1]) and one["n_rows"] == 4
    assert one == R.multiset_fingerprint(spark.createDataFrame(rows, "a int, b string").select("b", "a").repartition(3)).first()
    others = [[(1, "y"), (2, "x"), *rows[2:]], [*rows, rows[0]], [*rows, *rows], [(1, "x"), (2, "y"), (None, None), (4, "")], rows[:3]]
    assert len({one["hash"], *[make(r)["hash"] for r in others], make(rows, "a int, c string")["hash"]}) == 7
    assert make([])["n_rows"] == 0 and make([(1, "2,-"), (2, None)])["hash"] != make([(1, "2"), (2, "-,")])["hash"]


def test_lead_positions_equal_bisection(spark):
    rnd = random.Random(1)
    leads = {g: sorted(rnd.sample(range(1, 46), rnd.randint(1, 20))) for g in range(6)}
    rows = [(g, k, rnd.choice([None, *range(-3, 60)])) for g in leads for k in range(60)]
    df = spark.createDataFrame(rows, "g int, k int, offset int")
    table = spark.createDataFrame([(g, x) for g, own in leads.items() for x in own + own[:1]], "g int, lead int")
    want = {}
    for g, k, off in rows:
        at = 1 if off is None else bisect.bisect_right(leads[g], off - 1) + 1
        want[g, k] = 9999 if at > len(leads[g]) else at
    assert {(r["g"], r["k"]): r["position"] for r in O.start_positions(df, table, ["g"]).collect()} == want
    lists = spark.createDataFrame(list(leads.items()), "g int, leads array<int>")
    got = df.join(lists, "g").select("g", "k", O.lead_position(F.col("leads"), F.col("offset")).alias("p")).collect()
    assert {(r["g"], r["k"]): r["p"] for r in got} == want


def test_nothing_left_is_an_error(spark):
    df = spark.range(3)
    assert R.require_rows(df.filter("id > 1"), "the member cap").count() == 1
    with pytest.raises(ValueError, match="member cap"):
        R.require_rows(df.filter("id > 5"), "the member cap")


def test_nearest_of_points_without_coordinates_and_far_ones(spark):
    nan = float("nan")
    points = spark.createDataFrame([(1, nan, 1.0), (2, None, 1.0), (3, 80.0, -170.0), (4, 0.2, 0.1), (5, 0.0, 0.5)], "k int, lat double, lon double")
    targets = spark.createDataFrame([(7, 0.0, 0.0), (8, 0.0, 1.0), (9, nan, 0.0), (10, None, None)], "t int, lat double, lon double")
    got = {r["k"]: (r["t"], r["gap"]) for r in R.nearest(points, targets, "k", "t").collect()}
    assert got == {1: (None, None), 2: (None, None), 3: (7, pytest.approx(80**2 + 170**2)), 4: (7, pytest.approx(0.05)), 5: (7, pytest.approx(0.25))}


def test_digits_of_a_fine_grid_and_their_precedence(spark):
    from pluvia.functions import ids as I

    grid = spark.createDataFrame([(10.0, 70.0), (10.0000002, 70.0), (10.5, 71.0)], "lat double, lon double")
    assert I.infer_digits(grid) == 7
    assert I.grid_ids(grid) == I.GridIds(7) and I.grid_ids(grid, digits=3, fixed=True) == I.GridIds(3, True, "explicit")
    assert I.grid_ids(grid, I.GridIds(2), 2) == I.GridIds(2)
    for wrong in ({"established": I.GridIds(2), "digits": 3}, {"fixed": True}, {"digits": 16}):
        with pytest.raises(ValueError):
            I.grid_ids(grid, **wrong)
    assert I.least_gap(spark.createDataFrame([(float(k * k),) for k in range(3, 200)] + [(None,)], "v double"), "v") == 7.0
