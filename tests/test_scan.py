import random

import pytest

from pluvia.operators import metrics as M
from pluvia.operators import scan as S


def test_prefix_sums_of_a_hot_key(spark):
    rnd = random.Random(4)
    rows = [(None if k % 5 == 4 else min(k % 5, 1), k, rnd.choice([None, 1.0, 2.5, -1.0])) for k in rnd.sample(range(5000), 5000)]
    got = S.prefix_sums(spark.createDataFrame(rows, "g int, at int, v double"), ["g"], ["at"], ["v"], parts=7)
    want, run = {}, {}
    for g, at, v in sorted(rows, key=lambda r: r[1]):
        want[at] = run.get(g, 0.0)
        run[g] = run.get(g, 0.0) + (v or 0.0)
    out = got.collect()
    assert len(out) == 5000 and all(r["v_below"] == want[r["at"]] and r["v_all"] == run[r["g"]] for r in out)
    placed = spark.createDataFrame(rows, "g int, at int, v double").repartitionByRange(7, "g", "at").rdd.glom().map(len).collect()
    assert max(placed) < 2 * 5000 / 7


def test_rank_scores_equal_all_pairs(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice("ab"), rnd.randint(0, 20) / 10, rnd.randint(0, 1)) for _ in range(400)] + [("one class", 0.5, 1)] * 3
    got = {r["g"]: r for r in M.rank_scores(M.levels(spark.createDataFrame(rows, "g string, score double, label int"), ["g"]), ["g"]).collect()}
    for g in "ab":
        pos, neg = ([s for h, s, y in rows if h == g and y == c] for c in (1, 0))
        wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
        gap = max(abs(sum(p <= t for p in pos) / len(pos) - sum(n <= t for n in neg) / len(neg)) for t in {s for h, s, _ in rows if h == g})
        assert got[g]["auc"] == pytest.approx(wins / len(pos) / len(neg)) and got[g]["pietra"] == pytest.approx(gap)
    assert got["one class"]["auc"] is None and got["one class"]["pietra"] is None


def test_no_scores(spark):
    assert M.cell_and_pooled(spark.createDataFrame([], "id int, p array<double>, y int"), 3).count() == 0
