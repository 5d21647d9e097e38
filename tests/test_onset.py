import random

import pytest
from pyspark.sql import functions as F

from pluvia.functions import arrays as A
from pluvia.operators import onset as O
from pluvia.plans import queries as Q

RULES = [
    O.OnsetRule(window=2, min_dry_days=3, follow_days=6),
    O.OnsetRule(window=3, min_dry_days=4, follow_days=0),
    O.OnsetRule(window=2, min_dry_days=3, follow_days=8, followup_anchor="onset_day", reject_if_short_followup=True),
    O.OnsetRule(window=3, trigger_rule="first_day_wet", wet_day_comparison="gt", min_dry_days=2, follow_days=5, dry_day_min_mm=0.5),
    O.OnsetRule(window=2, mode="window_sum", sum_window=4, sum_min_mm=6.0, follow_days=9),
    O.OnsetRule(window=2, mode="window_sum", sum_window=5, sum_min_mm=6.0, follow_days=3),
    O.OnsetRule(window=2, mode="window_sum", sum_window=3, sum_min_mm=4.0, follow_days=5, followup_anchor="onset_day", reject_if_short_followup=True),
]


def brute(x, threshold, rule, start=1):
    n = len(x)
    day = lambda i: x[i - 1] if 1 <= i <= n else None
    wet = lambda i: day(i) is not None and (day(i) >= rule.wet_day_min_mm if rule.wet_day_comparison == "gte" else day(i) > rule.wet_day_min_mm)
    dry = lambda i: day(i) is not None and day(i) < rule.dry_below
    for d in range(max(1, start), n - rule.window + 2):
        span = range(d, d + rule.window)
        if day(d) is None or not (all(map(wet, span)) if rule.trigger_rule == "all_days_wet" else wet(d)):
            continue
        if not sum(day(i) or 0 for i in span) > threshold:
            continue
        after = rule.followup_anchor == "after_trigger"
        low, end = (d + rule.window, d + rule.window - 1 + rule.follow_days) if after else (d, d + rule.follow_days)
        if end > n:
            if rule.reject_if_short_followup:
                continue
            end = n
        if rule.mode == "consecutive_dry":
            k = rule.min_dry_days
            bad = any(not dry(i - 1) and all(dry(j) for j in range(i, i + k)) for i in range(low, end + 1))
        else:
            k = rule.sum_window
            bad = any(all(day(j) is not None for j in range(i, i + k)) and sum(day(j) for j in range(i, i + k)) < rule.sum_min_mm for i in range(low, end - k + 2))
        if not bad:
            return d
    return None


@pytest.mark.parametrize("rule", RULES)
def test_both_forms_equal_brute_force(spark, rule):
    rnd = random.Random(str(rule))
    series = [[rnd.choice([None, 0.0, 0.0, 0.4, 1.0, 2.0, 5.0, 9.0]) for _ in range(rnd.choice([1, 2, 12, 40]))] for _ in range(60)]
    start = [rnd.choice([1, 1, 5, 30, 9999]) for _ in series]
    expected = {k: brute(x, 4.0, rule, s) for k, (x, s) in enumerate(zip(series, start))}
    table = spark.createDataFrame([(k, x, s) for k, (x, s) in enumerate(zip(series, start))], "id int, rain array<double>, start int")
    by_array = {r["id"]: r["o"] for r in table.select("id", O.onset_of_array(F.col("rain"), F.lit(4.0), rule, F.col("start")).alias("o")).collect()}
    rows = table.select("id", "start", F.posexplode("rain").alias("d", "x")).withColumn("d", F.col("d") + 1).withColumn("threshold", F.lit(4.0))
    hits = O.candidates(rows, rule, ["id"]).groupBy("id").agg(F.min(F.when(F.col("ok") & (F.col("d") >= F.col("start")), F.col("d"))).alias("o"))
    by_window = {r["id"]: r["o"] for r in hits.collect()}
    assert by_array == expected
    assert by_window == expected


def test_missing_threshold_and_bad_rules(spark):
    one = spark.range(1).select(O.onset_of_array(F.array(*[F.lit(9.0)] * 9), F.lit(None).cast("double"), RULES[0]).alias("o"))
    assert one.first()["o"] is None
    for bad in ({"mode": "x"}, {"trigger_rule": "x"}, {"wet_day_comparison": "x"}, {"followup_anchor": "x"}, {"window": 0}):
        with pytest.raises(ValueError):
            O.OnsetRule(**bad)


def test_statistics_within_a_row_equal_grouped_ones(spark):
    nan, rnd = float("nan"), random.Random(3)
    data = [[[1.0, None, 3.0], [2.0, None], [0.5, None, None]], [[None, None], [None, None]], [[4.0]], [None, [2.0, 1.5]], [[nan, 1.0], [2.0, 0.0]], [None], [[]], []]
    data += [[[rnd.choice([None, 0.0, 1.0, rnd.uniform(0, 30)]) for _ in range(6)] for _ in range(rnd.randint(1, 7))] for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(data)), "id int, members array<array<double>>")
    long = rows.select("id", F.explode("members").alias("a")).select("id", F.posexplode("a").alias("lead", "x"))
    plain = lambda v: None if v is None else "nan" if v != v else pytest.approx(v, abs=1e-9)
    want = {(r["id"], r["lead"]): [plain(v) for v in r[2:]] for r in O.ensemble_stats(long, ["id", "lead"]).collect()}
    got = {(r["id"], r["lead"]): ["nan" if v is not None and v != v else v for v in r["v"]] for r in rows.select("id", F.posexplode(O.member_stats(F.col("members"))).alias("lead", "v")).collect()}
    assert got == want and len(want) > 300


@pytest.mark.parametrize("name", ["ensemble_rain_stats", "ensemble_rain_stats_all"])
def test_leads_are_not_grouped_once_exploded(spark, sf, name):
    above = Q.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString().split("Generate posexplode")
    assert len(above) == 2 and not any(node in above[0] for node in ("Aggregate", "Window", "Join"))


def test_week_bins_group_no_leads(spark, sf):
    above = Q.week_bins(spark, sf)._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")
    assert len(above) > 1 and not any(node in above[0] for node in ("Aggregate", "Window", "Join", "posexplode"))


def test_sums_by_position(spark):
    data = [[[1.0, None, None], [2.0, 4.0, None], [0.5]], [None, [1.0]], [[]], [], None]
    rows = spark.createDataFrame(list(enumerate(data)), "id int, a array<array<double>>")
    got = {r["id"]: r["s"] for r in rows.select("id", A.sum_by_position(F.col("a")).alias("s")).collect()}
    assert got == {0: [3.5, 4.0, None], 1: [1.0], 2: None, 3: None, 4: None}
