"""The blend from daily rain to the exported table, and the queries of its builders, checks and evaluation."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import ids as I
from ..operators import checks as K
from ..operators import climatology as C
from ..operators import coverage as V
from ..operators import evaluation as E
from ..operators import export as X
from ..operators import metrics as M
from ..operators import onset as O
from ..operators import relations as R
from ..sources import grids as S
from . import queries as Q
from . import tables as T
from .queries import query

WEEKS, HORIZON = 4, 28

# Distribution function of unit id at t, by interpolation on the grid; q has id and t.
_F = "(SELECT q.*, CASE WHEN (q.t - x.lo) / x.step <= 0 THEN l.c WHEN (q.t - x.lo) / x.step >= 511 THEN h.c ELSE x.c + ((q.t - x.lo) / x.step - x.i) * (y.c - x.c) END AS f FROM q JOIN fit ON fit.id = q.id JOIN cdf x ON x.id = q.id AND x.i = least(510, greatest(0, floor((q.t - fit.lo) / fit.step)::INT)) JOIN cdf y ON y.id = q.id AND y.i = x.i + 1 JOIN cdf l ON l.id = q.id AND l.i = 0 JOIN cdf h ON h.id = q.id AND h.i = 511)"
_CLIM = "fit AS (SELECT DISTINCT id, lo, step FROM cdf)"


@query(f"""WITH {Q._KDE_SQL}, {_CLIM}, dates AS (SELECT CAST(y AS INT) AS year, CAST(unnest(range(make_date(y, 5, 1), make_date(y, 7, 1), INTERVAL 1 DAY)) AS DATE) AS time FROM (SELECT unnest(range(1995, 2002)) AS y)),
issue AS (SELECT DISTINCT (time - make_date(year, 5, 1))::INT AS d0 FROM dates), q AS (SELECT id, d0, w, d0 + 7 * w AS t FROM fit, issue, (SELECT unnest(range(0, 5)) AS w)), pts AS {_F},
wide AS (SELECT id, d0, max(f) FILTER (w = 0) AS f0, max(f) FILTER (w = 1) AS f1, max(f) FILTER (w = 2) AS f2, max(f) FILTER (w = 3) AS f3, max(f) FILTER (w = 4) AS f4 FROM pts GROUP BY id, d0),
s AS (SELECT *, CASE WHEN 1 - f0 <= 1e-12 THEN 1 ELSE 1 - f0 END AS lft FROM wide)
SELECT id, year, time, s.d0, CASE WHEN strftime(time, '%m') = '05' THEN 28 ELSE 21 END AS horizon, round(f0, 8) AS p_day0, round((f1 - f0) / lft, 8) AS week1, round((f2 - f1) / lft, 8) AS week2, round((f3 - f2) / lft, 8) AS week3, round((f4 - f3) / lft, 8) AS week4
FROM s JOIN dates ON (time - make_date(year, 5, 1))::INT = s.d0""")
def climatology_issue_grid(spark, sf):
    """M22, M23, J22, K-4, K-6: every unit's conditional chances at every issue date of May and June of all years."""
    grid = C.issue_grid(spark, 1995, 2001, "05-01", "06-30", [("05-01", "05-31", 28), ("06-01", "06-30", 21)])
    samples = C.training_samples(T.onset_samples(spark, sf), 1995, 2001)
    rows = C.issue_probabilities(C.fit_kde(samples, ["id"]), grid, HORIZON, low=0.0)
    weeks = A.bin_sums(F.col("p_cond"), WEEKS)
    rows = rows.withColumn("w", weeks)
    return rows.select("id", "year", "time", "d0", "horizon", F.round("p_day0", 8).alias("p_day0"), *[F.round(F.get("w", F.lit(k)), 8).alias(f"week{k + 1}") for k in range(WEEKS)])


_B, _W, _V = (0.2, 0.1, 0.0, -0.1, 0.3), 0.6, 0.4


def blended(spark, sf, own_year: bool = True):
    """id, year, issue, time, p, clim: from daily rain to the blend's bins.

    Members' onsets give shares by lead and week; the onsets of the record give the conditional climatology of the unit's
    nation at the issue date, with or without those of the predicted year; both meet in one table and given coefficients
    blend their logits."""
    members = T.forecasts(spark, sf).withColumn("onset", O.onset_of_array(F.col("rain"), F.lit(40.0), Q.FORECAST))
    forecast = O.onset_probabilities(members, ["id", "year", "issue"], ["onset"], HORIZON, rain="rain")
    forecast = forecast.select("id", "year", "issue", E.raw_bins(A.bin_sums(F.col("p_onset"), WEEKS)).alias("forecast"))
    dates = C.issue_grid(spark, T.YEARS[0], T.YEARS[-1], "05-01", "07-31", HORIZON).withColumn("issue", F.col("d0") + 1).filter(F.col("issue").isin(*T.ISSUES))
    samples = T.onset_samples(spark, sf)
    if own_year:
        fits = C.fit_kde(samples, ["id"])
    else:
        every = spark.range(T.YEARS[0], T.YEARS[-1] + 1).select(F.col("id").cast("int").alias("test_year"))
        fits = C.fit_counted(C.left_out_samples(samples, every), ["id", "test_year"])
    clim = C.issue_probabilities(fits, dates, HORIZON, low=0.0)
    clim = (clim if own_year else clim.filter("year = test_year")).select(F.col("id").alias("nation"), "year", (F.col("d0") + 1).alias("issue"), "time", E.raw_bins(A.bin_sums(F.col("p_cond"), WEEKS)).alias("clim"))
    units = T.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    both = R.combine([forecast.join(units, "id"), clim], ["nation", "year", "issue"])
    z = F.zip_with(F.zip_with("forecast", "clim", lambda a, b: _W * A.logit_winsor(a) + _V * A.logit_winsor(b)), F.array(*[F.lit(b) for b in _B]), lambda a, b: a + b)
    return both.select("id", "year", "issue", "time", "clim", A.softmax(z).alias("p"))


_BIN = "least(greatest({x}, 1e-4), 1 - 1e-4)"
_LOGIT = lambda x: f"ln({_BIN.format(x=x)} / (1 - {_BIN.format(x=x)}))"


@query(f"""WITH {T.FORECASTS}, {Q._KDE_SQL[len(T.SEASON) + 2:]}, {_CLIM}, {Q.onset_sql(Q.FORECAST, 'forecasts', 'id, year, issue, number', '40')},
fw AS (SELECT id, year, issue, w, sum(CASE WHEN onset_idx BETWEEN 7 * w - 6 AND 7 * w THEN 1 ELSE 0 END) / count(*) AS v FROM found, (SELECT unnest(range(1, 5)) AS w) GROUP BY ALL),
fb AS (SELECT * FROM fw UNION ALL SELECT id, year, issue, 5, least(greatest(1 - sum(v), 0), 1) FROM fw GROUP BY ALL),
q AS (SELECT fit.id, issue, w, issue - 1 + 7 * w AS t FROM fit, issues, (SELECT unnest(range(0, 5)) AS w)), pts AS {_F},
cw AS (SELECT b.id AS nation, b.issue, b.w, (b.f - a.f) / CASE WHEN 1 - z.f <= 1e-12 THEN 1 ELSE 1 - z.f END AS v FROM pts a JOIN pts b ON b.id = a.id AND b.issue = a.issue AND b.w = a.w + 1 JOIN pts z ON z.id = a.id AND z.issue = a.issue AND z.w = 0),
cb AS (SELECT * FROM cw UNION ALL SELECT nation, issue, 5, least(greatest(1 - sum(v), 0), 1) FROM cw GROUP BY ALL),
z AS (SELECT fb.id, fb.year, fb.issue, fb.w, cb.v AS c, exp({list(_B)}[fb.w] + {_W} * {_LOGIT('fb.v')} + {_V} * {_LOGIT('cb.v')}) AS e FROM fb JOIN supplier ON s_suppkey = fb.id JOIN cb ON cb.nation = s_nationkey AND cb.issue = fb.issue AND cb.w = fb.w),
p AS (SELECT *, e / sum(e) OVER (PARTITION BY id, year, issue) AS v FROM z)
SELECT id, strftime(make_date(year, 5, 1) + CAST(issue - 1 AS INT), '%-m/%-d/%y') AS time, {', '.join(f"round(max(v) FILTER (w = {k}), 7) AS {n}, round(max(c) FILTER (w = {k}), 7) AS clim_{n}" for k, n in enumerate(('week1', 'week2', 'week3', 'week4', 'later'), 1))} FROM p GROUP BY id, year, issue""")
def blend_export(spark, sf):
    """The minimum run from start to end, as the export with all its columns."""
    out = X.summary(blended(spark, sf), WEEKS)
    return out.select("id", "time", *[F.round(c, 7).alias(c) for c in out.columns if c not in ("id", "time")])


_LEFT_OUT = T.SAMPLES[len(T.SEASON) + 2:] + ", left_out AS (SELECT s.id * 10000 + y.year AS id, onset_day FROM samples s, years y WHERE s.year <> y.year)" + Q._KDE_SQL[len(T.SAMPLES):].replace("samples", "left_out")


@query(f"""WITH {T.FORECASTS}, {_LEFT_OUT}, {_CLIM}, {Q.onset_sql(Q.FORECAST, 'forecasts', 'id, year, issue, number', '40')},
fw AS (SELECT id, year, issue, w, sum(CASE WHEN onset_idx BETWEEN 7 * w - 6 AND 7 * w THEN 1 ELSE 0 END) / count(*) AS v FROM found, (SELECT unnest(range(1, 5)) AS w) GROUP BY ALL),
fb AS (SELECT * FROM fw UNION ALL SELECT id, year, issue, 5, least(greatest(1 - sum(v), 0), 1) FROM fw GROUP BY ALL),
q AS (SELECT fit.id, issue, w, issue - 1 + 7 * w AS t FROM fit, issues, (SELECT unnest(range(0, 5)) AS w)), pts AS {_F},
cw AS (SELECT b.id // 10000 AS nation, b.id % 10000 AS year, b.issue, b.w, (b.f - a.f) / CASE WHEN 1 - z.f <= 1e-12 THEN 1 ELSE 1 - z.f END AS v FROM pts a JOIN pts b ON b.id = a.id AND b.issue = a.issue AND b.w = a.w + 1 JOIN pts z ON z.id = a.id AND z.issue = a.issue AND z.w = 0),
cb AS (SELECT * FROM cw UNION ALL SELECT nation, year, issue, 5, least(greatest(1 - sum(v), 0), 1) FROM cw GROUP BY ALL),
z AS (SELECT fb.id, fb.year, fb.issue, fb.w, cb.v AS c, exp({list(_B)}[fb.w] + {_W} * {_LOGIT('fb.v')} + {_V} * {_LOGIT('cb.v')}) AS e FROM fb JOIN supplier ON s_suppkey = fb.id JOIN cb ON cb.nation = s_nationkey AND cb.year = fb.year AND cb.issue = fb.issue AND cb.w = fb.w),
p AS (SELECT *, e / sum(e) OVER (PARTITION BY id, year, issue) AS v FROM z)
SELECT id, strftime(make_date(year, 5, 1) + CAST(issue - 1 AS INT), '%-m/%-d/%y') AS time, {', '.join(f"round(max(v) FILTER (w = {k}), 7) AS {n}, round(max(c) FILTER (w = {k}), 7) AS clim_{n}" for k, n in enumerate(('week1', 'week2', 'week3', 'week4', 'later'), 1))} FROM p GROUP BY id, year, issue""")
def blend_export_left_out(spark, sf):
    """K-5, J11: as blend_export, the climatology of each season being made without its own onsets."""
    out = X.summary(blended(spark, sf, own_year=False), WEEKS)
    return out.select("id", "time", *[F.round(c, 7).alias(c) for c in out.columns if c not in ("id", "time")])


@query(f"WITH {Q._CELL_SQL}, t AS (SELECT n_nationkey AS t, 5.3::DOUBLE + n_nationkey AS lat, 65.4::DOUBLE + (n_nationkey * 11 % 30) AS lon FROM nation) SELECT c.id, arg_min(t, ((c.lat - t.lat) * (c.lat - t.lat) + (c.lon - t.lon) * (c.lon - t.lon)) * 1e6 + t) AS t, round(min((c.lat - t.lat) * (c.lat - t.lat) + (c.lon - t.lon) * (c.lon - t.lon)), 8) AS gap FROM cells c, t GROUP BY c.id")
def nearest_cell_all(spark, sf):
    """Nearest of all targets, found from small cells on."""
    n = F.col("n_nationkey")
    targets = T.table(spark, sf, "nation").select(n.alias("t"), (5.3 + n).alias("lat"), (65.4 + n * 11 % 30).alias("lon"))
    return R.nearest(Q._cells(spark, sf), targets, "id", "t", cell=0.5).withColumn("gap", F.round("gap", 8))


@query(f"WITH {T.PROBS}, x AS (SELECT k, sum(p) FILTER (bin BETWEEN 2 AND 4) AS s, max(p) FILTER (bin = 1) AS e, list(p ORDER BY bin) AS a FROM probs GROUP BY k), b AS (SELECT k, a, e, least(greatest(1 - s, 0), 1) AS raw, least(greatest(1 - e / 2 - s, 0), 1) AS later, e / 2 + s + least(greatest(1 - e / 2 - s, 0), 1) AS t FROM x) SELECT k, round(raw, 9) AS raw_later, round(e / 2 / t, 9) AS earlier, round(a[2] / t, 9) AS week1, round(a[3] / t, 9) AS week2, round(a[4] / t, 9) AS week3, round(later / t, 9) AS later FROM b")
def baseline_bins(spark, sf):
    """Bins of a baseline from its weeks, and from logits with the bin before them."""
    weeks = F.slice("p", 2, 3)
    logits = F.transform(weeks, lambda x: F.log(x / (1 - x)))
    rows = T.probabilities(spark, sf).select("k", E.raw_bins(weeks).alias("raw"), E.logit_bins(logits, F.get("p", F.lit(0)) / 2, earlier_is_logit=False).alias("b"))
    return rows.select("k", F.round(F.get("raw", F.lit(3)), 9).alias("raw_later"), *[F.round(F.get("b", F.lit(i)), 9).alias(n) for i, n in enumerate(("earlier", "week1", "week2", "week3", "later"))])


@query(f"WITH {T.PROBS}, b AS (SELECT k, y, bin, p * 0.8 AS v FROM probs UNION ALL SELECT k, y, 0, greatest(0, 1 - sum(p * 0.8)) FROM probs GROUP BY k, y), n AS (SELECT k, y, bin, v / sum(v) OVER (PARTITION BY k) AS v FROM b), c AS (SELECT k, y, bin, sum(v) OVER (PARTITION BY k ORDER BY bin) AS s FROM n) SELECT k, round(sum(pow(s - CASE WHEN bin >= y THEN 1 ELSE 0 END, 2)), 9) AS rps FROM c GROUP BY k")
def season_rps(spark, sf):
    """RPS of every row over earlier, the weeks and later."""
    rows = T.probabilities(spark, sf).withColumn("b", E.with_earlier(F.transform("p", lambda x: x * 0.8)))
    return rows.select("k", F.round(E.row_rps(F.col("b"), F.col("y") + 1), 9).alias("rps"))


@query("""WITH c AS (SELECT o_orderkey AS k, o_orderkey % 9 AS n, o_orderkey % 5 AS hole FROM orders)
SELECT k, CASE WHEN n < 6 THEN 'too short' WHEN n > 6 THEN 'too long' ELSE 'missing value' END AS problem FROM c WHERE n <> 6 OR hole = 2""")
def horizon_problems(spark, sf):
    """Rows whose rain array breaks an exact horizon."""
    days, policy = K.horizon_policy(28, rain_day_max=6)
    k = F.col("o_orderkey")
    rain = F.when(k % 9 > 0, F.transform(F.sequence(F.lit(1), k % 9), lambda i: F.when((k % 5 != 2) | (i != 3), i.cast("double"))))
    return K.horizon_gaps(T.table(spark, sf, "orders").select(k.alias("k"), rain.alias("rain")), "rain", days, policy).select("k", "problem")


@query("SELECT 'a' AS \"column\", count(*) FILTER (l_linenumber % 3 <> 0) AS n_finite FROM lineitem UNION ALL SELECT 'b', 0 UNION ALL SELECT 'c', count(*) FROM lineitem")
def feature_support(spark, sf):
    """finite values of each predictor."""
    rows = T.table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity")).alias("a"), F.lit(float("nan")).alias("b"), F.col("l_linenumber").alias("c"))
    return K.feature_support(rows, ["a", "b", "c"])


@query("""WITH m AS (SELECT o_custkey AS period, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 1 WHEN '2' THEN 2 ELSE 0 END AS r, CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'one' ELSE substr(o_orderpriority, 1, 1) END AS model, o_orderkey AS k, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS x FROM orders),
d AS (SELECT model, period, r, max(k) AS k, max(x) AS x FROM m GROUP BY ALL) SELECT model, period, arg_min(k, r) AS k, arg_min(x, r) FILTER (x IS NOT NULL) AS x FROM d GROUP BY model, period""")
def harmonised_variants(spark, sf):
    """Variants of a model as one, each column from the first variant that has it."""
    rows = T.table(spark, sf, "orders").select(F.substring("o_orderpriority", 1, 1).alias("model"), F.col("o_custkey").alias("period"), F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("x"))
    one = rows.groupBy("model", "period").agg(F.max("k").alias("k"), F.max("x").alias("x"))
    return E.harmonise(one, {"1": 1, "2": 2}, "one")


@query(f"WITH {T.SEASON}, {Q.onset_sql(Q.MAIN, 'season', 'id, year', '50')}, a AS (SELECT * FROM found WHERE year = 1996), b AS (SELECT * FROM found WHERE year = 1997) SELECT a.id, a.onset_idx AS onset_idx_x, b.onset_idx AS onset_idx_y, a.onset_idx - b.onset_idx AS difference FROM a JOIN b ON b.id = a.id")
def onset_differences(spark, sf):
    """Two seasons' onsets side by side."""
    found = Q.onset_consecutive_dry(spark, sf)
    return E.differences(found.filter("year = 1996"), found.filter("year = 1997"), "id", "onset_idx")


@query(f"WITH {Q._ROWS}, flat AS (SELECT year, p AS s, label FROM probs), a AS {Q._auc_sql('flat', 'year')} SELECT year, n, brier, fair_brier, rps, round(auc, 7) AS auc FROM (SELECT year, count(*) AS n, round(avg(b), 9) AS brier, round(avg(b - f), 9) AS fair_brier, round(avg(r), 9) AS rps FROM rows GROUP BY year) JOIN a USING (year)")
def yearly_metrics_all(spark, sf):
    """As yearly_metrics, with the AUC."""
    out = M.scores(T.probabilities(spark, sf), ["year"], T.BINS)
    return out.select("year", "n", *[F.round(c, 9).alias(c) for c in ("brier", "fair_brier", "rps")], F.round("auc", 7).alias("auc"))


@query(f"""WITH {Q._ROWS}, pairs AS (SELECT CAST(id AS VARCHAR) AS cell, b, r, f FROM rows UNION ALL SELECT 'ALL', b, r, f FROM rows),
flat AS (SELECT CAST(id AS VARCHAR) AS cell, round(p, 12) AS s, label FROM probs UNION ALL SELECT 'ALL', round(p, 12), label FROM probs), a AS {Q._auc_sql('flat', 'cell')},
t AS (SELECT s, sum(label) AS pos, sum(1 - label) AS neg FROM flat WHERE cell = 'ALL' GROUP BY s), ks AS (SELECT 'ALL' AS cell, max(abs(cp / tp - cn / tn)) AS pietra FROM (SELECT sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn FROM t WINDOW w AS (ORDER BY s)))
SELECT cell, n, brier, fair_brier, rps, round(auc, 7) AS auc, round(pietra, 7) AS pietra FROM (SELECT cell, count(*) AS n, round(avg(b), 9) AS brier, round(avg(b - f), 9) AS fair_brier, round(avg(r), 9) AS rps FROM pairs GROUP BY cell) JOIN a USING (cell) LEFT JOIN ks USING (cell)""")
def cell_and_pooled_metrics_all(spark, sf):
    """As cell_and_pooled_metrics, with the fair Brier score and the pooled Pietra statistic."""
    rows = T.probabilities(spark, sf).withColumn("p", F.transform("p", lambda x: F.round(x, 12)))
    out = M.cell_and_pooled(rows, T.BINS)
    return out.select("cell", "n", *[F.round(c, 9).alias(c) for c in ("brier", "fair_brier", "rps")], F.round("auc", 7).alias("auc"), F.round("pietra", 7).alias("pietra"))


@query(f"""WITH {T.PROBS}, flat AS (SELECT bin, round(p, 12) AS s, p, label FROM probs), a AS {Q._auc_sql('flat', 'bin')}, b AS (SELECT bin, avg(pow(s - label, 2)) AS brier FROM flat GROUP BY bin)
SELECT 'ALL' AS cell, {', '.join(f"round(max(brier) FILTER (bin = {k}), 9) AS brier_bin{k}, round(max(auc) FILTER (bin = {k}), 7) AS auc_bin{k}" for k in range(1, T.BINS + 1))} FROM b JOIN a USING (bin)""")
def pooled_bin_metrics(spark, sf):
    """The pooled row's columns of single bins."""
    rows = T.probabilities(spark, sf).withColumn("p", F.transform("p", lambda x: F.round(x, 12)))
    out = M.cell_and_pooled(rows, T.BINS).filter("cell = 'ALL'")
    return out.select("cell", *[F.round(f"{c}_bin{k}", n).alias(f"{c}_bin{k}") for c, n in (("brier", 9), ("auc", 7)) for k in range(1, T.BINS + 1)])


@query(f"""WITH {T.PROBS}, l AS (SELECT k, bin, 'p' AS model, round(p, 12) AS v, label FROM probs UNION ALL SELECT k, bin, 'q', round(q, 12), label FROM probs), cum AS (SELECT *, sum(v - label) OVER (PARTITION BY model, k ORDER BY bin) AS c FROM l),
m AS (SELECT model, sum(pow(v - label, 2)) / count(DISTINCT k) AS brier, sum(c * c) / count(DISTINCT k) AS rps FROM cum GROUP BY model), f AS (SELECT model, v AS s, label FROM l), a AS {Q._auc_sql('f', 'model')}
SELECT model, round(1 - brier / (SELECT brier FROM m WHERE model = 'q'), 8) AS brier_skill, round(1 - rps / (SELECT rps FROM m WHERE model = 'q'), 8) AS rps_skill, round((auc - (SELECT auc FROM a WHERE model = 'q')) * 100, 5) AS auc_points FROM m JOIN a USING (model)""")
def skill_vs_baseline_all(spark, sf):
    """As skill_vs_baseline, with the AUC points."""
    rounded = lambda c: F.transform(c, lambda x: F.round(x, 12))
    rows = T.probabilities(spark, sf).select("k", "y", F.explode(F.create_map(F.lit("p"), rounded("p"), F.lit("q"), rounded("q"))).alias("model", "p"))
    out = M.skill(M.scores(rows, ["model"], T.BINS), "q")
    return out.select("model", *[F.round(c, n).alias(c) for c, n in (("brier_skill", 8), ("rps_skill", 8), ("auc_points", 5))])


_SPARSE = """u AS (SELECT s_suppkey AS id, issue, 33 - issue AS cutoff, CASE WHEN s_suppkey % 6 <> 0 THEN 15 + s_suppkey % 5 * 7 - issue END AS ref FROM supplier, (SELECT unnest([1, 31, 61]) AS issue)),
l AS (SELECT s_suppkey AS id, lead FROM supplier, (SELECT unnest(range(1, 46)) AS lead) WHERE (lead * 5 + s_suppkey) % 4 <> 0 AND lead <= 20 + s_suppkey % 26)"""


@query(f"""WITH {_SPARSE}, c AS (SELECT u.id, u.issue, ref, count(*) AS n, count(*) FILTER (lead < cutoff) AS a, count(*) FILTER (lead < ref) AS b FROM u JOIN l USING (id) GROUP BY u.id, u.issue, ref)
SELECT id, issue, CASE WHEN a < n THEN a + 1 ELSE 9999 END AS fixed_start, CASE WHEN ref IS NULL THEN 1 WHEN b < n THEN b + 1 ELSE 9999 END AS ref_start FROM c""")
def sparse_lead_starts(spark, sf):
    """Start positions among leads with gaps, for a fixed cutoff (in the row) and a reference date (a table of leads)."""
    unit, lead = F.col("s_suppkey").alias("id"), F.col("lead")
    rows = T.table(spark, sf, "supplier").select(unit, F.explode(F.array(*[F.lit(i) for i in T.ISSUES])).alias("issue"))
    leads = T.table(spark, sf, "supplier").select(unit, F.explode(F.sequence(F.lit(1), F.lit(45))).alias("lead")).filter(((lead * 5 + F.col("id")) % 4 != 0) & (lead <= 20 + F.col("id") % 26))
    rows = rows.withColumn("offset", F.when(F.col("id") % 6 != 0, 15 + F.col("id") % 5 * 7 - F.col("issue")).cast("int"))
    listed = leads.groupBy("id").agg(F.sort_array(F.collect_list("lead")).alias("leads"))
    out = O.start_positions(rows, leads, ["id"]).join(listed, "id")
    return out.select("id", "issue", O.lead_position(F.col("leads"), F.lit(33) - F.col("issue")).alias("fixed_start"), F.col("position").alias("ref_start"))


_LIMB = " || '|' || ".join(f"sum(('0x' || substr(h, {8 * k + 1}, 8))::UBIGINT)::HUGEINT::VARCHAR" for k in range(8))
_VALUE = lambda c: f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


@query(f"""WITH h AS (SELECT sha256({" || ',' || ".join(_VALUE(c) for c in ('o_clerk_no', 'o_custkey', 'o_day', 'o_orderkey', 'o_orderpriority'))}) AS h FROM (
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS o_day, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey % 7 END AS o_clerk_no FROM orders))
SELECT count(*) AS n_rows, sha256('o_clerk_no,o_custkey,o_day,o_orderkey,o_orderpriority|' || {_LIMB}) AS hash FROM h""")
def table_multiset_hash(spark, sf):
    """Order-free hash of all rows of a table."""
    o = T.table(spark, sf, "orders")
    return R.multiset_fingerprint(o.select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("o_day"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 7).alias("o_clerk_no")))


@query("SELECT DISTINCT c_nationkey AS id FROM customer INTERSECT SELECT DISTINCT s_nationkey FROM supplier WHERE s_suppkey % 3 = 0")
def shared_ids(spark, sf):
    """Ids of both tables."""
    return R.shared_ids(T.table(spark, sf, "customer").select(F.col("c_nationkey").alias("id")), T.table(spark, sf, "supplier").filter("s_suppkey % 3 = 0").select(F.col("s_nationkey").alias("id")))


@query(f"WITH {T.SEASON}, {Q.onset_sql(Q.MAIN, 'season', 'id, year', '50')} SELECT id, year, count(*) AS n, sum(x) AS total FROM season JOIN found USING (id, year) WHERE d < onset_idx GROUP BY id, year")
def before_onset(spark, sf):
    """days strictly before the onset; seasons without one leave."""
    return R.before_onset(T.season(spark, sf), Q.onset_consecutive_dry(spark, sf), ["id", "year"]).groupBy("id", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"))


@query("""SELECT o_orderkey AS k, o_custkey AS id, a.balance, b.parts FROM orders LEFT JOIN (SELECT * FROM (SELECT c_custkey AS id, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0) FULL JOIN (SELECT s_suppkey AS id, s_nationkey AS parts FROM supplier) USING (id)) b ON b.id = o_custkey LEFT JOIN (SELECT c_custkey AS id, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0) a ON a.id = o_custkey""")
def constants_join(spark, sf):
    """Constant tables meet in full, then join the rows."""
    c = T.table(spark, sf, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"))
    s = T.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("parts"))
    return R.join_constants(T.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("id")), [c, s]).select("k", "id", "balance", "parts")


@query("""WITH m AS (SELECT o_custkey AS id, substr(o_orderpriority, 1, 1) AS model, max(o_totalprice) AS score FROM orders GROUP BY ALL)
SELECT id, a.score AS score_x, b.score AS score_y, a.score - b.score AS difference FROM (SELECT * FROM m WHERE model = '1') a FULL JOIN (SELECT * FROM m WHERE model = '2') b USING (id)""")
def map_comparison(spark, sf):
    """Two models side by side for every unit of either."""
    m = T.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("id"), F.substring("o_orderpriority", 1, 1).alias("model")).agg(F.max("o_totalprice").alias("score"))
    return R.compare_models(m, "score", "1", "2")


@query("""SELECT 'u' AS predictor, count(*) AS n_rows, count(*) FILTER (l_linenumber % 3 = 0) AS n_missing FROM lineitem UNION ALL SELECT 'v', count(*), count(*) FILTER (l_quantity <= 5) FROM lineitem""")
def support_diagnostics(spark, sf):
    """missing values of each predictor."""
    rows = T.table(spark, sf, "lineitem").select(F.when(F.col("l_linenumber") % 3 != 0, 1).alias("u"), F.when(F.col("l_quantity") > 5, 1).alias("v"))
    return R.common_support(rows, ["u", "v"])[1]


@query(f"WITH {T.SEASON}, h AS (SELECT id, year, d, CASE WHEN id % 3 <> 0 THEN x WHEN (7 * d + id) % 31 <> 0 THEN x END AS x FROM season) SELECT year, count(*) AS n, sum(x) AS total FROM h WHERE (id, year) NOT IN (SELECT (id, year) FROM h WHERE x IS NULL) GROUP BY year")
def missing_policy_some(spark, sf):
    """Whole seasons, of which one unit in three has gaps."""
    rows = T.season(spark, sf).withColumn("x", F.when((F.col("id") % 3 != 0) | ((F.col("d") * 7 + F.col("id")) % 31 != 0), F.col("x")))
    return R.missing_policy(rows, "drop", ["id", "year"]).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("total"))


_SQUARES = f"""WITH {Q._BOX_SQL}, covered AS (SELECT DISTINCT s_suppkey % 14 AS a, s_suppkey * 5 % 17 AS b FROM supplier),
sq AS (SELECT target_id, south + (i + 0.5) * 0.025 AS y, west + (j + 0.5) * 0.025 AS x FROM (SELECT n_nationkey AS target_id, 5.0 + n_nationkey * 0.3 AS south, 65.0 + (n_nationkey % 5) * 1.4 AS west FROM nation), (SELECT unnest(range(0, 44)) AS i), (SELECT unnest(range(0, 92)) AS j)),
seen AS (SELECT target_id, y, x FROM sq WHERE EXISTS (SELECT 1 FROM covered WHERE a IN (floor((y - 5.0) / 0.5), ceil((y - 5.0) / 0.5)) AND b IN (floor((x - 65.0) / 0.5), ceil((x - 65.0) / 0.5)) AND abs(y - 5.0 - 0.5 * a) < 0.375 AND abs(x - 65.0 - 0.5 * b) < 0.375))"""


def _footprint(spark, sf):
    """Cells, units as rings, and boxes of another grid's valid cells, which overlap."""
    cells, units = Q._boxes(spark, sf)
    corner = lambda y, x: F.struct(F.col(y).alias("lat"), F.col(x).alias("lon"))
    rings = units.select("target_id", F.array(F.array(corner("south", "west"), corner("south", "east"), corner("north", "east"), corner("north", "west"))).alias("rings"))
    k = F.col("s_suppkey")
    valid = T.table(spark, sf, "supplier").select((5.0 + 0.5 * (k % 14)).alias("lat"), (65.0 + 0.5 * (k * 5 % 17)).alias("lon"))
    return cells, rings, V.cell_boxes(valid, 0.375, 0.375)


@query(f"""{_SQUARES}, c AS (SELECT target_id, source_id, count(*) AS n FROM seen JOIN cells ON cells.lat = 5.0 + 0.25 * round((y - 5.0) / 0.25) AND cells.lon = 65.0 + 0.25 * round((x - 65.0) / 0.25) GROUP BY ALL)
SELECT source_id, target_id, round(n / sum(n) OVER (PARTITION BY target_id), 8) AS weight FROM c""")
def coverage_weights(spark, sf):
    """Weights of a second grid within the first grid's valid cells."""
    cells, units, covered = _footprint(spark, sf)
    return V.weights_to_coverage(cells, 0.125, 0.125, units, covered)[0].withColumn("weight", F.round("weight", 8))


@query(f"{_SQUARES} SELECT n_nationkey AS target_id, round(1 - coalesce(c, 0) / 4048, 8) AS missing_frac FROM nation LEFT JOIN (SELECT target_id, count(*) AS c FROM seen GROUP BY 1) ON target_id = n_nationkey")
def coverage_missing(spark, sf):
    """Share of each unit outside of boxes that overlap."""
    _, units, covered = _footprint(spark, sf)
    return V.uncovered(units, covered, (1.0, 1.0)).select("target_id", F.round("missing_frac", 8).alias("missing_frac"))


def _grid_files(spark, sf):
    """Three seasons of the units' rain on a grid of one degree, a file a year in the shared folder."""
    days = T.season(spark, sf).filter("year BETWEEN 1995 AND 1997")
    time = F.date_add(F.make_date("year", F.lit(5), F.lit(1)), F.col("d") - 1)
    cells = days.select("year", time.alias("time"), (5.0 + F.col("id") % 30).alias("lat"), (65.0 + F.col("id") * 7 % 30).alias("lon"), "x")
    folder = f"{R.scratch(spark)}/grids-{uuid.uuid4().hex}"
    return S.scan(spark, [r["path"] for r in S.write_grids(cells.groupBy("year", "time", "lat", "lon").agg(F.sum("x").alias("rain")), folder, "rain").collect()])


_GRIDDED = f"WITH {T.SEASON}, g AS (SELECT make_date(year, 5, 1) + CAST(d - 1 AS INT) AS time, (5.0 + id % 30)::DOUBLE AS lat, (65.0 + id * 7 % 30)::DOUBLE AS lon, sum(x) AS rain FROM season WHERE year BETWEEN 1995 AND 1997 GROUP BY ALL)"


@query(f"{_GRIDDED} SELECT time, lat, lon, rain FROM g WHERE time BETWEEN '1995-07-10' AND '1996-06-20' AND lat >= 12")
def gridded_scan(spark, sf):
    """Gridded files written and scanned by slabs, with bounds on time and latitude pushed into the scan."""
    rows = _grid_files(spark, sf).filter((F.col("time") >= F.lit("1995-07-10").cast("date")) & (F.col("time") <= F.lit("1996-06-20").cast("date")) & (F.col("lat") >= 12.0))
    return rows.filter("rain IS NOT NULL").select("time", "lat", "lon", "rain")


@query(f"{_GRIDDED} SELECT lat, lon, min(time) AS start, count(*) AS n, sum(rain) AS total, max(rain) AS top FROM g WHERE time >= '1997-08-05' GROUP BY lat, lon")
def gridded_matrix(spark, sf):
    """Each cell's days from a cutoff on as an array."""
    m = S.matrix(_grid_files(spark, sf).filter(F.col("time") >= F.lit("1997-08-05").cast("date")), F.lit("1997-08-05").cast("date"))
    known = F.col("values")
    out = m.select("lat", "lon", "start", F.size(known).cast("long").alias("n"), A.total(known).alias("total"), F.array_max(known).alias("top"))
    return out.join(T.table(spark, sf, "supplier").select((5.0 + F.col("s_suppkey") % 30).alias("lat"), (65.0 + F.col("s_suppkey") * 7 % 30).alias("lon")).distinct(), ["lat", "lon"])


@query(f"""WITH {T.SEASON}, {Q._BOX_SQL}, g AS (
SELECT make_date(year, 5, 1) + CAST(d - 1 AS INT) AS time, 5.0 + id % 30 * 0.25 AS lat, 65.0 + id * 7 % 30 * 0.25 AS lon, 0.125 AS h, sum(x) AS x FROM season WHERE year = 1995 AND d <= 40 AND id % 2 = 0 GROUP BY ALL
UNION ALL SELECT make_date(year, 5, 1) + CAST(d - 1 AS INT), 5.0 + id % 15 * 0.5, 65.0 + id * 7 % 15 * 0.5, 0.25, sum(x) FROM season WHERE year = 1996 AND d <= 40 AND id % 2 = 1 GROUP BY ALL),
r AS (SELECT time, target_id, x, greatest(0, least(g.lat + h, north) - greatest(g.lat - h, south))::DOUBLE * greatest(0, least(g.lon + h, east) - greatest(g.lon - h, west))::DOUBLE AS a FROM g, units)
SELECT time, target_id, round(sum(a * x) / sum(a), 8) AS rain FROM r WHERE a > 1e-12 GROUP BY time, target_id""")
def regrid_files(spark, sf):
    """Files of two grids scanned and regridded to units in one run, with weights for each grid."""
    _, units = Q._boxes(spark, sf)
    corner = lambda y, x: F.struct(F.col(y).cast("double").alias("lat"), F.col(x).cast("double").alias("lon"))
    rings = units.select("target_id", F.array(F.array(corner("south", "west"), corner("south", "east"), corner("north", "east"), corner("north", "west"))).alias("rings"))
    paths, folder = [], f"{R.scratch(spark)}/grids-{uuid.uuid4().hex}"
    for year, odd, n, step in ((1995, 0, 30, 0.25), (1996, 1, 15, 0.5)):
        days = T.season(spark, sf).filter((F.col("year") == year) & (F.col("d") <= 40) & (F.col("id") % 2 == odd))
        time = F.date_add(F.make_date("year", F.lit(5), F.lit(1)), F.col("d") - 1)
        cells = days.groupBy("year", time.alias("time"), (5.0 + F.col("id") % n * step).alias("lat"), (65.0 + F.col("id") * 7 % n * step).alias("lon")).agg(F.sum("x").alias("rain"))
        axes = spark.range(n).select(F.lit(year).alias("year"), F.to_date(F.lit(f"{year}-05-01")).alias("time"), (5.0 + F.col("id") * step).alias("lat"), (65.0 + F.col("id") * step).alias("lon"), F.lit(None).cast("double").alias("rain"))
        whole = cells.unionByName(axes).groupBy("year", "time", "lat", "lon").agg(F.max("rain").alias("rain"))
        paths += [r["path"] for r in S.write_grids(whole, f"{folder}/{year}", "rain").collect()]
    out = S.regrid_by_grid(S.scan(spark, paths), rings).filter("rain IS NOT NULL")
    return out.select("time", "target_id", F.round("rain", 8).alias("rain"))


@query("""SELECT c_custkey AS id, c_name AS name, message FROM customer LEFT JOIN (SELECT o_custkey AS id, max(o_orderpriority) AS message FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1) m ON m.id = c_custkey""")
def message_join(spark, sf):
    """Every unit with its message; the messages' ids are padded text."""
    m = T.table(spark, sf, "orders").filter("o_orderkey % 3 = 0").groupBy(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("id")).agg(F.max("o_orderpriority").alias("message"))
    units = T.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return R.attach_messages(units, m)


@query(f"""WITH {T.FORECASTS}, f AS (SELECT make_date(year, 5, 1) + CAST(issue - 1 + d AS INT) AS time, d AS lead, number, (5.0 + id % 30)::DOUBLE AS lat, (65.0 + id * 7 % 30)::DOUBLE AS lon, x FROM forecasts WHERE year = 1996),
spot AS (SELECT lat, lon FROM (SELECT DISTINCT lat, lon FROM f) ORDER BY pow(lat - 12.3, 2) + pow(lon - 78.2, 2), lat, lon LIMIT 1), m AS (SELECT time, lead, number, avg(x) AS x FROM f JOIN spot USING (lat, lon) GROUP BY ALL), e AS (SELECT time, lead, avg(x) AS x FROM m GROUP BY ALL)
SELECT time, CAST(time - DATE '1996-05-10' AS INT) + 1 AS day, round(arg_min(x, lead), 9) AS x FROM e WHERE time >= DATE '1996-05-10' AND time < DATE '1996-05-10' + 60 GROUP BY time""")
def cell_series(spark, sf):
    """The mean member's series of the cell nearest to a place, overlaps by the least lead."""
    rows = T.forecasts(spark, sf).filter("year = 1996").select("id", "year", "issue", "number", F.posexplode("rain").alias("lead", "x")).withColumn("lead", F.col("lead") + 1)
    time = F.date_add(F.make_date("year", F.lit(5), F.lit(1)), (F.col("issue") - 1 + F.col("lead")).cast("int"))
    cells = rows.select(time.alias("time"), "lead", "number", (5.0 + F.col("id") % 30).alias("lat"), (65.0 + F.col("id") * 7 % 30).alias("lon"), "x")
    return R.extract_series(cells, 12.3, 78.2, 1996, "05-10", 60).withColumn("x", F.round("x", 9))


@query(f"""WITH {Q._BOX_SQL}, d AS (SELECT least((SELECT min(g) FROM (SELECT lat - lag(lat) OVER (ORDER BY lat) AS g FROM (SELECT DISTINCT lat FROM cells))), (SELECT min(g) FROM (SELECT lon - lag(lon) OVER (ORDER BY lon) AS g FROM (SELECT DISTINCT lon FROM cells))))::DOUBLE AS gap),
k AS (SELECT k, max(greatest(abs(round(lat::DOUBLE, k) - lat), abs(round(lon::DOUBLE, k) - lon))) AS off FROM cells, (SELECT CAST(unnest(range(0, 13)) AS INT) AS k) GROUP BY k)
SELECT min(k) AS digits, (SELECT count(*) FROM cells) AS n FROM k, d WHERE off <= gap * 1e-4""")
def grid_digits(spark, sf):
    """Digits that the ids of a grid need."""
    cells, _ = Q._boxes(spark, sf)
    return cells.agg(F.count(F.lit(1)).alias("n")).select(F.lit(I.grid_ids(cells).digits).alias("digits"), "n")


@query()
def platt_export(spark, sf):
    """K-15: calibration weights on logit p, for export."""
    return E.platt_export(T.probabilities(spark, sf), T.BINS)


@query()
def cell_cross_validation(spark, sf):
    """K-12: a logistic fit for each unit and left-out year, on the chance of the first bin."""
    rows = T.probabilities(spark, sf).select("id", "year", F.round(F.get("p", F.lit(0)), 2).alias("score"), (F.col("y") == 1).cast("int").alias("label"))
    return E.cell_fits(rows, ["id"])
