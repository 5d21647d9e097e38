"""Kernel-density climatologies of onset days: distribution functions as arrays, and forecasts from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrays import floor_probs, let, total
from .relations import forecast_window, month_day

GRID, MIN_SAMPLES, EPS = 512, 10, 1e-12


def leave_one_out(samples: DataFrame, test_years: DataFrame | None = None) -> DataFrame:
    """id, year, onset_day -> id, test_year, onset_day without that year's own."""
    years = (samples.select(F.col("year").alias("test_year")) if test_years is None else test_years.select("test_year")).distinct()
    listed = years.agg(F.collect_list("test_year").alias("_years"))  # one row: the years of the record
    return samples.join(F.broadcast(listed)).select("id", "year", "onset_day", F.explode("_years").alias("test_year")).filter("year <> test_year").drop("year")


def _gathered(counted: DataFrame, keys: list[str]) -> DataFrame:
    """keys, _v, _c -> keys, n, least and largest value, and the distinct values with their numbers of samples."""
    return counted.groupBy(*keys).agg(
        F.sum("_c").alias("n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.collect_list(F.struct(F.col("_v").alias("x"), F.col("_c").alias("n"))).alias("_x"))


def equal_samples(samples: DataFrame, keys: list[str], x: str = "onset_day") -> DataFrame:
    """keys -> n, least and largest value, and the distinct values with their numbers of samples."""
    return _gathered(samples.filter(F.col(x).isNotNull()).groupBy(*keys, F.col(x).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")), keys)


def left_out_samples(samples: DataFrame, test_years: DataFrame | None = None, x: str = "onset_day", id_col: str = "id") -> DataFrame:
    """id, test_year -> as :func:`equal_samples`, without the test year's samples.

    Samples are counted once by (id, value, year); a fold's number is the value's total less the year's own, so that no
    sample is repeated for a fold.  The record's years are one row."""
    own = samples.filter(F.col(x).isNotNull()).groupBy(id_col, F.col(x).cast("double").alias("_v"), F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("_c"))
    totals = own.groupBy(id_col, "_v").agg(F.sum("_c").alias("_all"), F.map_from_entries(F.collect_list(F.struct("year", "_c"))).alias("_own"))
    years = samples.select(F.col("year").cast("int").alias("y")) if test_years is None else test_years.select(F.col("test_year").cast("int").alias("y"))
    listed = years.agg(F.collect_set("y").alias("_years"))
    folds = totals.join(F.broadcast(listed)).select(id_col, "_v", "_all", "_own", F.explode("_years").alias("test_year"))
    left = F.col("_all") - F.coalesce(F.try_element_at("_own", F.col("test_year")), F.lit(0))
    return _gathered(folds.select(id_col, "test_year", "_v", left.alias("_c")).filter("_c > 0"), [id_col, "test_year"])


def fit_kde(samples: DataFrame, keys: list[str], x: str = "onset_day", grid: int = GRID, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """keys -> n, lo, step, cdf: Gaussian kernels of Scott's width on ``grid`` points from three widths below the
    least to three above the largest sample.  Equal samples are one kernel with their number as weight, so a group
    holds distinct values.  Groups that are too small or constant are left out."""
    return fit_counted(equal_samples(samples, keys, x), keys, grid, min_samples)


def fit_counted(counted: DataFrame, keys: list[str], grid: int = GRID, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """:func:`fit_kde` of counted samples.  Kernel sums are a relation of grid points and values, so that a group's points are
    summed by many tasks and in generated code; the distribution function is a running sum over its ``grid`` points."""
    weighted = lambda f: F.aggregate("_x", F.lit(0.0), lambda s, v: s + v["n"] * f(v["x"]))
    stats = (
        counted
        .withColumn("_mean", weighted(lambda v: v) / F.col("n"))
        .withColumn("_sd", F.when(F.col("n") > 1, F.sqrt(weighted(lambda v: (v - F.col("_mean")) * (v - F.col("_mean"))) / (F.col("n") - 1))))
    )
    bw = F.col("_sd") * F.pow(F.col("n"), F.lit(-0.2))
    low = F.col("_min") - 3 * bw
    step = (F.col("_max") + 3 * bw - low) / (grid - 1)
    fitted = stats.filter((F.col("n") >= min_samples) & (F.col("_sd") > 0)).select(*keys, "n", low.alias("lo"), step.alias("step"), bw.alias("_bw"), F.explode("_x").alias("_s"))
    points = fitted.select(*keys, "n", "lo", "step", "_bw", "_s.x", F.col("_s.n").alias("_c"), F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_i"))
    away = (F.col("lo") + F.col("_i") * F.col("step") - F.col("x")) / F.col("_bw")
    pdf = points.groupBy(*keys, "_i").agg(F.sum(F.col("_c") * F.exp(-0.5 * away * away)).alias("_f"), *[F.first(c).alias(c) for c in ("n", "lo", "step")])
    own = Window.partitionBy(*keys)
    cdf = pdf.withColumn("_f", F.sum("_f").over(own.orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("_f").over(own))
    arrays = cdf.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("n", "lo", "step")], F.sort_array(F.collect_list(F.struct("_i", "_f"))).alias("_a"))
    return arrays.select(*keys, "n", "lo", "step", F.col("_a._f").alias("cdf"))


def cdf_at(t: Column, lo: Column, step: Column, cdf: Column) -> Column:
    """Linear interpolation; outside the grid the end values hold."""
    pos = (t - lo) / step
    last = F.size(cdf) - 1
    i = F.greatest(F.lit(0), F.least(F.floor(pos).cast("int"), last - 1))
    w = F.greatest(F.lit(0.0), F.least(F.lit(1.0), pos - i))
    return F.get(cdf, i) + w * (F.get(cdf, i + 1) - F.get(cdf, i))


def predict(rows: DataFrame, horizon: int, d0: str = "d0", low: float = 5e-7) -> DataFrame:
    """rows with lo, step, cdf and d0 (days from season start to issue) -> p_cond, p_uncond, p_day0.

    Day k has F(d0 + k) - F(d0 + k - 1), conditional on no onset up to d0 divided by 1 - F(d0), each floored at
    ``low`` with its sum kept."""
    at = lambda r, t: cdf_at(t, r["lo"], r["step"], r["cdf"])

    def days(r: Column) -> Column:
        raw = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: F.greatest(F.lit(0.0), at(r, r["d0"] + k) - at(r, r["d0"] + k - 1)))
        return F.struct(at(r, r["d0"]).alias("p0"), raw.alias("raw"))

    def both(s: Column) -> Column:
        left = 1 - s["p0"]
        cond = F.when(left <= EPS, s["raw"]).otherwise(F.transform(s["raw"], lambda x: x / left))
        floored = lambda p: let(p, lambda q: floor_probs(q, total(q), low))
        return F.struct(s["p0"].alias("p_day0"), floored(s["raw"]).alias("p_uncond"), floored(cond).alias("p_cond"))

    frame = F.struct("lo", "step", "cdf", F.col(d0).cast("double").alias("d0"))
    out = rows.withColumn("_p", let(let(frame, days), both))
    return out.select(*rows.columns, "_p.p_day0", "_p.p_uncond", "_p.p_cond")


def training_samples(truth: DataFrame, first: int, last: int, onset: str = "onset_day") -> DataFrame:
    """Rows with an onset in the years first..last."""
    return truth.filter(F.col(onset).isNotNull() & F.col("year").between(first, last))


def issue_grid(spark: SparkSession, first: int, last: int, start: str, end: str, horizons: list[tuple[str, str, int]] | int = 28) -> DataFrame:
    """year, time, d0 (days since the season's start), horizon: every issue date of every year, both ends included.

    ``horizons`` are month-day ranges with their days, or one number for all; dates outside all ranges leave."""
    if end < start:
        raise ValueError(f"the season's last issue {end} is before its start {start}")
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    opened = month_day(F.col("year"), start)
    rows = years.select("year", F.explode(F.sequence(opened, month_day(F.col("year"), end))).alias("time"))
    days = F.lit(horizons) if isinstance(horizons, int) else forecast_window(F.col("time"), horizons)
    return rows.withColumn("d0", F.datediff("time", opened)).withColumn("horizon", days).filter("horizon IS NOT NULL")


def issue_probabilities(fits: DataFrame, grid: DataFrame, horizon: int, low: float = 5e-7) -> DataFrame:
    """Each unit's fit at each issue date: id, year, time, d0, horizon, p_day0, p_uncond, p_cond.

    A fit is predicted once for each distinct d0 (a few hundred days, one row), and the dates of all years with that d0 are
    joined afterwards, so that no distribution function is repeated for a year."""
    days = grid.agg(F.array_sort(F.collect_set("d0")).alias("_days"))
    rows = fits.join(F.broadcast(days)).withColumn("d0", F.explode("_days")).drop("_days")
    return predict(rows, horizon, "d0", low).drop("lo", "step", "cdf", "n").join(grid, "d0")
