"""Baseline predictions, row scores and tables for the evaluation of a new season."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays as A
from .fits import fit_groups
from .models import platt_weights


def later_bin(weeks: Column, earlier: Column | None = None) -> Column:
    """What the weeks (and the bin before them) leave over, between 0 and 1; NULL if a week is."""
    rest = 1.0 - A.total(weeks)
    return A.clip(rest if earlier is None else rest - earlier, 0.0, 1.0)


def raw_bins(weeks: Column) -> Column:
    """week1 … weekN, later of a model's own probabilities."""
    return A.let(weeks, lambda w: F.concat(w, F.array(later_bin(w))))


def logit_bins(logits: Column, earlier: Column | None = None, earlier_is_logit: bool = True, renormalise: bool = True) -> Column:
    """Bins of a climatology that is kept as logits: [earlier,] week1 … weekN, later.

    With ``earlier`` the bins are divided by their sum where that is positive."""
    weeks = F.transform(logits, A.expit)
    if earlier is None:
        return raw_bins(weeks)
    first = A.clip(A.expit(earlier) if earlier_is_logit else earlier.cast("double"), 0.0, 1.0)
    bins = A.let(F.struct(weeks.alias("w"), first.alias("e")), lambda s: F.concat(F.array(s["e"]), s["w"], F.array(later_bin(s["w"], s["e"]))))
    return A.let(bins, lambda b: F.coalesce(A.normalise(b), b)) if renormalise else bins


def with_earlier(bins: Column) -> Column:
    """earlier, week1 … weekN, later: ``earlier`` is what the others leave over, at least 0; NULL counts as zero."""
    return A.let(bins, lambda b: F.concat(F.array(F.greatest(F.lit(0.0), 1.0 - A.total_skip(b))), b))


def row_rps(p: Column, outcome: Column) -> Column:
    """RPS of one row after dividing by the sum; NULL without an outcome (1-based bin), with a missing bin or no mass."""
    known = outcome.isNotNull() & ~F.exists(p, lambda x: x.isNull())

    def score(q: Column) -> Column:
        step = F.transform(F.sequence(F.lit(1), F.size(q)), lambda i: F.pow(A.total(F.slice(q, F.lit(1), i)) - F.when(i >= outcome, 1.0).otherwise(0.0), F.lit(2.0)))
        return A.total(step)

    return F.when(known & (A.total(p) > 0), A.let(A.normalise(p), score))


def evaluation_join(forecast: DataFrame, truth: DataFrame, climatology: DataFrame, clim_cols: list[str]) -> DataFrame:
    """Forecast rows with their unit's outcome (rows of unknown units leave) and those climatology columns that the
    forecast lacks, by (id, time)."""
    missing = [c for c in clim_cols if c not in forecast.columns]
    out = forecast.join(truth, "id")
    return out.join(climatology.select("id", "time", *missing), ["id", "time"], "left") if missing else out


def platt_export(df: DataFrame, bins: int, p: str = "p", y: str = "y", eps: float = 1e-6) -> DataFrame:
    """bin -> intercept and slope of a logistic fit on logit p over the rows given; identity (0, 1) with under ten rows or
    one class.  They are applied with :func:`pluvia.functions.arrays.apply_platt`."""
    flat = df.filter(F.col(y).isNotNull()).select(F.posexplode(p).alias("bin", "v"), F.col(y).alias("_y")).filter("v IS NOT NULL")
    q = A.clip(F.col("v"), eps, 1 - eps)
    flat = flat.select((F.col("bin") + 1).alias("bin"), F.log(q / (1 - q)).alias("score"), (F.col("_y") == F.col("bin") + 1).cast("int").alias("label"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    fits = platt_weights(flat, ["bin"])
    return every.join(F.broadcast(fits), "bin", "left").select("bin", F.coalesce("intercept", F.lit(0.0)).alias("intercept"), F.coalesce("slope", F.lit(1.0)).alias("slope"))


def harmonise(metrics: DataFrame, preferred: dict[str, int], name: str, keys: tuple = ("model", "period")) -> DataFrame:
    """Variants in ``preferred`` become one model ``name``; per key each column's first value that is not NULL, by rank."""
    ranks = F.create_map(*[F.lit(x) for pair in preferred.items() for x in pair])
    rank = F.coalesce(F.try_element_at(ranks, F.col("model")), F.lit(0))
    rows = metrics.withColumn("_rank", rank).withColumn("model", F.when(F.col("model").isin(*preferred), name).otherwise(F.col("model")))
    values = [c for c in metrics.columns if c not in keys]
    return rows.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in values])


def differences(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """key, both values and their difference, of the keys in both tables."""
    both = left.select(key, F.col(value).alias(f"{value}_x")).join(right.select(key, F.col(value).alias(f"{value}_y")), key)
    return both.withColumn("difference", F.col(f"{value}_x") - F.col(f"{value}_y"))


def cell_fits(df: DataFrame, keys: list[str], score: str = "score", label: str = "label", year: str = "year") -> DataFrame:
    """Leave-one-year-out logistic fits on one score, for each group of ``keys``: keys, test_year, intercept, slope; see
    :func:`pluvia.operators.fits.fit_groups`, which holds every row once for all folds."""
    rows = df.select(*keys, F.col(year).cast("long").alias("year"), F.array(F.lit(1.0), F.col(score).cast("double")).alias("x"), F.col(label).cast("int").alias("y"), F.lit(1).alias("n"))
    rows = rows.filter(F.get("x", F.lit(1)).isNotNull() & F.col("y").isNotNull())
    fits = fit_groups(rows, keys, rows.select(*keys, F.col("year").alias("fold")), 2, 2, min_rows=10)
    return fits.select(*keys, F.col("fold").alias("test_year"), F.get("w", F.lit(2)).alias("intercept"), F.get("w", F.lit(3)).alias("slope"))
