"""Blending models: formulas, multinomial fits, cross-validation, Platt calibration and model mixing."""

from __future__ import annotations

import itertools
import re
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import clean_probs, let, softmax, total
from .fits import cross_validate_groups, fit_groups
from .relations import cut


def expand_formula(formula: str, weeks: int, unavailable: set[str] = frozenset()) -> list[tuple[str, ...]]:
    """Terms of "a * b + c_qx": products expand to all subsets, ``_qx`` to every week.

    Week forms of an unavailable ``_qx`` predictor are dropped; an explicit unavailable column is an error."""
    terms: list[tuple[str, ...]] = []
    for part in (p.strip() for p in formula.split("+")):
        if not part:
            raise ValueError(f"empty term in {formula!r}")
        for week in range(1, weeks + 1) if "_qx" in part else [0]:
            names = [re.sub(r"_qx\b", f"_week{week}", n.strip()) for n in part.split("*")]
            if lost := [n for n in names if n in unavailable]:
                if week:
                    continue
                raise ValueError(f"unavailable predictors {lost}")
            for k in range(1, len(names) + 1):
                terms += itertools.combinations(names, k)
    terms = list(dict.fromkeys(terms))
    if not terms:
        raise ValueError(f"no predictor of {formula!r} is available")
    return terms


def window_formulas(name: str, formula: str, weeks: int, old: str, new: str, starts: list[int], end: int, unavailable: set[str] = frozenset()) -> dict[str, list[tuple[str, ...]]]:
    """Variants of a formula on predictors of shorter records: for each first year, ``old`` is replaced by ``new``, in which
    "{window}" stands for "_<start>_<end>", and the name gets that suffix.  1900, the whole record, is the formula itself and
    has no variant.  A variant without any available predictor is an error."""
    if not starts or not old or not new:
        raise ValueError("window variants need first years, and what is replaced by what")
    if old not in formula:
        raise ValueError(f"{old!r} does not occur in {formula!r}")
    windows = {f"_{start}_{end}": start for start in starts if start != 1900}
    return {f"{name}{w}": expand_formula(formula.replace(old, new.replace("{window}", w)), weeks, unavailable) for w in windows}


def design(df: DataFrame, terms: list[tuple[str, ...]]) -> tuple[DataFrame, list[str]]:
    """Adds a column ``x0``, ``x1`` … per term, the product of its predictors."""
    names = [f"x{i}" for i in range(len(terms))]
    return df.withColumns({n: reduce(lambda a, b: a * b, [F.col(c).cast("double") for c in t]) for n, t in zip(names, terms, strict=True)}), names


def scaler(df: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column; constants have deviation 1."""
    row = df.agg(*[F.avg(n).alias(f"m_{n}") for n in names], *[F.stddev_pop(n).alias(f"s_{n}") for n in names]).first()
    return {n: (row[f"m_{n}"] or 0.0, row[f"s_{n}"] or 1.0) for n in names}


def standardise(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({n: (F.col(n) - m) / s for n, (m, s) in scale.items()})


def fit_multinomial(train: DataFrame, names: list[str], label: str) -> dict:
    """Multinomial logistic regression on standardised columns; rows with missing values are left out first.

    ``label`` holds 0-based classes.  Returns classes x features coefficients, intercepts and the scaler."""
    rows = train.na.drop(subset=[*names, label])
    scale = scaler(rows, names)
    ready = VectorAssembler(inputCols=names, outputCol="_v").transform(standardise(rows, scale)).select("_v", F.col(label).cast("double").alias("_label"))
    model = LogisticRegression(featuresCol="_v", labelCol="_label", family="multinomial", regParam=0.0, standardization=False, maxIter=500, tol=1e-8).fit(ready)
    return {"coef": model.coefficientMatrix.toArray(), "intercept": model.interceptVector.toArray(), "scale": scale, "names": names}


def final_fit(df: DataFrame, names: list[str], label: str, true_holdout: set[int] = frozenset(), year: str = "year") -> dict:
    """The fit of all training years, which are all but the true holdouts; every outcome class must occur in them."""
    known = df.filter(F.col(label).isNotNull())
    train = known.filter(~F.col(year).isin([-1, *true_holdout]))
    lost = known.select(label).distinct().join(train.select(label).distinct(), label, "left_anti")
    if some := [r[0] for r in lost.limit(5).collect()]:
        raise ValueError(f"the training years lack the outcome classes {some}")
    return fit_multinomial(train, names, label)


def bundle(spark: SparkSession, model: dict) -> DataFrame:
    """A fit as a table, to be written and read: class, position, term, coefficient, mean, deviation; the intercept is the
    term at position -1."""
    rows = [(k, -1, "(intercept)", float(b), 0.0, 1.0) for k, b in enumerate(model["intercept"])]
    rows += [(k, j, n, float(model["coef"][k][j]), *map(float, model["scale"][n])) for k in range(len(model["intercept"])) for j, n in enumerate(model["names"])]
    return spark.createDataFrame(rows, "class int, position int, term string, coefficient double, mean double, deviation double")


def from_bundle(table: DataFrame) -> dict:
    """The fit of a table from :func:`bundle` (a few rows a class)."""
    rows = sorted(table.collect(), key=lambda r: (r["class"], r["position"]))
    classes = sorted({r["class"] for r in rows})
    terms = [r for r in rows if r["class"] == classes[0] and r["position"] >= 0]
    of = {(r["class"], r["position"]): r["coefficient"] for r in rows}
    if len(of) != len(classes) * (len(terms) + 1):
        raise ValueError("the bundle lacks coefficients")
    return {"names": [r["term"] for r in terms], "scale": {r["term"]: (r["mean"], r["deviation"]) for r in terms},
            "intercept": [of[k, -1] for k in classes], "coef": [[of[k, j] for j in range(len(terms))] for k in classes]}


def apply_multinomial(df: DataFrame, model: dict, out: str = "p") -> DataFrame:
    """Class probabilities from the coefficients, in SQL; NULL where a predictor is missing."""
    z = [sum(((F.col(n) - m) / s * float(c) for (n, (m, s)), c in zip(model["scale"].items(), row, strict=True)), F.lit(float(b)))
         for row, b in zip(model["coef"], model["intercept"], strict=True)]
    known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in model["names"]])
    return df.withColumn(out, F.when(known, softmax(F.array(*z))))


def linear_probs(terms: list[Column], coefficients: list[list[float]], intercepts: list[float]) -> Column:
    """softmax(X W + b) for given coefficients."""
    return softmax(F.array(*[sum((t * float(c) for t, c in zip(terms, row, strict=True)), F.lit(float(b))) for row, b in zip(coefficients, intercepts, strict=True)]))


def fold_years(df: DataFrame, true_holdout: set[int] = frozenset(), year: str = "year") -> list[int]:
    """Years of the table that get a fold: all but those that the training rule leaves out."""
    return sorted(r[0] for r in df.select(year).distinct().collect() if r[0] is not None and r[0] not in {-1, *true_holdout})


def cross_validate(
    df: DataFrame, names: list[str], label: str, years: list[int], true_holdout: set[int] = frozenset(), year: str = "year",
    allowed: DataFrame | None = None, id_col: str = "id",
) -> DataFrame:
    """Leave-one-year-out predictions: each of ``years`` is predicted from all others but the true holdouts, all folds side by
    side.  ``allowed`` limits training to its ids.  An outcome class that a fold's training rows lack is an error."""
    known = cut(df.filter(F.col(label).isNotNull()).groupBy(label, year, *([] if allowed is None else [id_col])).count())
    train = known.filter(~F.col(year).isin([-1, *true_holdout]))
    allowed = allowed if allowed is None else cut(allowed.select(id_col).distinct())
    train = train if allowed is None else train.join(allowed, id_col, "left_semi")
    counts = train.groupBy(label, year).agg(F.sum("count").alias("count"))
    totals = counts.groupBy(label).agg(F.sum("count").alias("all"), F.map_from_entries(F.collect_list(F.struct(F.col(year).cast("long"), "count"))).alias("own"))
    every = known.select(label).distinct().join(totals, label, "left")
    own = lambda y: F.coalesce(F.try_element_at("own", F.lit(y).cast("long")), F.lit(0))
    lost = every.filter(F.col("all").isNull() | F.exists(F.array(*[F.lit(y) for y in years]), lambda y: F.col("all") == own(y))) if years else every.filter("all IS NULL")
    if some := [r[0] for r in lost.select(label).limit(5).collect()]:
        raise ValueError(f"a year's training rows lack the outcome classes {some}")
    classes = (known.agg(F.max(label)).first()[0] or 0) + 1
    return cross_validate_groups(df, [], names, label, classes, true_holdout, allowed, years, year, id_col)


def newton_1d(x: np.ndarray, y: np.ndarray, min_rows: int = 10, steps: int = 100) -> tuple[float, float]:
    """Intercept and slope of a one-variable logistic fit; identity with too few rows or one class."""
    if len(x) < min_rows or len(np.unique(y)) < 2:
        return float("nan"), float("nan")
    X, w = np.column_stack([np.ones(len(x)), x]), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(X @ w, -35, 35)))
        step = np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + 1e-9 * np.eye(2), X.T @ (p - y))
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0]), float(w[1])


def _line(fits: DataFrame) -> DataFrame:
    """Intercept and slope of fits of two classes on one term."""
    return fits.withColumns({"intercept": F.get("w", F.lit(2)), "slope": F.get("w", F.lit(3))}).drop("counts", "w")


def platt_weights(flat: DataFrame, keys: list[str], x: str = "score", y: str = "label", n: str | None = None, min_rows: int = 10, steps: int = 100) -> DataFrame:
    """keys -> intercept, slope; NULL with too few rows or one class.  ``n`` counts equal rows, if they are grouped.

    The fits of :func:`newton_1d` for all groups at once, see :mod:`.fits`; rows without a score or label are left out."""
    rows = flat.select(*keys, F.lit(None).cast("long").alias("year"), F.array(F.lit(1.0), F.col(x).cast("double")).alias("x"), F.col(y).cast("int").alias("y"), (F.lit(1) if n is None else F.col(n)).alias("n"))
    folds = flat.select(*keys, F.lit(None).cast("long").alias("fold"))
    return _line(fit_groups(rows.filter(F.get("x", F.lit(1)).isNotNull() & F.col("y").isNotNull()), keys, folds, 2, 2, min_rows, steps)).drop("fold")


def _clipped(p: Column) -> Column:
    return F.when(p.isNotNull(), F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p)))


def platt_folds(flat: DataFrame, years: list[int], keys: list[str], min_rows: int = 10) -> DataFrame:
    """keys, year, intercept, slope: a fit on the clipped raw score for each of ``years``, from the rows of all others."""
    rows = flat.select(*keys, F.col("year").cast("long").alias("year"), F.array(F.lit(1.0), _clipped(F.col("score").cast("double"))).alias("x"), F.col("label").cast("int").alias("y"), F.lit(1).alias("n"))
    folds = flat.select(*keys).distinct().withColumn("fold", F.explode(F.array(*[F.lit(y).cast("long") for y in years])))
    fits = fit_groups(rows.filter(F.get("x", F.lit(1)).isNotNull() & F.col("y").isNotNull()), keys, folds, 2, 2, min_rows)
    return _line(fits).withColumnRenamed("fold", "year")


def platt_cross_validate(flat: DataFrame, years: list[int]) -> DataFrame:
    """bin, year, score, label -> adds ``calibrated``: each year by the fit of all others on the raw score, not renormalised."""
    fits = platt_folds(flat, years, ["bin"])
    z = F.col("intercept") + F.col("slope") * _clipped(F.col("score"))
    return flat.join(F.broadcast(fits), ["year", "bin"], "left").withColumn("calibrated", F.when(F.col("slope").isNull(), F.col("score")).otherwise(1 / (1 + F.exp(-z)))).drop("intercept", "slope")


def platt_calibrated(
    df: DataFrame, bins: int, years: list[int], true_holdout: set[int] = frozenset(), allowed: DataFrame | None = None,
    p: str = "p", y: str = "y", year: str = "year", id_col: str = "id",
) -> DataFrame:
    """The rows of ``years`` with ``calibrated``: every bin by its fit on the other years, then divided by the row's sum.

    True holdouts and units outside of ``allowed`` do not train.  A bin without a fit keeps its probability; a missing bin
    makes the row NULL; a row without mass stays zero.  ``y`` is the 1-based outcome.  The fits of a year are one row, so the
    rows are not shuffled."""
    train = df.filter(F.col(y).isNotNull() & F.coalesce(~F.col(year).isin([-1, *true_holdout]), F.lit(True)))
    train = train if allowed is None else train.join(allowed.select(id_col).distinct(), id_col, "left_semi")
    flat = train.select(F.col(year).alias("year"), F.posexplode(p).alias("bin", "score"), F.col(y).alias("_y"))
    flat = flat.select("year", "bin", "score", (F.col("_y") == F.col("bin") + 1).cast("int").alias("label"))
    fits = platt_folds(flat, years, ["bin"]).groupBy("year").agg(F.map_from_entries(F.collect_list(F.struct("bin", F.struct("intercept", "slope")))).alias("_fits"))
    fits = fits.select(F.col("year").alias("_year"), F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.try_element_at("_fits", b)).alias("_fits"))  # a row a year
    each = F.zip_with(p, "_fits", lambda v, f: F.when(f["slope"].isNull(), v).otherwise(1 / (1 + F.exp(-(f["intercept"] + f["slope"] * _clipped(v))))))
    out = df.filter(F.col(year).isin(years)).join(F.broadcast(fits), F.col(year).cast("long") == F.col("_year"), "left")
    return out.withColumn("calibrated", let(each, lambda q: let(total(q), lambda s: F.when(s.isNotNull(), F.transform(q, lambda v: v / F.when(s == 0, 1.0).otherwise(s)))))).drop("_fits", "_year")


def mixing_weights(df: DataFrame, sources: list[str], y: str, bins: int, step: float = 0.1) -> tuple[dict[str, float], float]:
    """Simplex weights of the sources that minimise the mean ranked probability score.

    The score is quadratic in the weights, so Spark aggregates one Gram matrix and the grid and refinement run on
    that."""
    cum = lambda a: F.transform(F.sequence(F.lit(1), F.lit(bins)), lambda i: F.aggregate(F.slice(a, F.lit(1), i), F.lit(0.0), lambda s, v: s + v))
    hot = F.array(*[F.when(F.col(y) == k, 1.0).otherwise(0.0) for k in range(1, bins + 1)])
    cols = [cum(clean_probs(F.col(s))) for s in sources] + [cum(hot)]
    rows = df.filter(F.col(y).isNotNull()).select(*[c.alias(f"_{i}") for i, c in enumerate(cols)])
    dot = lambda i, j: F.avg(F.aggregate(F.zip_with(f"_{i}", f"_{j}", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
    n = len(cols)
    got = rows.agg(*[dot(i, j).alias(f"g{i}_{j}") for i in range(n) for j in range(i, n)]).first()
    gram = np.array([[got[f"g{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)])
    loss = lambda w: float(np.append(w, -1) @ gram @ np.append(w, -1))
    k, parts = len(sources), round(1 / step)
    grid = [np.array(c) / parts for c in itertools.product(range(parts + 1), repeat=k) if sum(c) == parts]
    best = min(grid, key=loss)
    for _ in range(2000):  # projected gradient on the simplex
        v = np.sort(w := best - 0.5 * 2 * (gram[:k, :k] @ best - gram[:k, k]) / max(1e-12, np.linalg.norm(gram[:k, :k], 2)))[::-1]
        rho = np.max(np.flatnonzero(v + (1 - np.cumsum(v)) / np.arange(1, k + 1) > 0))
        new = np.maximum(w + (1 - v[: rho + 1].sum()) / (rho + 1), 0)
        if np.abs(new - best).max() < 1e-10:
            break
        best = new
    return dict(zip(sources, best.tolist(), strict=True)), loss(best)


def probability_array(model_output: Column) -> Column:
    return vector_to_array(model_output)
