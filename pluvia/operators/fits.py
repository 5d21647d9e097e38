"""Many logistic and multinomial fits at once, one for each group and left-out year.

A group's rows are counted by value and cut into slices of a bounded number of rows; a row lies in one slice, whatever the
number of folds.  A fold's training rows are all but its own year's, so one pass over a slice gives the gradients and
Hessians of all folds of its group.  Weights, sums and outcome counts are tables: nothing that grows with the groups comes
to the driver, which only asks whether a fit is still open.  A group of one slice is solved where it lies; the slices of
larger groups are summed, a Newton step a job.

A null or infinite predictor and a null outcome leave the row out of training.  A class that a fold's training rows lack has
no probability there, and a fold with fewer than two classes has no fit.  Null keys are one group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, DoubleType, StructType

from .relations import cut

RIDGE, SLICE, DONE = 1e-9, 4096, 1e-8
_FIT = ["counts", "w", "prev", "last", "open"]


def beside(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Null-safe join on equal names; the keys are those of ``left``."""
    other = {k: f"_r_{k}" for k in keys}
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in other.items()])
    return left.join(right.withColumnsRenamed(other), on, how).drop(*other.values())


def derivatives(x: np.ndarray, y: np.ndarray, n: np.ndarray, w: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient, Hessian and loss of a multinomial fit with weights ``w`` (classes x terms) over rows counted ``n`` times."""
    z = np.where(there, x @ w.T, -np.inf)
    z -= z.max(axis=1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(axis=1, keepdims=True)
    loss = -float(n @ np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)))
    hot = np.eye(len(w))[y]
    g = ((p - hot) * n[:, None]).T @ x
    terms = x.shape[1]
    h = np.empty((len(w), terms, len(w), terms))
    for a in range(len(w)):
        for b in range(a, len(w)):
            h[a, :, b, :] = (x * (n * p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ x
            h[b, :, a, :] = h[a, :, b, :]
    return g.ravel(), h.reshape(g.size, g.size), loss


def free(counts: np.ndarray, terms: int) -> np.ndarray:
    """Which weights are fitted: those of the classes with rows, but for the first of them."""
    there = counts > 0
    there[np.argmax(there)] = False
    return np.repeat(there, terms)


def advance(fit: dict, g: np.ndarray, h: np.ndarray, loss: float) -> dict:
    """A Newton step, or half of the last step back if it raised the loss."""
    w, prev = np.array(fit["w"]), np.array(fit["prev"])
    if loss > fit["last"] * (1 + 1e-9) + 1e-9:
        return fit | {"w": ((w + prev) / 2).tolist(), "open": bool(np.abs(w - prev).max() > DONE)}
    at = free(np.array(fit["counts"]), len(w) // len(fit["counts"]))
    step = np.zeros(len(w))
    step[at] = np.linalg.solve(h[np.ix_(at, at)] + RIDGE * np.eye(at.sum()), g[at])
    return fit | {"prev": fit["w"], "w": (w - step).tolist(), "last": loss, "open": bool(np.abs(step).max() > DONE)}


def in_tasks(rows: DataFrame, schema: str, work, arrays: tuple = ()) -> DataFrame:
    """``work(row)``, a list of rows as dictionaries, for each row; the lists named in ``arrays`` stay Arrow arrays."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = batch.drop_columns(list(arrays)).to_pylist()
            for i, row in enumerate(plain):
                yield from pa.Table.from_pylist(work(row | {c: batch.column(c)[i].values for c in arrays}), arrow).to_batches()

    return rows.mapInArrow(run, schema)


def _arrays(rows: pa.StructArray) -> dict:
    year, y, n, x = rows.flatten()
    return {"x": x.flatten().to_numpy().reshape(len(rows), -1), "y": y.to_numpy(), "n": n.to_numpy(), "year": year.fill_null(-(1 << 62)).to_numpy()}


def _sums(rows: dict, fit: dict) -> tuple[np.ndarray, np.ndarray, float]:
    """Derivatives over the fold's training rows of a slice."""
    at = slice(None) if fit["fold"] is None else rows["year"] != fit["fold"]
    return derivatives(rows["x"][at], rows["y"][at], rows["n"][at], np.array(fit["w"]).reshape(len(fit["counts"]), -1), np.array(fit["counts"]) > 0)


def fit_groups(rows: DataFrame, keys: list[str], folds: DataFrame, classes: int, terms: int, min_rows: int = 0, steps: int = 100, slice_rows: int = SLICE) -> DataFrame:
    """keys, fold, counts, w: the fits of ``folds`` (keys, fold), each on its group's rows of all other years; fold null: all rows.

    ``rows`` has keys, year, x (array of ``terms`` values), y (0-based class) and n (how often).  counts are the training rows
    of each class; w holds classes x terms weights, those of the first class with rows being 0, and is null without a fit."""
    counted = cut(rows.groupBy(*keys, "year", "x", "y").agg(F.sum("n").cast("double").alias("n")))
    per_class = F.array(*[F.coalesce(F.sum(F.when(F.col("y") == k, F.col("n"))), F.lit(0.0)) for k in range(classes)])
    # A row a group; being files of known size, they are broadcast while small, so that a large group's rows stay where they are.
    totals = cut(counted.groupBy(*keys).agg(per_class.alias("all"), F.ceil(F.count(F.lit(1)) / slice_rows).alias("slices")))
    own = counted.groupBy(*keys, F.col("year").alias("fold")).agg(per_class.alias("own"))
    some, by = folds.select(*keys, "fold").distinct(), [*keys, "fold"]
    left = F.when(F.col("own").isNull() | F.col("fold").isNull(), F.col("all")).otherwise(F.zip_with("all", "own", lambda a, b: a - b))
    state = beside(beside(some, totals, keys, "left"), own, by, "left").select(*by, left.alias("counts"), "slices")
    enough = (F.size(F.filter("counts", lambda c: c > 0)) > 1) & (F.aggregate("counts", F.lit(0.0), lambda s, c: s + c) >= min_rows)
    zero = F.array_repeat(F.lit(0.0), classes * terms)
    state = cut(state.select(*by, "counts", zero.alias("w"), zero.alias("prev"), F.lit(float("inf")).alias("last"), F.coalesce(enough, F.lit(False)).alias("open"), "slices"))

    part = F.pmod(F.xxhash64("year", "x", "y"), F.col("slices"))
    placed = beside(counted, totals, keys).select(*keys, part.alias("part"), "slices", F.struct("year", "y", "n", "x").alias("row"))
    slices = cut(placed.groupBy(*keys, "part", "slices").agg(F.collect_list("row").alias("rows")))
    kinds = dict(state.dtypes)
    of = lambda names: ", ".join(f"{c} {kinds[c]}" for c in names)

    def met(slices: DataFrame, now: DataFrame) -> DataFrame:
        """Each slice with the fits of its group."""
        fits = now.groupBy(*keys).agg(F.collect_list(F.struct("fold", *_FIT)).alias("fits"))
        return beside(slices, fits, keys).select(*keys, "rows", "fits")

    def solve(row: dict) -> list[dict]:
        data, out = _arrays(row["rows"]), []
        for fit in row["fits"]:
            for _ in range(steps):
                if not fit["open"]:
                    break
                fit = advance(fit, *_sums(data, fit))
            out.append({k: row[k] for k in keys} | {c: fit[c] for c in ("fold", "counts", "w")})
        return out

    def sums(row: dict) -> list[dict]:
        data, out = _arrays(row["rows"]), []
        for fit in row["fits"]:
            g, h, loss = _sums(data, fit)
            out.append({k: row[k] for k in keys} | {"fold": fit["fold"], "v": [*g.tolist(), *h.ravel().tolist(), loss]})
        return out

    def step(row: dict) -> list[dict]:
        v, size = np.array(row.pop("v")), len(row["w"])
        return [advance(row, v[:size], v[size:-1].reshape(size, size), float(v[-1]))]

    parts = [state.filter("NOT open").select(*by, "counts", F.lit(None).cast("array<double>").alias("w"))]
    parts.append(in_tasks(met(slices.filter("slices = 1"), state.filter("open AND slices = 1")), of([*by, "counts", "w"]), solve, ("rows",)))
    large, now = slices.filter("slices > 1"), state.filter("open AND slices > 1").drop("slices")
    for _ in range(steps):
        if now.isEmpty():
            break
        each = in_tasks(met(large, now), f"{of(by)}, v array<double>", sums, ("rows",)).select(*by, F.posexplode("v").alias("i", "v"))
        summed = each.groupBy(*by, "i").agg(F.sum("v").alias("v")).groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("v"))
        after = beside(now, summed, by).select(*by, *_FIT, "v")
        after = cut(in_tasks(after, of([*by, *_FIT]), step))
        parts.append(after.filter("NOT open").select(*by, "counts", "w"))
        now = after.filter("open")
    parts.append(now.select(*by, "counts", "w"))
    return reduce(DataFrame.unionByName, parts)


@F.arrow_udf(ArrayType(DoubleType()))
def probabilities(x: pa.Array, w: pa.Array, counts: pa.Array) -> pa.Array:
    """Class probabilities of rows with terms ``x``, a batch at a time; NULL without a fit or terms, and for classes without
    training rows."""
    there = x.is_valid().to_numpy(zero_copy_only=False) & w.is_valid().to_numpy(zero_copy_only=False)
    size, some = there.sum(), pa.array(there)
    ends = pa.array(np.zeros(len(there) + 1, np.int32))
    if not size:
        return pa.ListArray.from_arrays(ends, pa.array([], pa.float64()), mask=pa.array(~there))
    of = lambda a: a.filter(some).flatten().to_numpy(zero_copy_only=False).reshape(size, -1)
    x, c = of(x), of(counts)
    z = np.where(c > 0, np.einsum("nkj,nj->nk", of(w).reshape(size, c.shape[1], -1), x), -np.inf)
    e = np.exp(z - z.max(axis=1, keepdims=True))
    p = pa.array((e / e.sum(axis=1, keepdims=True)).ravel(), mask=(c <= 0).ravel())
    ends = np.concatenate([[0], np.cumsum(there) * c.shape[1]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), p, mask=pa.array(~there))


def cross_validate_groups(
    df: DataFrame, keys: list[str], names: list[str], label: str, classes: int, true_holdout: set[int] = frozenset(),
    allowed: DataFrame | None = None, years: list[int] | None = None, year: str = "year", id_col: str = "id",
) -> DataFrame:
    """df -> adds ``p``: the class probabilities of each row from a multinomial fit on its group's rows of all other years.

    ``label`` is a 0-based class.  Years -1 and ``true_holdout`` never train; ``allowed`` (ids) limits training to its units.
    Predicted are rows of ``years``, by default of all years but -1 and the true holdouts.  ``keys`` may name a unit, a cluster
    or nothing, for one fit a year over all rows.  Terms are standardised by their group's training rows."""
    held, xs = [-1, *true_holdout], [f"_x{i}" for i in range(len(names))]
    finite = lambda n: F.when(F.abs(F.col(n).cast("double")) < float("inf"), F.col(n).cast("double"))  # noqa: E731  NULL for NaN and infinities
    own = lambda t: t.withColumns({f"_k{i}": F.col(k) for i, k in enumerate(keys)} or {"_k0": F.lit(0)})
    rows = cut(own(df.withColumns({x: finite(n) for x, n in zip(xs, names, strict=True)} | {"_year": F.col(year).cast("long")})))  # terms are made once
    known = rows.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [label, *xs]]) & F.coalesce(~F.col("_year").isin(held), F.lit(True)))
    by = [f"_k{i}" for i in range(len(keys) or 1)]
    equal = [*by, "_year", *xs, F.col(label).cast("int").alias("_y")]
    # Equal rows are counted before any join, so that a common key's rows do not meet in a task.
    counted = known.groupBy(*equal, *([] if allowed is None else [F.col(id_col).alias("_id")])).agg(F.count(F.lit(1)).alias("_n"))
    if allowed is not None:
        counted = counted.join(allowed.select(F.col(id_col).alias("_id")).distinct(), "_id", "left_semi").groupBy(*by, "_year", *xs, "_y").agg(F.sum("_n").alias("_n"))
    counted = cut(counted)
    mean = lambda x: F.when(F.min(x) == F.max(x), F.min(x)).otherwise(F.sum(F.col(x) * F.col("_n")) / F.sum("_n"))  # noqa: E731  a constant is its own mean
    means = cut(counted.groupBy(*by).agg(F.array(*[mean(x) for x in xs]).alias("_m")))
    gap = lambda i: F.col(xs[i]) - F.get("_m", F.lit(i))
    spread = lambda i: F.sqrt(F.sum(gap(i) * gap(i) * F.col("_n")) / F.sum("_n"))
    scale = beside(counted, means, by).groupBy(*by, "_m").agg(F.array(*[spread(i) for i in range(len(xs))]).alias("_s"))
    scale = cut(scale.select(*by, "_m", F.transform("_s", lambda s: F.when(s > 0, s).otherwise(1.0)).alias("_s")))  # constants keep their scale
    ready = [F.lit(1.0), *[gap(i) / F.get("_s", F.lit(i)) for i in range(len(xs))]]
    train = beside(counted, scale, by).select(*by, F.col("_year").alias("year"), F.array(*ready).alias("x"), F.col("_y").alias("y"), F.col("_n").alias("n"))
    tests = rows.filter(F.col("_year").isin(years) if years is not None else F.col("_year").isNotNull() & ~F.col("_year").isin(held))
    fits = fit_groups(train, by, tests.select(*by, F.col("_year").alias("fold")).distinct(), classes, len(names) + 1)
    fits = beside(fits, scale, by).select(*by, F.col("fold").alias("_year"), "counts", "w", "_m", "_s")
    out = beside(tests, fits if keys else F.broadcast(fits), [*by, "_year"], "left")  # without keys the fits are a row a year
    terms = F.when(reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in xs]), F.array(*ready))
    return out.select(*[c for c in df.columns if c != "p"], probabilities(terms, F.col("w"), F.col("counts")).alias("p"))
