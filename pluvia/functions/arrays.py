"""Column expressions over day- or bin-indexed arrays, with the engine's missing-value rules.

Missing values are NULL throughout.  Functions say whether a NULL element counts as zero or makes the result
NULL; ``greatest`` and ``least`` skip NULL in Spark, so clips are guarded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pyspark.sql import types as T  # noqa: F401  re-exported for callers that build schemas


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: Spark would paste a column's expression wherever it is used,
    and inside a lambda evaluate it for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _zero() -> Column:
    return F.lit(0.0)


def total(a: Column) -> Column:
    """Sum of an array; NULL if any element is."""
    return F.aggregate(a, _zero(), lambda s, x: s + x)


def total_skip(a: Column) -> Column:
    """Sum of an array; NULL elements count as zero."""
    return F.aggregate(a, _zero(), lambda s, x: s + F.coalesce(x, _zero()))


def by_position(arrays: Column) -> Column:
    """An array by position of the values that the arrays have there; arrays that end before it are left out."""
    longest = F.array_max(F.transform(arrays, lambda a: F.size(a)))
    return F.when(longest > 0, F.transform(F.sequence(F.lit(0), longest - 1), lambda i: F.transform(F.filter(arrays, lambda a: F.size(a) > i), lambda a: F.get(a, i))))


def sum_by_position(arrays: Column) -> Column:
    """The sums of :func:`by_position`, as SUM gives them: NULL elements are skipped, none but NULL give NULL."""
    add = lambda s, x: F.coalesce(s + x, s, x)
    return F.transform(by_position(arrays), lambda v: F.aggregate(v, F.lit(None).cast("double"), add))


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def rolling_sums(a: Column, k: int) -> Column:
    """Sums of k consecutive elements, left aligned; a window with a NULL is NULL."""
    return F.when(F.size(a) >= k, F.transform(F.sequence(F.lit(1), F.size(a) - k + 1), lambda i: total(F.slice(a, i, k)))).otherwise(F.array().cast("array<double>"))


def bin_sums(p: Column, bins: int, days: int = 7) -> Column:
    """Day probabilities to bins of ``days`` days; a bin with a NULL day is NULL."""
    return F.array(*[total(F.slice(p, 1 + w * days, days)) for w in range(bins)])


def plus_bin(p: Column) -> Column:
    """What the days leave over, at least 0; missing days count as zero."""
    return F.greatest(_zero(), 1.0 - total_skip(p))


def logit_winsor(p: Column, eps: float = 1e-4) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.log(q / (1 - q))


def expit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def logsumexp(a: Column) -> Column:
    top = F.array_max(a)
    return top + F.log(total(F.transform(a, lambda x: F.exp(x - top))))


def softmax(a: Column) -> Column:
    """Stable softmax; NULL if an element is."""
    shifted = let(F.array_max(a), lambda top: F.transform(a, lambda x: F.exp(x - top)))
    return F.when(~F.exists(a, lambda x: x.isNull()), let(shifted, lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s))))


def normalise(a: Column) -> Column:
    return let(a, lambda b: let(F.nullif(total(b), _zero()), lambda s: F.transform(b, lambda x: x / s)))


def clean_probs(p: Column) -> Column:
    """Missing and negative to 0; all zero to uniform; sum 1."""
    q = F.transform(p, lambda x: F.greatest(F.coalesce(x, _zero()), _zero()))
    share = lambda q: let(total(q), lambda s: F.when(s > 0, F.transform(q, lambda x: x / s)).otherwise(F.transform(q, lambda x: 1.0 / F.size(q))))
    return let(q, share)


def rain_transform(x: Column, kind: str | float = "identity") -> Column:
    """identity, sqrt, fourth_root, log1p or a power; negatives to 0, NULL stays."""
    if kind == "identity":
        return x
    low = F.when(x.isNotNull(), F.greatest(x, _zero()))
    if kind == "log1p":
        return F.log1p(low)
    power = {"sqrt": 0.5, "fourth_root": 0.25}.get(kind, kind)
    if not isinstance(power, (int, float)) or power <= 0:
        raise ValueError(f"unknown rain transform {kind!r}")
    return F.pow(low, F.lit(float(power)))


def week_extreme(a: Column, window: int, first: int, last: int, largest: bool = True) -> Column:
    """Largest or smallest of the window sums that start on days first..last; windows with NULLs are skipped."""
    sums = F.filter(F.slice(rolling_sums(a, window), first, last - first + 1), lambda x: x.isNotNull())
    return F.array_max(sums) if largest else F.array_min(sums)


def outcome_bin(lead: Column, bins: int, days: int = 7, earlier: str | None = None) -> Column:
    """week1 … weekN, later; leads up to 0 are ``earlier``; NULL stays."""
    week = F.concat(F.lit("week"), F.ceil(lead / days).cast("int").cast("string"))
    return F.when(lead.isNull(), None).when(lead <= 0, F.lit(earlier)).when(lead <= bins * days, week).otherwise("later")


def one_hot(bin_no: Column, bins: int) -> Column:
    return F.array(*[F.when(bin_no == k, 1.0).otherwise(0.0) for k in range(1, bins + 1)])


def brier(p: Column, y: Column) -> Column:
    return total(F.zip_with(p, y, lambda a, b: (a - b) * (a - b)))


def rps(p: Column, y: Column) -> Column:
    """Ranked probability score: squared differences of the cumulative sums; missing p counts as zero."""
    d = F.zip_with(p, y, lambda a, b: F.coalesce(a, _zero()) - b)
    return total(F.transform(F.sequence(F.lit(1), F.size(d)), lambda i: F.pow(total(F.slice(d, F.lit(1), i)), F.lit(2.0))))


def fair_correction(p: Column, members: int = 30) -> Column:
    return total(F.transform(p, lambda x: x * (1 - x))) / (members - 1)


def max_period(p: Column) -> Column:
    """1-based position of the largest bin, the first of ties; NULL if a bin is missing."""
    return F.when(~F.exists(p, lambda x: x.isNull()), F.array_position(p, F.array_max(p)).cast("int"))


def apply_platt(p: Column, intercept: Column, slope: Column, eps: float = 1e-6) -> Column:
    """Calibrated and renormalised: expit(a + b logit p) per bin."""
    z = F.zip_with(F.zip_with(p, intercept, lambda x, a: F.struct(x.alias("p"), a.alias("a"))), slope,
                   lambda s, b: F.struct(s["p"].alias("p"), s["a"].alias("a"), b.alias("b")))
    q = F.transform(z, lambda s: expit(s["a"] + s["b"] * F.log(clip(s["p"], eps, 1 - eps) / (1 - clip(s["p"], eps, 1 - eps)))))
    return normalise(q)


def mix(ps: list[Column], weights: list[float]) -> Column:
    """Weighted sum of cleaned probability arrays, cleaned again."""
    scaled = [F.transform(clean_probs(p), lambda x: x * F.lit(float(w))) for p, w in zip(ps, weights, strict=True)]  # noqa: B023
    out = scaled[0]
    for other in scaled[1:]:
        out = F.zip_with(out, other, lambda a, b: a + b)
    return clean_probs(out)


def floor_probs(p: Column, target: Column, low: float = 5e-7, eps: float = 1e-12) -> Column:
    """Raise probabilities to ``low`` and keep their sum at ``target`` (at most 1): the excess is taken from what
    lies above the floor in proportion."""
    n = F.size(p)
    flat = lambda v: F.transform(p, lambda x: v)

    def fit(s: Column) -> Column:
        goal, q = s["goal"], s["q"]
        excess, room = total(q) - goal, total(q) - n * low
        lowered = let(F.struct(excess.alias("e"), room.alias("r")), lambda t: F.transform(q, lambda x: F.greatest(x - t["e"] * (x - low) / t["r"], F.lit(low))))
        return (
            F.when(goal <= eps, flat(_zero())).when(goal < n * low, flat(goal / n)).when(excess <= eps, q).when(room <= eps, flat(goal / n)).otherwise(lowered)
        )

    goal = F.least(F.when(target >= 0, target).otherwise(0.0), F.lit(1.0))
    raised = F.transform(p, lambda x: F.greatest(F.coalesce(x, _zero()), F.lit(low)))
    return let(F.struct(goal.alias("goal"), raised.alias("q")), fit)
