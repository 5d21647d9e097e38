"""Checks of tables before fits: rainfall horizons, features, issue dates; each raises one error with samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def horizon_policy(day_max: int, rain_day_max: int | None = None, policy: str | None = None) -> tuple[int, str]:
    """(rain days, policy).  Without an explicit number it is ``day_max`` + 10 and ``legacy``; with one ``exact`` or
    ``truncate``."""
    explicit = rain_day_max is not None
    days = rain_day_max if explicit else day_max + 10
    if isinstance(days, bool) or not isinstance(days, int) or days < 1:
        raise ValueError(f"the number of rain days must be a positive integer, not {days!r}")
    chosen = (policy or ("exact" if explicit else "legacy")).strip().lower()
    allowed = ("exact", "truncate") if explicit else ("legacy",)
    if chosen not in allowed:
        raise ValueError(f"horizon policy {chosen!r}: {'with' if explicit else 'without'} explicit rain days it must be one of {allowed}")
    return days, chosen


def horizon_gaps(df: DataFrame, rain: str, days: int, policy: str) -> DataFrame:
    """Rows whose rain array breaks the policy, with ``problem``: too short, too long (exact), or a missing value within
    ``days`` (exact and truncate)."""
    strict = policy != "legacy"
    n = F.coalesce(F.size(rain), F.lit(0))
    hole = F.exists(F.slice(rain, 1, days), lambda x: x.isNull() | F.isnan(x)) if strict else F.lit(False)
    problem = F.when(n < days, "too short").when(F.lit(policy == "exact") & (n > days), "too long").when(hole, "missing value")
    return df.withColumn("problem", problem).filter("problem IS NOT NULL")


def require_horizon(df: DataFrame, rain: str, days: int, policy: str, keys: list[str], sample: int = 5) -> DataFrame:
    bad = horizon_gaps(df, rain, days, policy).select(*keys, "problem").limit(sample).collect()
    if bad:
        raise ValueError(f"rain of days 1..{days} ({policy}) fails for rows such as {[tuple(r) for r in bad]}")
    return df


def feature_support(df: DataFrame, columns: list[str]) -> DataFrame:
    """column -> n_finite: values that are neither NULL nor NaN."""
    finite = lambda c: F.count_if(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return df.agg(*[finite(c).alias(c) for c in columns]).withColumn("_", F.lit(0)).unpivot("_", columns, "column", "n_finite").drop("_")


def require_features(df: DataFrame, formulas: dict[str, list[str]], unavailable: dict[str, str] | None = None) -> None:
    """One error for all predictors that are missing or have no finite value; ``unavailable`` explains some of them."""
    wanted = list(dict.fromkeys(c for cs in formulas.values() for c in cs))
    present = [c for c in wanted if c in df.columns]
    counts = {r["column"]: r["n_finite"] for r in feature_support(df, present).collect()} if present else {}
    problems = []
    for name, columns in formulas.items():
        if lost := [c for c in columns if c not in counts]:
            problems.append(f"{name}: missing columns {lost}")
        problems += [f"{name}: {c}: {(unavailable or {}).get(c, 'no finite values')}" for c in columns if counts.get(c) == 0]
    if problems:
        raise ValueError("features: " + "; ".join(problems))


def issued_on(df: DataFrame, date: str, time: str = "time") -> DataFrame:
    """Rows of one issue date; an error lists some of the dates there are."""
    out = df.filter(F.col(time) == F.lit(date).cast("date"))
    if out.isEmpty():
        there = [str(r[0]) for r in df.select(time).distinct().orderBy(time).limit(20).collect()]
        raise ValueError(f"no rows were issued on {date}; there are {there}")
    return out


def valid_cells(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Cells with a finite value on any of their other dimensions."""
    return df.groupBy(*keys).agg(F.max(F.coalesce((F.col(x).isNotNull() & ~F.isnan(x)).cast("int"), F.lit(0))).alias("_ok")).filter("_ok = 1").drop("_ok")


def half_spacing(df: DataFrame, coordinate: str, default: float = 0.125) -> float:
    """Half of the step between the two smallest coordinates; ``default`` for a single one."""
    two = [r[0] for r in df.select(coordinate).distinct().orderBy(coordinate).limit(2).collect()]
    return (two[1] - two[0]) / 2 if len(two) == 2 else default
