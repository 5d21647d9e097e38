"""Exports and district messages from bin probabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def wide_bins(p: Column, names: list[str], prefix: str = "") -> list[Column]:
    return [F.get(p, F.lit(i)).alias(f"{prefix}{n}") for i, n in enumerate(names)]


def summary(df: DataFrame, weeks: int) -> DataFrame:
    """id, time as M/D/YY, week1…, later, clim_week1…, clim_later from the arrays p and clim."""
    names = [*[f"week{w}" for w in range(1, weeks + 1)], "later"]
    return df.select("id", F.date_format("time", "M/d/yy").alias("time"), *wide_bins(F.col("p"), names), *wide_bins(F.col("clim"), names, "clim_"))


#: Fixed values: (category, first week, last week, least chance) in the order of trial.
SPANS = ((1, 1, 1, 0.70), (1, 1, 2, 0.70), (1, 2, 3, 0.65), (2, 2, 4, 0.65), (2, 3, 4, 0.60))


def categorise(p: Column, spans: tuple = SPANS, weeks: int = 4) -> Column:
    """struct(category, first_week, last_week, chance) of the first span that reaches its chance; else category 3
    (uncertain) with the most likely week."""
    pack = lambda c, first, last, chance: F.struct(F.lit(c).alias("category"), first.alias("first_week"), last.alias("last_week"), chance.alias("chance"))
    head = F.slice(p, 1, weeks)
    best = F.array_position(head, F.array_max(head)).cast("int")
    out = pack(3, best, best, F.array_max(head))
    for category, first, last, least in reversed(spans):
        chance = sum((F.get(p, F.lit(w - 1)) for w in range(first + 1, last + 1)), F.get(p, F.lit(first - 1)))
        out = F.when(chance >= least, pack(category, F.lit(first), F.lit(last), chance)).otherwise(out)
    return out


def week_dates(issue: Column, first: Column, last: Column) -> tuple[Column, Column]:
    """First and last day of a span of weeks: leads 1 to 7 are week 1."""
    return F.date_add(issue, (first - 1) * 7 + 1), F.date_add(issue, last * 7)


def message(district: Column, category: Column, chance: Column, start: Column, end: Column) -> Column:
    """One text for each category; percents round half to even."""
    percent = F.bround(chance * 100).cast("int").cast("string")
    lead = F.when(category == 1, ": season onset expected ").when(category == 2, ": season onset expected later, ").otherwise(": onset uncertain; most likely ")
    return F.concat(district, lead, F.date_format(start, "MMM dd"), F.lit(" to "), F.date_format(end, "MMM dd"), F.lit(" ("), percent, F.lit("%)"))


def day_label(year: Column, day_of_season: Column, start: str = "05-01") -> Column:
    """ "Mon DD" of a day counted from the season's start."""
    return F.date_format(F.date_add(F.to_date(F.concat_ws("-", year.cast("string"), F.lit(start))), day_of_season), "MMM dd")


def flexible_date(text: Column, day_first: bool = False) -> Column:
    forms = ["yyyy-MM-dd", "d/M/yyyy" if day_first else "M/d/yyyy", "d/M/yy" if day_first else "M/d/yy", "yyyyMMdd"]
    return F.coalesce(*[F.try_to_date(text, f) for f in forms])


def join_codes(df: DataFrame, codes: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(with the code, ids without one)."""
    out = df.join(codes, key, "left")
    return out, out.filter(F.col([c for c in codes.columns if c != key][0]).isNull()).select(key).distinct()
