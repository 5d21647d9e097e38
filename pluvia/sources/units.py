"""Tables of units: weights, reference onsets, thresholds on a grid and observed onsets, with their checks.

Ids are text, trimmed; checks raise with some of the rows that break them and bring no other rows to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import grid_id, normal_id, require_columns
from ..operators.export import flexible_date
from .files import read_units


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Renames columns whatever the case of the old names; names that are not there are ignored."""
    wanted = {old.lower(): new for old, new in names.items()}
    return df.toDF(*[wanted.get(c.lower(), c) for c in df.columns])


def _forbid(bad: DataFrame, what: str) -> None:
    if some := [tuple(r) for r in bad.limit(5).collect()]:
        raise ValueError(f"{what}, such as {some}")


def cell_transform(table: DataFrame) -> DataFrame:
    """source_id, target_id, weight of a long table of weights: finite, not negative, one row a pair, something of each target;
    rows of weight zero are dropped."""
    require_columns(table, ["source_id", "target_id", "weight"], "weights")
    rows = table.select(normal_id(F.col("source_id")).alias("source_id"), normal_id(F.col("target_id")).alias("target_id"), F.col("weight").try_cast("double").alias("weight"))
    w = F.col("weight")
    fine = F.coalesce(~F.isnan(w) & (w >= 0) & (w < float("inf")), F.lit(False)) & F.col("source_id").isNotNull() & F.col("target_id").isNotNull()
    _forbid(rows.filter(~fine), "weights must be finite and not negative, with both ids")
    _forbid(rows.groupBy("source_id", "target_id").count().filter("count > 1"), "pairs with several weights")
    _forbid(rows.groupBy("target_id").agg(F.sum("weight").alias("total")).filter("total <= 0"), "targets without any weight")
    return rows.filter(w > 0)


def read_cell_transform(spark: SparkSession, path: str) -> DataFrame:
    return cell_transform(spark.read.csv(path, header=True))


def regrid_weights(table: DataFrame, legacy: str = "adm3_name") -> DataFrame:
    """latitude, longitude, target_id, weight; the target may be in ``legacy``, and where both are they must agree."""
    have = [c for c in ("target_id", legacy) if c in table.columns]
    if not have:
        raise ValueError(f"weights need target_id or {legacy}")
    lat, lon = ("latitude" if "latitude" in table.columns else "lat"), ("longitude" if "longitude" in table.columns else "lon")
    require_columns(table, [lat, lon, "weight"], "weights")
    if len(have) == 2:
        _forbid(table.filter(~normal_id(F.col(have[0])).eqNullSafe(normal_id(F.col(have[1])))).select(*have), f"target_id and {legacy} disagree")
    rows = table.select(F.col(lat).cast("double").alias("latitude"), F.col(lon).cast("double").alias("longitude"), normal_id(F.col(have[0])).alias("target_id"), F.col("weight").cast("double").alias("weight"))
    _forbid(rows.groupBy("latitude", "longitude", "target_id").count().filter("count > 1"), "repeated cells of a target")
    return rows


def reference_onsets(table: DataFrame, base: str = "05-01", unit: str | None = None, year: str | None = None, date: str | None = None, day: str | None = None, first_year: int = 0) -> DataFrame:
    """ref_onset_date by unit, by year or by both, from a column of dates or of days after ``base`` (which needs the year).

    Rows without a date leave; of equal rows one stays; a key with several dates is an error."""
    if not (unit or year) or bool(date) == bool(day) or (day and not year):
        raise ValueError("reference onsets need a unit or a year, and a date or, with a year, a day")
    keys = [*([normal_id(F.col(unit)).alias("id")] if unit else []), *([F.col(year).cast("int").alias("year")] if year else [])]
    first = F.to_date(F.concat_ws("-", F.col(year).cast("int"), F.lit(base))) if year else None
    when = flexible_date(F.col(date)) if date else F.date_add(first, F.col(day).cast("int"))
    rows = table.select(*keys, when.alias("ref_onset_date")).filter("ref_onset_date IS NOT NULL").distinct()
    names = [c for c in ("id", "year") if c in rows.columns]
    _forbid(rows.groupBy(*names).count().filter("count > 1").select(*names), "keys with several reference onsets")
    return rows.filter(F.col("year") >= first_year) if year and first_year else rows


def grid_thresholds(cells: DataFrame, x: str, digits: int = 2) -> DataFrame:
    """id (of the coordinates), threshold from a gridded scan: the mean of a cell's values; cells without any leave."""
    found = cells.filter(F.col(x).isNotNull()).groupBy("lat", "lon").agg(F.avg(x).alias("threshold"))
    return found.select(grid_id(F.col("lat"), F.col("lon"), digits, half_even=digits <= 6).alias("id"), "threshold")


def read_onsets(spark: SparkSession, path: str, date: str = "true_onset") -> DataFrame:
    """id, true_onset of a CSV of observed onsets with the day first; rows without a date leave, repeated rows are one."""
    rows = read_units(spark, path)
    return rows.select("id", flexible_date(F.nullif(F.trim(date), F.lit("NaT")), day_first=True).alias("true_onset")).filter("true_onset IS NOT NULL").distinct()
