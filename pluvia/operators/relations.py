"""Joins, filters and set operations between the engine's tables, with their checks."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.ids import normal_id, parse_grid_id


def parse_years(text: str | None) -> list[int]:
    """ "2001,2003:2005" -> [2001, 2003, 2004, 2005]; empty means no filter."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in (text or "").split(","))):
        low, _, high = part.partition(":")
        out.update(range(int(low), int(high or low) + 1))
    return sorted(out)


def filter_years(df: DataFrame, years: list[int] | None, col: str = "year") -> DataFrame:
    return df.filter(F.col(col).isin(years)) if years else df


def missing_ids(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def conflicts(table: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with several different values."""
    return table.groupBy(key).agg(F.count_distinct(value).alias("n")).filter("n > 1").select(key)


def attach_thresholds(df: DataFrame, thresholds: DataFrame | float, key: str = "id", strict: bool = True) -> DataFrame:
    """Adds ``threshold``; a number holds for all.  Strict: raises for ids without one or with conflicting ones."""
    if isinstance(thresholds, (int, float)):
        return df.withColumn("threshold", F.lit(float(thresholds)))
    if strict:
        for what, bad in (("conflicting thresholds", conflicts(thresholds, key, "threshold")), ("no threshold", missing_ids(df, thresholds, key))):
            if some := [r[0] for r in bad.limit(5).collect()]:
                raise ValueError(f"{what} for ids such as {some}")
    return df.join(thresholds.dropDuplicates([key]), key, "left")


def attach_reference(df: DataFrame, reference: DataFrame | str, year: str = "year") -> DataFrame:
    """Adds ``ref_onset_date``: from a table by the keys it shares with ``df``, or a month-day of each year."""
    if isinstance(reference, str):
        return df.withColumn("ref_onset_date", month_day(F.col(year), reference))
    keys = [k for k in ("id", "year") if k in reference.columns and k in df.columns]
    return df.join(reference.select(*keys, "ref_onset_date"), keys, "left")


def month_day(year: Column, text: str) -> Column:
    return F.to_date(F.concat_ws("-", year.cast("string"), F.lit(text)))


def keep_units(df: DataFrame, units: DataFrame, key: str = "id") -> DataFrame:
    return df.join(units.select(key), key, "left_semi")


def inside(lat: Column, lon: Column, south: float, north: float, west: float, east: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)


def outside_map_domain(lat: Column, lon: Column) -> Column:
    """The corners that maps leave out."""
    return (lon > 90) | ((lon < 75) & (lat < 12))


def missing_policy(df: DataFrame, policy: str, series: list[str], x: str = "x") -> DataFrame:
    """keep; zero: missing is 0; drop: a series with a missing day goes as a whole."""
    if policy == "keep":
        return df
    if policy == "zero":
        return df.withColumn(x, F.coalesce(x, F.lit(0.0)))
    if policy != "drop":
        raise ValueError(f"unknown policy {policy!r}")
    hole = F.max(F.col(x).isNull().cast("int")).over(Window.partitionBy(*series))
    return df.withColumn("_hole", hole).filter("_hole = 0").drop("_hole")


def gaps(df: DataFrame, series: list[str], time: str = "time") -> DataFrame:
    """Rows that do not follow their predecessor by one day."""
    before = F.lag(time).over(Window.partitionBy(*series).orderBy(time))
    return df.withColumn("_step", F.datediff(time, before)).filter("_step <> 1").drop("_step")


def first_on_or_after(df: DataFrame, keys: list[str], time: str, start: Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(F.when(F.col(time) >= start, F.col(time))).alias("first_time"))


def keep_first(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union of overlapping sources; of rows with equal keys that of the first source stays."""
    out = None
    for i, s in enumerate(sources):
        part = s.withColumn("_source", F.lit(i))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_source"))
    return out.withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_source")


def combine(tables: list[DataFrame], keys: list[str], how: str = "inner") -> DataFrame:
    if how not in ("inner", "full"):
        raise ValueError("how must be inner or full")
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, keys, how)
    return out


def trim_after_onset(df: DataFrame, time: str = "time", onset: str = "true_onset_date") -> DataFrame:
    return df.filter(F.col(onset).isNull() | (F.col(time) <= F.col(onset)))


def forecast_window(date: Column, horizons: list[tuple[str, str, int]]) -> Column:
    """Horizon of the first month-day range that holds the date; NULL outside all."""
    md, out = F.date_format(date, "MM-dd"), F.lit(None).cast("int")
    for start, end, days in reversed(horizons):
        out = F.when(md.between(start, end), days).otherwise(out)
    return out


def scratch(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); local sessions without one take a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(base or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The table written once as Parquet in the shared folder, see :func:`scratch`, and read back: the lineage is cut."""
    path = f"{scratch(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nearest(points: DataFrame, targets: DataFrame, key: str, target_key: str, cell: float | None = None) -> DataFrame:
    """key, nearest target (the least key of ties) and ``gap``, the squared degrees to it; NULL without any target and for
    points without both coordinates (NULL or NaN); such targets are ignored.

    Points meet the targets of their coarse cell and its neighbours.  What lies outside of those is more than a cell
    away, so a target within a cell is the nearest of all; the other points go on with cells of four times the size.  The
    first size is such that a cell has about one target."""
    placed = lambda df: df.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"))
    targets = placed(targets)
    size = cell
    if size is None:
        t = targets.agg(F.count(F.lit(1)), F.max("lat") - F.min("lat"), F.max("lon") - F.min("lon")).first()
        size = max(1e-3, (max(t[1], 1e-3) * max(t[2], 1e-3) / t[0]) ** 0.5) if t[0] else 1000.0
    step = F.explode(F.expr("sequence(-1, 1)"))
    near = lambda p, t, size: (
        p.withColumn("_i", F.floor(F.col("lat") / size)).withColumn("_j", F.floor(F.col("lon") / size)).join(
            t.withColumn("_di", step).withColumn("_dj", step).select(
                target_key, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"),
                (F.floor(F.col("lat") / size) + F.col("_di")).alias("_i"), (F.floor(F.col("lon") / size) + F.col("_dj")).alias("_j")), ["_i", "_j"]))
    gap = F.pow(F.col("lat") - F.col("_lat"), 2) + F.pow(F.col("lon") - F.col("_lon"), 2)
    every, rest, out = points.select(key), placed(points.select(key, "lat", "lon")), []
    while not rest.isEmpty():
        found = cut(near(rest, targets, size).groupBy(key).agg(F.min_by(target_key, F.struct(gap, target_key)).alias(target_key), F.min(gap).alias("gap")))
        if size > 720:  # the whole globe is within three cells
            out.append(found)
            break
        sure = found.filter(F.col("gap") <= size * size)
        out.append(sure)
        rest = cut(rest.join(sure.select(key), key, "left_anti"))
        size *= 4
    none = every.limit(0).select(key, F.lit(None).cast(dict(targets.dtypes)[target_key]).alias(target_key), F.lit(None).cast("double").alias("gap"))
    return every.join(reduce(DataFrame.unionByName, out, none), key, "left")


def overlap_rule(how: str, x: str = "x", lead: str = "lead") -> Column:
    """Aggregate that picks one of overlapping forecasts: that of the nearest (least) lead, of the longest, or the mean."""
    pick = {"nearest": F.min_by(x, lead), "longest": F.max_by(x, lead), "first": F.max_by(x, lead), "mean": F.avg(x)}
    if how not in pick:
        raise ValueError(f"unknown overlap rule {how!r}")
    return pick[how]


def resolve_overlap(df: DataFrame, keys: list[str], how: str, x: str = "x", lead: str = "lead") -> DataFrame:
    """One value per valid date of overlapping forecasts."""
    return df.groupBy(*keys).agg(overlap_rule(how, x, lead).alias(x))


def common_support(df: DataFrame, predictors: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all predictors, missing values per predictor)."""
    lost = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in predictors])
    return df.na.drop(subset=predictors), lost.unpivot("n_rows", predictors, "predictor", "n_missing")


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent digest: rows, and per number column its sum and missing values."""
    numbers = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float")]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in numbers],
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in numbers])


def row_hash(df: DataFrame) -> Column:
    """SHA-256 of a row's values by column name; NULL, empty and neighbouring values never look alike."""
    value = lambda c: F.coalesce(F.concat(F.length(F.col(f"`{c}`").cast("string")).cast("string"), F.lit(":"), F.col(f"`{c}`").cast("string")), F.lit("-"))
    return F.sha2(F.concat_ws(",", *[value(c) for c in sorted(df.columns)]), 256)


def multiset_fingerprint(df: DataFrame) -> DataFrame:
    """n_rows and a hash of the table as a multiset of whole rows, whatever their order and that of the columns.

    A row's SHA-256 is cut into eight limbs of 32 bits; the limbs are summed over all rows, in decimals that cannot
    overflow, and the sums and column names are hashed.  So swapped values and repeated rows show; one pass, no sort."""
    limbs = df.select(row_hash(df).alias("_h")).select(*[F.conv(F.substring("_h", 8 * k + 1, 8), 16, 10).cast("decimal(20,0)").alias(f"_{k}") for k in range(8)])
    sums = limbs.agg(F.count(F.lit(1)).alias("n_rows"), *[F.coalesce(F.sum(f"_{k}"), F.lit(0)).cast("decimal(38,0)").cast("string").alias(f"_{k}") for k in range(8)])
    return sums.select("n_rows", F.sha2(F.concat_ws("|", F.lit(",".join(sorted(df.columns))), *[F.col(f"_{k}") for k in range(8)]), 256).alias("hash"))


def shared_ids(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Distinct keys that both tables have; NULL is a key."""
    return left.select(key).intersect(right.select(key))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """``df``; raises if nothing is left of it."""
    if df.isEmpty():
        raise ValueError(f"nothing is left after {what}")
    return df


def before_onset(days: DataFrame, onsets: DataFrame, keys: list[str], day: str = "d", onset: str = "onset_idx") -> DataFrame:
    """Days strictly before their key's onset; keys without a row or date of onset leave."""
    return days.join(onsets.select(*keys, F.col(onset).alias("_onset")), keys).filter(F.col(day) < F.col("_onset")).drop("_onset")


def join_constants(main: DataFrame, constants: list[DataFrame], key: str = "id") -> DataFrame:
    """Adds the columns of the constant tables: these meet in full outer joins, then join the main rows."""
    if not constants:
        return main
    return main.join(reduce(lambda a, b: a.join(b, key, "full"), constants), key, "left")


def attach_messages(units: DataFrame, messages: DataFrame, key: str = "id") -> DataFrame:
    """Every unit with its message, if it has one; ids are compared trimmed, empty ids match nothing."""
    own = messages.withColumn("_id", normal_id(F.col(key))).drop(key)
    return units.join(own, normal_id(units[key]) == F.col("_id"), "left").drop("_id")


def extract_series(
    rows: DataFrame, lat: float, lon: float, year: int, cutoff: str = "01-01", max_days: int | None = None,
    member: int | None = None, overlap: str = "nearest", x: str = "x",
) -> DataFrame:
    """time, day, x of the cell nearest to a place (ties: least lat, lon): the days of ``year`` from ``cutoff`` (month-day) on.

    Rows have time, lat, lon and x; forecasts have lead as well, whose overlaps are resolved by :func:`overlap_rule`, and
    perhaps number, of which ``member`` is taken or, without one, the mean.  day counts from the cutoff, from 1."""
    away = F.pow(F.col("lat") - lat, F.lit(2.0)) + F.pow(F.col("lon") - lon, F.lit(2.0))
    spot = rows.select("lat", "lon").distinct().orderBy(away, "lat", "lon").limit(1)
    first = F.to_date(F.lit(f"{year}-{cutoff}"))
    day = F.datediff("time", first) + 1
    own = rows.join(F.broadcast(spot), ["lat", "lon"]).withColumn("day", day).filter((F.year("time") == year) & (F.col("day") >= 1))
    own = own if max_days is None else own.filter(F.col("day") <= max_days)
    if "number" in rows.columns:
        own = own.filter(F.col("number") == member) if member is not None else own
    keys = ["time", "day"] + [c for c in ("number", "lead") if c in rows.columns]
    own = own.groupBy(*keys).agg(F.avg(x).alias("x"))
    if "number" in rows.columns:
        own = own.groupBy(*[k for k in keys if k != "number"]).agg(F.avg("x").alias("x"))
    return resolve_overlap(own, ["time", "day"], overlap) if "lead" in rows.columns else own


def compare_models(table: DataFrame, value: str, left: str, right: str, key: str = "id", model: str = "model") -> DataFrame:
    """key, value_x, value_y, difference of two models' rows, for every key of either: one pass in place of a self-join."""
    pick = lambda m: F.max(F.when(F.col(model) == m, F.col(value)))
    both = table.filter(F.col(model).isin(left, right)).groupBy(key).agg(pick(left).alias(f"{value}_x"), pick(right).alias(f"{value}_y"))
    return both.withColumn("difference", F.col(f"{value}_x") - F.col(f"{value}_y"))


def project_family(df: DataFrame, source: str, model: str, out: str) -> DataFrame:
    """Renames ``<source>_day_k`` to ``<model>_<out>_day_k``; other columns stay."""
    head = f"{source}_day_"
    return df.select(*[F.col(c).alias(f"{model}_{out}_day_{c[len(head):]}" if c.startswith(head) and c[len(head):].isdigit() else c) for c in df.columns])


def resolve_location(df: DataFrame, centroids: DataFrame, key: str = "id") -> DataFrame:
    """Adds lat and lon: own columns, else from a "<lat>_<lon>" id, else the unit's centroid."""
    parsed = parse_grid_id(F.col(key))
    own = [F.col(c) if c in df.columns else F.lit(None).cast("double") for c in ("lat", "lon")]
    rows = df.select(*[c for c in df.columns if c not in ("lat", "lon")], own[0].alias("_lat"), own[1].alias("_lon"))
    out = rows.join(centroids.select(key, F.col("lat").alias("_clat"), F.col("lon").alias("_clon")), key, "left")
    return out.withColumn("lat", F.coalesce("_lat", parsed[0], "_clat")).withColumn("lon", F.coalesce("_lon", parsed[1], "_clon")).drop("_lat", "_lon", "_clat", "_clon")
