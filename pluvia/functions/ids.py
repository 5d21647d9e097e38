"""Spatial ids: normalisation, coordinate formatting and parsing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normal_id(x: Column) -> Column:
    """Trimmed text; NULL for empty ids.  Ids are never read as numbers: leading zeros stay."""
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def round_binary(x: Column, digits: int) -> Column:
    """The decimal of up to six ``digits`` next to the double's binary value, ties to even, as Python's round."""
    size = F.abs(x.cast("double"))
    scaled = (size - F.floor(size)) * float(1 << 60)  # exact: a power of two
    units, one = F.floor(scaled), F.lit(1 << 60).cast("decimal(38,0)")
    more = (units.cast("decimal(20,0)") * F.lit(10**digits).cast("decimal(7,0)")).cast("decimal(38,0)")
    left = more % one
    down = ((more - left) / one).cast("long")
    half = F.lit(1 << 59).cast("decimal(38,0)")
    up = (left > half) | ((left == half) & ((scaled > units.cast("double")) | (down % 2 == 1) if digits else (scaled > units.cast("double")) | (F.floor(size) % 2 == 1)))
    n = F.floor(size) * 10**digits + down + up.cast("long")
    whole = F.when(x < 0, -n).otherwise(n)
    return (whole.cast("decimal(20,0)") * F.lit(10.0**-digits).cast(f"decimal(7,{digits})")).cast(f"decimal(20,{digits})")


def format_coordinate(x: Column, digits: int, fixed: bool = False, half_even: bool = False) -> Column:
    """Rounded to ``digits``, with trailing zeros or trimmed; minus zero is zero.  ``half_even`` rounds as the reference."""
    rounded = round_binary(x, digits) if half_even else F.round(x, digits).cast(f"decimal(20,{digits})")
    text = rounded.cast("string")
    if not fixed and digits:
        text = F.regexp_replace(F.regexp_replace(text, "0+$", ""), "\\.$", "")
    return F.when(text.rlike("^-0(\\.0*)?$"), F.substring(text, 2, 40)).otherwise(text)


def grid_id(lat: Column, lon: Column, digits: int = 2, fixed: bool = False, half_even: bool = False) -> Column:
    return F.concat_ws("_", format_coordinate(lat, digits, fixed, half_even), format_coordinate(lon, digits, fixed, half_even))


def parse_grid_id(id_: Column) -> tuple[Column, Column]:
    """(lat, lon) of a "<lat>_<lon>" id; NULL for other ids and values out of range."""
    part = F.split(id_, "_")
    lat, lon = (F.when(F.size(part) == 2, F.get(part, F.lit(i)).try_cast("double")) for i in (0, 1))
    return F.when(F.abs(lat) <= 90, lat), F.when(F.abs(lon) <= 360, lon)


def require_columns(df: DataFrame, names: list[str], what: str = "table") -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; it has {df.columns}")
    return df


def collisions(df: DataFrame, id_col: str, keys: list[str]) -> DataFrame:
    """Ids that stand for several coordinates."""
    return df.select(id_col, *keys).distinct().groupBy(id_col).count().filter("count > 1")


def least_gap(df: DataFrame, c: str) -> float | None:
    """Least distance of neighbouring distinct values of a column; None for fewer than two.

    Values are cut by range: each part has its own least gap, its first and its last value."""
    from ..operators.relations import cut

    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.select(F.col(c).alias("v")).filter("v IS NOT NULL").distinct().repartitionByRange(parts, "v").withColumn("part", F.spark_partition_id()))
    step = F.lead("v").over(Window.partitionBy("part").orderBy("v")) - F.col("v")
    ends = placed.withColumn("d", step).groupBy("part").agg(F.min("d").alias("d"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    between = F.lead("lo").over(Window.partitionBy().orderBy("part")) - F.col("hi")  # a row a part
    return ends.select(F.least("d", between).alias("d")).agg(F.min("d")).first()[0]


def infer_digits(cells: DataFrame, lat: str = "lat", lon: str = "lon", most: int = 12, error: float = 1e-4) -> int:
    """Least number of digits that is off by at most ``error`` of the grid's spacing, so that no two cells share an id.

    Spark gives one row: the largest rounding error for each number of digits."""
    pairs = cells.select(F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).distinct()
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    off = lambda c, k: F.max(F.abs(F.round(c, k) - F.col(c)))
    got = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_if(~(finite("lat") & finite("lon"))).alias("bad"), F.max(F.greatest(F.abs("lat"), F.abs("lon"))).alias("size"),
                    *[F.greatest(off("lat", k), off("lon", k)).alias(f"off{k}") for k in range(most + 1)]).first()
    if not got["n"] or got["bad"]:
        raise ValueError("grid ids need coordinates that are all finite")
    steps = [gap for c in ("lat", "lon") if (gap := least_gap(pairs, c)) is not None]
    allowed = min(steps) * error if steps else max(1.0, got["size"]) * 1e-6
    for k in range(most + 1):
        if got[f"off{k}"] <= allowed:
            return k
    raise ValueError(f"no number of digits up to {most} gives ids without collisions")


@dataclass(frozen=True)
class GridIds:
    """How the ids of a grid are written: number of digits, with trailing zeros or trimmed, and where that comes from."""

    digits: int
    fixed: bool = False
    source: str = "inferred"

    def __post_init__(self):
        if not 0 <= self.digits <= 15:
            raise ValueError("the number of digits must be from 0 to 15")


def grid_ids(cells: DataFrame, established: GridIds | None = None, digits: int | None = None, fixed: bool | None = None) -> GridIds:
    """What earlier stages established goes before what is set explicitly, and that before what the cells need.

    An explicit form without a number of digits is an error, and so is one that contradicts what is established."""
    if digits is None and fixed is not None:
        raise ValueError("a form of ids needs a number of digits")
    explicit = None if digits is None else GridIds(digits, bool(fixed), "explicit")
    if established is not None:
        if explicit is not None and (explicit.digits, explicit.fixed) != (established.digits, established.fixed):
            raise ValueError(f"ids have {established.digits} digits, not {explicit.digits}, or another form")
        return established
    return explicit or GridIds(infer_digits(cells))
