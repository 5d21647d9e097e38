"""Sources and sinks: file discovery by year, CSV tables, Parquet stages, NetCDF through a Python data source."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

YEAR = "(?:19|20)\\d{2}"


def discover(spark: SparkSession, folder: str, pattern: str = ".*", min_year: int = 0, max_year: int = 9999) -> DataFrame:
    """path, year of the files whose name matches; the year is the first 19xx or 20xx in the name.  Contents are
    not read.  Raises if none is left."""
    name = F.substring_index("path", "/", -1)
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
        .filter(name.rlike(pattern)).withColumn("year", F.regexp_extract(name, f"({YEAR})", 1).try_cast("int"))
        .filter(F.col("year").between(min_year, max_year)).select("path", "year")
    )
    if found.isEmpty():
        raise FileNotFoundError(f"{folder}: no file matches {pattern!r} from {min_year} to {max_year}")
    return found


def read_units(spark: SparkSession, path: str, id_col: str | None = None) -> DataFrame:
    """A unit CSV with its id column as ``id``: the named one, else id, adm3_name, lat and lon, or the first."""
    df = spark.read.csv(path, header=True, inferSchema=False)
    for name in filter(None, (id_col, "id", "adm3_name")):
        if name in df.columns:
            return df.withColumn("id", F.trim(name)).filter("id <> ''")
    if {"lat", "lon"} <= set(df.columns):
        return df.withColumn("id", F.concat_ws("_", F.trim("lat"), F.trim("lon")))
    return df.withColumn("id", F.trim(df.columns[0])).filter("id <> ''")


def read_thresholds(spark: SparkSession, source: str | float) -> DataFrame | float:
    """A number, or a CSV with ids and a threshold column."""
    try:
        return float(source)
    except ValueError:
        df = read_units(spark, source)
        value = next((c for c in df.columns if c.startswith("onset_thresh")), None)
        if value is None:
            raise ValueError(f"{source}: no onset_thresh column in {df.columns}") from None
        return df.select("id", F.col(value).try_cast("double").alias("threshold"))


def read_reference_onsets(spark: SparkSession, source: str, base: str = "05-01", year_col: str = "Year", day_col: str = "MOK") -> DataFrame | str:
    """A month-day, or a CSV of years with days after ``base``; a table of year, ref_onset_date."""
    if re.fullmatch("\\d\\d-\\d\\d", source):
        return source
    df = spark.read.csv(source, header=True)
    first = F.to_date(F.concat_ws("-", F.col(year_col), F.lit(base)))
    return df.select(F.col(year_col).cast("int").alias("year"), F.date_add(first, F.col(day_col).cast("int")).alias("ref_onset_date"))


def write_stage(df: DataFrame, path: str, by: str | None = "year") -> DataFrame:
    """Parquet, partitioned by year where there is one, for partition pruning in later stages."""
    out = df.write.mode("overwrite")
    (out.partitionBy(by) if by in df.columns else out).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV for people: for exports of a few thousand rows."""
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


class _Part(InputPartition):
    def __init__(self, path: str):
        self.path = path


class NetcdfReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = options["paths"].split(",")
        self.variable, self.day = options.get("variable", "rain"), options.get("day_dim", "day")

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for p in self.paths]

    def read(self, part: _Part) -> Iterator[tuple]:
        import netCDF4  # optional; only executors that read NetCDF need it

        with netCDF4.Dataset(part.path) as data:
            v, time = data.variables[self.variable], data.variables["time"]
            dates = netCDF4.num2date(time[:], time.units, only_use_cftime_datetimes=False, only_use_python_datetimes=True)
            lat, lon = data.variables["lat"][:], data.variables["lon"][:]
            order = [v.dimensions.index(d) for d in ("time", "lat", "lon", self.day)]
            for t, date in enumerate(dates):  # one issue date in memory at a time
                at: list = [slice(None)] * v.ndim
                at[order[0]] = t
                grid = v[tuple(at)].transpose([order[k] - (order[k] > order[0]) for k in (1, 2, 3)])
                for i, y in enumerate(lat):
                    for j, x in enumerate(lon):
                        yield date.date(), float(y), float(x), [None if m is None or m != m else float(m) for m in grid[i, j].tolist()]


class NetcdfSource(DataSource):
    """spark.dataSource.register(NetcdfSource); spark.read.format("gridded_netcdf").option("paths", …).load()"""

    @classmethod
    def name(cls) -> str:
        return "gridded_netcdf"

    def schema(self) -> str:
        return "time date, lat double, lon double, rain array<double>"

    def reader(self, schema) -> NetcdfReader:
        return NetcdfReader(self.options)
