"""Gridded daily series in classic NetCDF files (CDF-1 and CDF-2), as a Python data source that needs only NumPy.

    spark.dataSource.register(GridSource)
    spark.read.format("daily_grid").option("paths", "a.nc,b.nc").option("variable", "rain").load()

gives time, lat, lon, grid and the variable, one row a cell and day.  A file is planned as slabs of ``slab_days`` days; a slab
is one partition, read by position, and comes as Arrow batches of a day.  Bounds on time, lat and lon prune slabs and cells:
as options (``from``, ``to``, ``south``, ``north``, ``west``, ``east``, all inclusive), or as filters of the query, for which
the session must have ``spark.sql.python.filterPushdown.enabled`` (:func:`scan` sets it).  ``grid`` is a signature of the cells' coordinates at 1e-6 degrees, so
that files of one grid share weights.

Names of dimensions are matched in lower case, with their usual variants or by ``rename`` ("old:new,…"); time is decoded from
"<seconds, minutes, hours or days> since <origin>".  Fill values and NaN are NULL.  With ``daily`` (on unless "false") a
file's days must be contiguous within each year.  Paths may be of any file system that Arrow opens.
"""

from __future__ import annotations

import datetime
import hashlib
import io
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

_TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}
_NAMES = {"time": ("time", "t"), "lat": ("lat", "latitude", "y"), "lon": ("lon", "longitude", "x")}


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a path or URI."""
    path = re.sub("^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def opened(path: str):
    """A seekable file."""
    system, inner = located(path)
    return system.open_input_file(inner)


class Classic:
    """The header of a classic NetCDF file: dimensions, attributes, and where each variable's values are."""

    def __init__(self, file):
        self.file = file
        magic = file.read(4)
        if magic[:3] != b"CDF" or magic[3] not in (1, 2):
            raise ValueError("not a classic NetCDF file")
        self.wide = magic[3] == 2
        self.records = self._int()
        self.dims = [(self._name(), self._int()) for _ in range(self._count())]
        self.attributes = self._attributes()
        self.variables = {}
        for _ in range(self._count()):
            name, dims = self._name(), [self._int() for _ in range(self._int())]
            attributes, kind, size = self._attributes(), self._int(), self._int()
            self.variables[name] = {"dims": dims, "attributes": attributes, "kind": _TYPES[kind], "size": size, "begin": self._int(8 if self.wide else 4)}
        self.record_size = sum(v["size"] for v in self.variables.values() if v["dims"] and not self.dims[v["dims"][0]][1])

    def _int(self, n: int = 4) -> int:
        return int.from_bytes(self.file.read(n), "big")

    def _count(self) -> int:
        tag, n = self._int(), self._int()
        return n if tag else 0

    def _name(self) -> str:
        n = self._int()
        return self.file.read(-(-n // 4) * 4)[:n].decode()

    def _attributes(self) -> dict:
        out = {}
        for _ in range(self._count()):
            name, kind, n = self._name(), _TYPES[self._int()], self._int()
            size = np.dtype(kind).itemsize * n
            data = self.file.read(-(-size // 4) * 4)[:size]
            out[name] = data.decode().rstrip("\0") if kind == "S1" else np.frombuffer(data, kind).tolist()
        return out

    def shape(self, name: str) -> list[int]:
        return [self.dims[d][1] or self.records for d in self.variables[name]["dims"]]

    def read(self, name: str, first: int = 0, last: int | None = None) -> np.ndarray:
        """The values at positions first to last of the variable's first dimension."""
        v, shape = self.variables[name], self.shape(name)
        last = shape[0] if last is None else last
        inner = int(np.prod(shape[1:], dtype=np.int64)) * np.dtype(v["kind"]).itemsize
        record = not self.dims[v["dims"][0]][1]
        step = self.record_size if record else inner
        if step == inner:
            self.file.seek(v["begin"] + first * inner)
            data = self.file.read((last - first) * inner)
        else:
            parts = []
            for i in range(first, last):
                self.file.seek(v["begin"] + i * step)
                parts.append(self.file.read(inner))
            data = b"".join(parts)
        return np.frombuffer(data, v["kind"]).reshape([last - first, *shape[1:]])


def dates(values: np.ndarray, units: str | None) -> list[datetime.date]:
    """Days of CF time values."""
    m = re.match(r"^\s*(second|minute|hour|day)s?\s+since\s+(.+?)\s*$", units or "", re.I)
    if not m:
        raise ValueError(f"unknown time units {units!r}")
    origin = datetime.datetime.fromisoformat(m[2].replace("T", " ").rstrip("Z").strip() if len(m[2]) > 9 else m[2])
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[m[1].lower()]
    return [(origin + datetime.timedelta(seconds=float(t) * scale)).date() for t in values]


def check_daily(days: list[datetime.date], path: str) -> None:
    """Raises unless the days are one a day within each year."""
    ordered = sorted(days)
    for a, b in zip(ordered, ordered[1:], strict=False):
        if a == b:
            raise ValueError(f"{path}: {a} is there twice")
        if a.year == b.year and (b - a).days != 1:
            raise ValueError(f"{path}: the days are not contiguous, the first gap is {a} to {b}")


class Slab(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class GridReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p.strip() for p in options["paths"].split(",") if p.strip()]
        self.variable, self.slab = options.get("variable", "rain"), int(options.get("slab_days", 31))
        self.daily = options.get("daily", "true").lower() != "false"
        self.rename = dict(x.lower().split(":") for x in options.get("rename", "").split(",") if x)
        day = lambda k: datetime.date.fromisoformat(options[k]) if k in options else None
        number = lambda k: float(options[k]) if k in options else None
        self.bounds = {"time": [day("from"), day("to")], "lat": [number("south"), number("north")], "lon": [number("west"), number("east")]}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of time, lat and lon; strict ones are left to Spark as well."""
        for f in filters:
            own = getattr(f, "attribute", (None,))[0]
            if own in self.bounds and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                low, high = self.bounds[own]
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    low = f.value if low is None else max(low, f.value)
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    high = f.value if high is None else min(high, f.value)
                self.bounds[own] = [low, high]
                if not isinstance(f, (GreaterThan, LessThan)):
                    continue
            yield f

    def _within(self, name: str, values) -> np.ndarray:
        low, high = self.bounds[name]
        return np.array([(low is None or v >= low) and (high is None or v <= high) for v in values], bool)

    def _axes(self, head: Classic) -> dict[str, tuple[int, str]]:
        """time, lat and lon: position among the variable's dimensions, and name of the coordinate variable."""
        if self.variable not in head.variables:
            raise ValueError(f"no variable {self.variable!r}; the file has {sorted(head.variables)}")
        out = {}
        for k, d in enumerate(head.variables[self.variable]["dims"]):
            name = head.dims[d][0]
            known = self.rename.get(name.lower(), name.lower())
            own = next((c for c, names in _NAMES.items() if known in names), None)
            coordinate = next((v for v in head.variables if v.lower() == name.lower()), None)
            if own is None or coordinate is None:
                raise ValueError(f"dimension {name!r} is not known or has no coordinate")
            out[own] = (k, coordinate)
        if set(out) != set(_NAMES):
            raise ValueError(f"{self.variable!r} needs time, lat and lon; it has {sorted(out)}")
        return out

    def _days(self, head: Classic, axes: dict) -> list[datetime.date]:
        name = axes["time"][1]
        return dates(head.read(name).astype(float), head.variables[name]["attributes"].get("units"))

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            with opened(path) as file:
                head = Classic(file)
                axes = self._axes(head)
                days = self._days(head, axes)
            if self.daily:
                check_daily(days, path)
            inside = np.flatnonzero(self._within("time", days))
            if axes["time"][0]:  # days are not contiguous in the file, which is then read whole
                out += [Slab(path, 0, len(days))] if len(inside) else []
                continue
            out += [Slab(path, i, min(i + self.slab, len(days))) for i in range(0, len(days), self.slab) if ((inside >= i) & (inside < i + self.slab)).any()]
        return out

    def read(self, part: Slab) -> Iterator[pa.RecordBatch]:
        with opened(part.path) as file:
            head = Classic(file)
            axes = self._axes(head)
            days = self._days(head, axes)[part.first : part.last]
            lat, lon = (head.read(axes[c][1]).astype(float) for c in ("lat", "lon"))
            values = head.read(self.variable, *((part.first, part.last) if axes["time"][0] == 0 else (0, None)))
        values = values.transpose([axes[c][0] for c in ("time", "lat", "lon")]).astype(float)
        attributes = head.variables[self.variable]["attributes"]
        missing = np.isnan(values)
        for name in ("_FillValue", "missing_value"):
            if name in attributes:
                missing |= values == float(np.ravel(attributes[name])[0])
        signature = hashlib.sha256(b"|".join(np.round(c * 1e6).astype(np.int64).tobytes() for c in (lat, lon))).hexdigest()[:16]
        rows, columns = self._within("lat", lat), self._within("lon", lon)
        y, x = np.repeat(lat[rows], columns.sum()), np.tile(lon[columns], rows.sum())
        for k in np.flatnonzero(self._within("time", days)):
            v, m = (a[k][rows][:, columns].ravel() for a in (values, missing))
            yield pa.RecordBatch.from_arrays([pa.array([days[k]] * len(v), pa.date32()), pa.array(y), pa.array(x), pa.array([signature] * len(v)), pa.array(v, mask=m)], ["time", "lat", "lon", "grid", self.variable])


class GridSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "daily_grid"

    def schema(self) -> str:
        return f"time date, lat double, lon double, grid string, {self.options.get('variable', 'rain')} double"

    def reader(self, schema) -> GridReader:
        return GridReader(self.options)


def encode(values: np.ndarray, days: list[datetime.date], lat: np.ndarray, lon: np.ndarray, variable: str = "rain", fill: float = -9999.0, record: bool = True) -> bytes:
    """A CDF-2 file of values (time, lat, lon), NaN as fill, with time as the record dimension or a fixed one."""
    out = io.BytesIO()
    number = lambda n, size=4: out.write(int(n).to_bytes(size, "big"))

    def text(s: str) -> None:
        number(len(s.encode()))
        out.write(s.encode() + b"\0" * (-len(s.encode()) % 4))

    def attributes(own: dict) -> None:
        number(12 if own else 0)
        number(len(own))
        for name, v in own.items():
            text(name)
            if isinstance(v, str):
                number(2)
                text(v)
            else:
                number(6)
                number(1)
                out.write(struct.pack(">d", v))

    shape = {"time": len(days), "lat": len(lat), "lon": len(lon)}
    data = {
        "lat": (["lat"], np.asarray(lat, ">f8"), {}), "lon": (["lon"], np.asarray(lon, ">f8"), {}),
        "time": (["time"], np.array([(d - datetime.date(1970, 1, 1)).days for d in days], ">f8"), {"units": "days since 1970-01-01"}),
        variable: (["time", "lat", "lon"], np.where(np.isnan(values), fill, values).astype(">f8"), {"_FillValue": fill}),
    }
    out.write(b"CDF\x02")
    number(len(days) if record else 0)
    number(10)
    number(3)
    for name, n in shape.items():
        text(name)
        number(0 if record and name == "time" else n)
    attributes({})
    number(11)
    number(len(data))
    places = {}
    for name, (dims, v, own) in data.items():
        text(name)
        number(len(dims))
        for d in dims:
            number(list(shape).index(d))
        attributes(own)
        number(6)
        number(v.nbytes // (len(days) or 1) if record and dims[0] == "time" else v.nbytes)
        places[name] = out.tell()
        number(0, 8)
    body = []
    for name, (dims, v, _) in data.items():
        if not (record and dims[0] == "time"):
            body.append((name, v.tobytes()))
    at, records = out.tell(), {}
    for name, raw in body:
        records[name], at = at, at + len(raw)
    chunks = [raw for _, raw in body]
    if record:
        moving = ["time", variable]
        for name in moving:
            records[name], at = at, at + data[name][1].nbytes // (len(days) or 1)
        chunks += [data[name][1][k : k + 1].tobytes() for k in range(len(days)) for name in moving]
    raw = bytearray(out.getvalue() + b"".join(chunks))
    for name, place in places.items():
        raw[place : place + 8] = records[name].to_bytes(8, "big")
    return bytes(raw)


def write_grids(cells: DataFrame, folder: str, x: str = "x", by: str = "year") -> DataFrame:
    """Cells (``by``, time, lat, lon, x) as one file for each value of ``by``; path and number of days of each.

    A file's rows meet in one task, as one file must; cells without a row are fill values.  ``folder`` is a path or URI that
    every executor can write to."""
    def write(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lat, lon = (np.unique(rows.column(c).to_numpy()) for c in ("lat", "lon"))
        days = sorted(set(rows.column("time").to_pylist()))
        values = np.full((len(days), len(lat), len(lon)), np.nan)
        at = np.searchsorted(np.array(days, "datetime64[D]"), rows.column("time").to_numpy().astype("datetime64[D]"))
        values[at, np.searchsorted(lat, rows.column("lat").to_numpy()), np.searchsorted(lon, rows.column("lon").to_numpy())] = rows.column(x).to_numpy(zero_copy_only=False).astype(float)
        path = f"{folder.rstrip('/')}/{x}_{key[0].as_py()}.nc"
        system, inner = located(path)
        system.create_dir(inner.rsplit("/", 1)[0])
        with system.open_output_stream(inner) as file:
            file.write(encode(values, days, lat, lon, x))
        return pa.table({"path": [path], "days": pa.array([len(days)], pa.int64())})

    return cells.select(by, "time", "lat", "lon", F.col(x).cast("double").alias(x)).groupBy(by).applyInArrow(write, "path string, days long")


def scan(spark: SparkSession, paths: list[str], variable: str = "rain", **options) -> DataFrame:
    """The long scan of files: time, lat, lon, grid, the variable.  The session takes filter push-down into Python sources."""
    spark.dataSource.register(GridSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("daily_grid").option("paths", ",".join(paths)).option("variable", variable)
    for name, value in options.items():
        reader = reader.option(name.rstrip("_"), str(value))
    return reader.load()


def matrix(cells: DataFrame, cutoff, x: str = "rain") -> DataFrame:
    """lat, lon, start, values: each cell's days from ``cutoff`` on as an array, missing days zero."""
    rows = cells.filter(F.col("time") >= cutoff).groupBy("lat", "lon").agg(F.min("time").alias("start"), F.sort_array(F.collect_list(F.struct("time", F.coalesce(x, F.lit(0.0)).alias("v")))).alias("_a"))
    return rows.select("lat", "lon", "start", F.col("_a.v").alias("values"))


def half_spacing(cells: DataFrame) -> DataFrame:
    """grid -> half_lat, half_lon: half the least distance of neighbouring coordinates, 0.125 for a single row or column."""
    def least(c: str) -> DataFrame:
        step = F.lead(c).over(Window.partitionBy("grid").orderBy(c)) - F.col(c)
        return cells.select("grid", c).distinct().withColumn("_d", step).groupBy("grid").agg((F.coalesce(F.round(F.min("_d"), 6), F.lit(0.25)) / 2).alias(f"half_{c}"))

    return least("lat").join(least("lon"), "grid")


def regrid_by_grid(cells: DataFrame, units: DataFrame, x: str = "rain", footprint: DataFrame | None = None) -> DataFrame:
    """time, target_id, x of cells of several grids: weights are made once for each distinct grid, within the boxes of
    ``footprint`` if it is given, and each file's rows take those of its grid.

    The distinct grids, a few rows, come to the driver; units without weights in a grid have no rows from its files."""
    from ..operators import coverage as V
    from ..operators.regrid import renormalise

    spots, parts = cells.select("grid", "lat", "lon").distinct(), []
    for g in half_spacing(spots).orderBy("grid").collect():
        own = spots.filter(F.col("grid") == g["grid"]).select("lat", "lon").withColumn("source_id", F.concat_ws("_", "lat", "lon"))
        size, halves = (16 * g["half_lat"], 16 * g["half_lon"]), (g["half_lat"], g["half_lon"])
        if footprint is None:
            areas = V.overlap_areas(V.cell_boxes(own, *halves, ["source_id"]), ["source_id"], units, size).withColumnRenamed("area", "weight")
            weights = renormalise(areas)
        else:
            weights, _ = V.weights_to_coverage(own, *halves, units, footprint, size)
        parts.append(weights.select(F.lit(g["grid"]).alias("grid"), "source_id", "target_id", "weight"))
    if not parts:
        return cells.sparkSession.createDataFrame([], f"time date, target_id {dict(units.dtypes)['target_id']}, {x} double")
    weights = parts[0]
    for p in parts[1:]:
        weights = weights.unionByName(p)
    seen = F.col(x).isNotNull()
    rows = cells.withColumn("source_id", F.concat_ws("_", "lat", "lon")).join(weights, ["grid", "source_id"])
    num, den = F.sum(F.when(seen, F.col("weight") * F.col(x))), F.sum(F.when(seen, F.col("weight")))
    return rows.groupBy("time", "target_id").agg((num / F.nullif(den, F.lit(0.0))).alias(x))
