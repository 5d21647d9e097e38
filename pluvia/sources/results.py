"""Result tables that appear together or not at all, in a total order.

    write_results({"conditional": a, "unconditional": b}, folder, order=["time", "id"])
    read_results(spark, folder, "conditional")

The tables (of one schema) are written by one Spark job through a Python data source: every task writes Parquet files for the
tables that it has rows of and reports them in its commit message; the driver then publishes one manifest that names all files,
by a single rename.  Until that rename readers see the earlier tables, or none; a job that fails leaves no new file.  Rows are
cut by range of (table, order), nulls first, and sorted in each part, so the files in the manifest's order are the tables in
total order and no task holds a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from pyspark.sql.types import StructType

from .grids import located

_TABLE, _MANIFEST = "_table", "manifest.json"


@dataclass
class Written(WriterCommitMessage):
    """(table, file name, rows) of a task's files."""

    part: int
    files: list


def manifest(folder: str) -> dict:
    """The published tables: version and, for each table, its files in order; empty if there are none."""
    system, inner = located(f"{folder.rstrip('/')}/{_MANIFEST}")
    if system.get_file_info(inner).type == fs.FileType.NotFound:
        return {"tables": {}}
    with system.open_input_file(inner) as file:
        return json.loads(file.read())


class ResultWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder, self.tables, self.schema = options["folder"].rstrip("/"), options["tables"].split(","), options["schema"]
        self.version = uuid.uuid4().hex

    def _delete(self, names: list[str]) -> None:
        for name in names:
            system, inner = located(f"{self.folder}/{name}")
            if system.get_file_info(inner).type != fs.FileType.NotFound:
                system.delete_file(inner)

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        part, open_, rows = TaskContext.get().partitionId(), {}, {}
        name = lambda table: f"{self.version}-{part:06d}-{table}.parquet"
        try:
            for batch in batches:
                column = batch.column(_TABLE)
                for table in pc.unique(column).to_pylist():
                    own = batch.filter(pc.equal(column, table)).drop_columns([_TABLE])
                    if table not in open_:
                        system, inner = located(f"{self.folder}/{name(table)}")
                        open_[table], rows[table] = pq.ParquetWriter(inner, own.schema, filesystem=system), 0
                    open_[table].write_batch(own)
                    rows[table] += own.num_rows
        except BaseException:
            for table, writer in open_.items():
                writer.close()
                self._delete([name(table)])
            raise
        for writer in open_.values():
            writer.close()
        return Written(part, [(table, name(table), n) for table, n in rows.items()])

    def commit(self, messages: list[Written]) -> None:
        before = manifest(self.folder)
        tables: dict = {t: [] for t in self.tables}
        for m in sorted((m for m in messages if m is not None), key=lambda m: m.part):
            for table, name, rows in m.files:
                tables[table].append([name, rows])
        system, inner = located(f"{self.folder}/{_MANIFEST}")
        with system.open_output_stream(f"{inner}.{self.version}") as file:
            file.write(json.dumps({"version": self.version, "schema": self.schema, "tables": tables}).encode())
        system.move(f"{inner}.{self.version}", inner)
        self._delete([name for own in before["tables"].values() for name, _ in own])

    def abort(self, messages: list[Written]) -> None:
        self._delete([name for m in messages if m is not None for _, name, _ in m.files])


class ResultSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "result_tables"

    def writer(self, schema, overwrite: bool) -> ResultWriter:
        return ResultWriter(self.options)


def write_results(tables: dict[str, DataFrame], folder: str, order: list[str]) -> None:
    """Writes all tables, in place of earlier ones, or none.  ``folder`` is a path or URI that driver and executors share."""
    first = next(iter(tables.values()))
    spark, names = first.sparkSession, first.columns
    system, inner = located(folder.rstrip("/"))
    system.create_dir(inner)
    rows = None
    for name, df in tables.items():
        one = df.select(F.lit(name).alias(_TABLE), *names)
        rows = one if rows is None else rows.unionByName(one)
    keys = [F.col(_TABLE), *[F.col(c).asc_nulls_first() for c in order]]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.dataSource.register(ResultSink)
    out = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    out.write.format("result_tables").option("folder", folder).option("tables", ",".join(tables)).option("schema", first.schema.json()).mode("append").save()


def read_results(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A published table."""
    published = manifest(folder)
    known = published["tables"]
    if table not in known:
        raise FileNotFoundError(f"{folder}: no table {table!r}; there are {sorted(known)}")
    schema = StructType.fromJson(json.loads(published["schema"]))
    files = [f"{folder.rstrip('/')}/{name}" for name, _ in known[table]]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
