"""Shared scratch storage: tables and files that every executor and the driver can see.

The folder is the cluster's ``spark.checkpoint.dir``.  Only where that is unset on a local master (tests) a
temporary folder takes its place; on a cluster that is an error, since executors do not share such folders.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder URI below the shared folder."""
    base = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{_KEY} must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-checkpoint-")
        spark.conf.set(_KEY, base)
    return f"{base.rstrip('/')}/pluvia/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: the lineage is cut, and a
    lost executor costs a re-read, not a recomputation."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.pinned_at = path
    return out


def unpin(*tables: DataFrame) -> None:
    """Delete pinned tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.pinned_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
