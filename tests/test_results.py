import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pluvia.sources import results as R

SCHEMA = "time int, id string, p double"


def in_order(folder, table):
    return [tuple(r.values()) for name, _ in R.manifest(folder)["tables"][table] for r in pq.read_table(f"{folder}/{name}").to_pylist()]


def test_tables_are_written_in_total_order(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, "a", "b", "c"]), float(k)) for k in range(3000)]
    df, folder = spark.createDataFrame(rows, SCHEMA), str(tmp_path / "out")
    R.write_results({"cond": df, "uncond": df.withColumn("p", -F.col("p")), "none": df.limit(0)}, folder, ["time", "id", "p"])
    key = lambda r: tuple((v is not None, v if v is not None else 0) for v in r)
    assert in_order(folder, "cond") == sorted(rows, key=key)
    assert in_order(folder, "uncond") == sorted([(*r[:2], -r[2]) for r in rows], key=key)
    assert R.manifest(folder)["tables"]["none"] == [] and len(R.manifest(folder)["tables"]["cond"]) > 1
    assert R.read_results(spark, folder, "uncond").agg(F.sum("p")).first()[0] == -sum(r[2] for r in rows)
    assert R.read_results(spark, folder, "none").count() == 0 and R.read_results(spark, folder, "none").columns == df.columns
    with pytest.raises(FileNotFoundError):
        R.read_results(spark, folder, "other")


def test_a_job_that_dies_leaves_the_earlier_tables(spark, tmp_path):
    folder = str(tmp_path / "out")
    df = spark.range(0, 2000, 1, 4).select(F.col("id").cast("int").alias("time"), F.lit("u").alias("id"), F.col("id").cast("double").alias("p"))
    broken = df.withColumn("p", F.when(F.col("time") == 1500, F.raise_error(F.lit("lost half-way")).cast("double")).otherwise(F.col("p")))
    with pytest.raises(Exception, match="lost half-way"):
        R.write_results({"cond": df, "uncond": broken}, folder, ["time"])
    assert R.manifest(folder) == {"tables": {}} and os.listdir(folder) == []
    R.write_results({"cond": df, "uncond": df}, folder, ["time"])
    first = R.manifest(folder)
    with pytest.raises(Exception, match="lost half-way"):
        R.write_results({"cond": df, "uncond": broken}, folder, ["time"])
    assert R.manifest(folder) == first and len(in_order(folder, "cond")) == len(in_order(folder, "uncond")) == 2000
    R.write_results({"cond": df.filter("time < 5"), "uncond": df.filter("time < 7")}, folder, ["time"])
    assert (len(in_order(folder, "cond")), len(in_order(folder, "uncond"))) == (5, 7)
    assert len(os.listdir(folder)) == 1 + sum(len(v) for v in R.manifest(folder)["tables"].values())
