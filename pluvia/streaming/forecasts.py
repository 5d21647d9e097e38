"""Streaming forms of the stages that need no other row: onset searches on forecasts as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.onset import OnsetRule, onset_of_array

FORECAST = "id string, issued timestamp, number int, rain array<double>"


def read_forecasts(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of member forecasts as a stream."""
    return spark.readStream.schema(FORECAST).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def onsets(stream: DataFrame, rule: OnsetRule, threshold: float) -> DataFrame:
    """Adds each member's onset lead; works on one row at a time, so it keeps no state."""
    return stream.withColumn("onset_lead", onset_of_array(F.col("rain"), F.lit(threshold), rule))


def onset_shares(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """id, issued, members, share of members with an onset; members may come up to ``late`` after newer issues."""
    return (
        stream.withWatermark("issued", late).groupBy("id", F.window("issued", "1 day").alias("day"))
        .agg(F.count(F.lit(1)).alias("members"), F.avg(F.col("onset_lead").isNotNull().cast("int")).alias("share"))
        .select("id", F.col("day.start").alias("issued"), "members", "share")
    )


def write(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All files present, then stop; the checkpoint makes a restart go on where it ended."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
