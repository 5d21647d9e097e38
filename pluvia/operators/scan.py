"""Prefix sums over ordered rows without a task that holds them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .fits import beside
from .relations import cut


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], columns: list[str], parts: int | None = None) -> DataFrame:
    """Adds ``<c>_below``, the sum of each column over the rows of the same keys that come before, and ``<c>_all``, over all.

    The rows are cut by range of (keys, order) into ``parts`` parts, by default as many as shuffle partitions.  Each part is
    summed; a key's parts, at most ``parts`` rows, give the offsets, which are added to the sums within a part.  So a key
    with any share of the rows is spread evenly.  The order must tell a key's rows apart; null keys are one key, null
    values count as zero."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()))
    part = [*keys, "_part"]
    sums = placed.groupBy(*part).agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    over = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    offsets = sums.select(*part, *[over(c, earlier).alias(f"_{c}_before") for c in columns], *[over(c, Window.partitionBy(*keys)).alias(f"{c}_all") for c in columns])
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"_{c}_inside": over(c, inside) for c in columns})
    out = beside(local, offsets, part)
    return out.withColumns({f"{c}_below": F.col(f"_{c}_before") + F.col(f"_{c}_inside") for c in columns}).drop("_part", *[f"_{c}_{x}" for c in columns for x in ("before", "inside")])
