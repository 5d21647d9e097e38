"""Sharding by longest-processing-time-first scheduling.

Rows with equal texts form a group that stays together.  Groups sorted by bytes go to the least-loaded
shard through a heap.  The heap sees a bounded number of items: groups above
``total / (shards * bundles_per_shard)`` bytes stand for themselves (there are fewer than
``shards * bundles_per_shard`` of them, since they would otherwise exceed the total), and all smaller
groups are hashed into ``shards * bundles_per_shard`` bundles that are scheduled as one item each.  The
loads differ by at most the smallest item of the fullest shard, as in plain LPT.

Defined cases: a null text has size ``overhead`` and all null texts are one group; an empty text is
another group; repeated rows each get a slot of their own; ties in size are broken by the key; an empty
table gives an empty result; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._store import pin


def lpt_schedule(items: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Least-loaded shard for each (size, key), largest first; ties by key, then by shard number."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, key in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        out[key] = shard
    return out


def gapless_slots(rows: DataFrame, group: str, order: list[str], cells: int = 256) -> DataFrame:
    """Add ``slot``: 0, 1, 2 … within ``group``.

    A group may hold any share of the rows, so it is numbered in ``cells`` independent windows, shifted
    by a prefix sum over the cells' counts (``cells`` rows a group)."""
    cell: Column = F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int")
    rows = rows.withColumn("_cell", cell)
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(group, "_cell").count()
        .select(group, "_cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(group, "_cell").orderBy(*order)
    return (
        rows.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(starts), [group, "_cell"])
        .withColumn("slot", (F.col("_start") + F.col("_rank") - 1).cast("long"))
        .drop("_cell", "_rank", "_start")
    )


def assign_shards(
    docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text",
    overhead: int = 16, bundles_per_shard: int = 256,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, group_key, shard, slot."""
    spark = docs.sparkSession
    body = F.col(text)
    rows = pin(docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.coalesce(F.md5(F.encode(body, "UTF-8")), F.lit("null")).alias("group_key"),
    ), "lpt-rows")

    bundles = shards * bundles_per_shard
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = total / bundles
    big = groups.filter(F.col("bytes") > limit).collect()  # fewer than `bundles` rows, see above
    bundle = F.pmod(F.xxhash64("group_key"), F.lit(bundles)).cast("int")
    small = groups.filter(F.col("bytes") <= limit).groupBy(bundle.alias("b")).agg(F.sum("bytes").alias("bytes")).collect()
    where = lpt_schedule([(r["bytes"], r["group_key"]) for r in big] + [(r["bytes"], r["b"]) for r in small], shards)

    of_key = spark.createDataFrame(
        [(r["group_key"], where[r["group_key"]]) for r in big],
        T.StructType([T.StructField("group_key", T.StringType()), T.StructField("_big", T.IntegerType())]))
    of_bundle = spark.createDataFrame(
        [(r["b"], where[r["b"]]) for r in small],
        T.StructType([T.StructField("_bundle", T.IntegerType()), T.StructField("_small", T.IntegerType())]))
    placed = (
        rows.withColumn("_bundle", bundle)
        .join(F.broadcast(of_key), "group_key", "left")
        .join(F.broadcast(of_bundle), "_bundle", "left")
        .withColumn("shard", F.coalesce("_big", "_small"))
        .select("doc_id", "size", "text_crc32", "group_key", "shard")
    )
    return gapless_slots(placed, "shard", ["doc_id", "group_key"])


def op5_lpt_shards(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 39 of near-equal bytes."""
    out = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
