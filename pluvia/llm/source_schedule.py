"""Mixing sources to target weights with a low-discrepancy source schedule.

Each source's documents are shuffled by a hash, laid end to end and cut into equal-token blocks.  The
golden-ratio points ``frac(k * phi)`` pick a source for every slot ``k`` through the cumulative slot
shares; the r-th slot of a source takes its block ``r mod blocks``, so a source is read in whole passes,
three at most.  Everything is DataFrame and SQL functions.

A source's offsets and slot ranks are computed in many small windows plus prefix sums over their totals,
so a source with a third of all rows is spread over all tasks.

Defined cases: a null text has no words; null sources are one source, sorted last; documents without
words are returned with ``taken`` 0; rows without a doc_id are shuffled by their text; repeated rows are separate documents; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import pin, unpin

#: Fractional part of the golden ratio.
PHI = 0.6180339887498949
#: Weights of the sources by code point order, repeating.
WEIGHTS = (1, 2, 3)
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def n_words(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, WORD_GAP), "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, max_epochs: int = 3, weights: tuple = WEIGHTS) -> DataFrame:
    """source, source_size -> adds target: shares of the total by weight, at most ``max_epochs`` times
    the source's size, the excess reshared by weight (water filling).

    With the sources sorted by cap per weight, a source is capped if filling all of them to its own level
    would take no more than the total."""
    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    by_level = Window.partitionBy().orderBy("_level", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    cap = F.col("source_size") * float(max_epochs)
    out = (
        sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                            ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
        .withColumn("_cap", cap)
        .withColumn("_level", F.col("_cap") / F.col("_w"))
        .withColumn("_total", F.sum(F.col("source_size").cast("double")).over(everything))
        .withColumn("_weight", F.sum("_w").over(everything))
        .withColumn("_caps_before", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_w_before", F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
        .withColumn("_capped", F.col("_caps_before") + F.col("_level") * (F.col("_weight") - F.col("_w_before")) <= F.col("_total"))
        .withColumn("_spent", F.coalesce(F.sum(F.when(F.col("_capped"), F.col("_cap"))).over(everything), F.lit(0.0)))
        .withColumn("_open", F.coalesce(F.sum(F.when(~F.col("_capped"), F.col("_w"))).over(everything), F.lit(0.0)))
    )
    share = F.col("_w") * (F.col("_total") - F.col("_spent")) / F.col("_open")
    return out.select("source", "source_size", F.when(F.col("_capped"), F.col("_cap")).otherwise(share).alias("target"))


def schedule(
    targets: DataFrame, block_tokens: int = 64, max_epochs: int = 3, chunk: int = 4096, cells: int = 4096,
) -> DataFrame:
    """Slots of the mix: slot, source_no, block, epoch.

    ``targets`` has source_no, source_size, target.  A source has ``ceil(size / block_tokens)`` blocks, and
    its slots stand to all slots as ``target / (size / blocks)`` stands to the sum of these."""
    upto = Window.partitionBy().orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)
    shares = (
        targets.filter("source_size > 0")
        .withColumn("blocks", F.ceil(F.col("source_size") / block_tokens).cast("long"))
        .withColumn("_slots", F.col("target") * F.col("blocks") / F.col("source_size"))
        .withColumn("_all", F.sum("_slots").over(Window.partitionBy()))
        .withColumn("_upto", F.sum("_slots").over(upto))
        .select("source_no", "blocks", "_all", ((F.col("_upto") - F.col("_slots")) / F.col("_all")).alias("_lo"), (F.col("_upto") / F.col("_all")).alias("_hi"))
    )
    slots = shares.agg(F.ceil(F.max("_all")).cast("long")).first()[0] or 0
    points = (
        shares.sparkSession.range(0, slots, 1, max(1, min(10_000, slots >> 17)))
        .select(F.col("id").alias("slot"), F.expr(f"id div {chunk}").alias("c"), ((F.col("id") + 1) * F.lit(PHI)).alias("_u"))
        .withColumn("_u", F.col("_u") - F.floor("_u"))
    )
    # A point takes the last interval that begins at or before it.  Points and intervals meet in cells of the
    # unit range, each cell opening with the intervals that reach into it, so no side is broadcast.
    edge = F.explode(F.sequence(F.floor(F.col("_lo") * cells), F.least(F.lit(cells - 1), F.floor(F.col("_hi") * cells)))).alias("cell")
    edges = shares.select("_lo", "source_no", "blocks", edge).select(
        "cell", F.greatest("_lo", F.col("cell") / cells).alias("at"), F.struct("source_no", "blocks").alias("s"),
        F.lit(None).cast("long").alias("c"), F.lit(None).cast("long").alias("slot"))
    seen = points.select(F.floor(F.col("_u") * cells).alias("cell"), F.col("_u").alias("at"),
                         F.lit(None).cast("struct<source_no:bigint,blocks:bigint>").alias("s"), "c", "slot")
    so_far = Window.partitionBy("cell").orderBy("at", F.col("slot").asc_nulls_first(), "s.source_no").rowsBetween(Window.unboundedPreceding, 0)
    hit = (
        edges.unionByName(seen)
        .withColumn("_s", F.last("s", ignorenulls=True).over(so_far))
        .filter("slot IS NOT NULL")
        .select("c", "slot", F.col("_s.source_no").alias("source_no"), F.col("_s.blocks").alias("blocks"))
    )
    inside = Window.partitionBy("source_no", "c").orderBy("slot")
    before = Window.partitionBy("source_no").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    starts = hit.groupBy("source_no", "c").count().select(
        "source_no", "c", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    ranked = (
        hit.withColumn("_r", F.row_number().over(inside) - 1)
        .join(starts, ["source_no", "c"])
        .withColumn("_rank", F.col("_r") + F.col("_start"))
    )
    return (
        ranked.filter(F.col("_rank") < F.col("blocks") * max_epochs)
        .select("slot", "source_no", (F.col("_rank") % F.col("blocks")).alias("block"),
                F.expr("_rank div blocks").cast("int").alias("epoch"))
    )


def lay_out(rows: DataFrame, buckets: int = 256) -> DataFrame:
    """rows with doc_id, source_no, size and seed -> adds ``start``: the offset of the document in its shuffled source."""
    rows = rows.withColumn("_h", F.md5(F.concat(F.lit("mix:"), "seed"))).drop("seed").withColumn("_bucket", F.expr(f"cast(conv(substr(_h, 1, 4), 16, 10) as int) % {buckets}"))
    before = Window.partitionBy("source_no").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_sum")).select(
        "source_no", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source_no", "_bucket").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(totals, ["source_no", "_bucket"])
        .withColumn("start", (F.col("_in") + F.col("_base")).cast("long"))
        .drop("_h", "_bucket", "_in", "_base")
    )


def mix_sources(docs: DataFrame, block_tokens: int = 64, max_epochs: int = 3, carry: tuple | list = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, start, taken, copies and the columns ``carry``.

    ``taken`` counts the words the schedule takes of the document over all passes; ``copies`` says how often
    the block with its first word is taken, for mixes of whole documents."""
    seed = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), F.lit("null"))  # rows without doc_id are dealt by their text
    rows = pin(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), seed.alias("seed"), *carry), "mix-rows")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), max_epochs)
    targets = pin(targets.withColumn("source_no", F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last())).cast("long")), "mix-targets")
    numbered = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = pin(lay_out(numbered.filter("size > 0")), "mix-layout")

    times = schedule(targets, block_tokens, max_epochs).groupBy("source_no", "block").agg(F.count("*").alias("times"))
    # Block b of a source covers words [b * size div blocks, (b + 1) * size div blocks).
    piece = F.explode(F.expr("sequence(_first, _last)")).alias("block")
    pieces = (
        placed.withColumn("_n", F.ceil(F.col("source_size") / block_tokens).cast("long"))
        .withColumn("_first", F.expr("((start + 1) * _n - 1) div source_size"))
        .withColumn("_last", F.expr("((start + size) * _n - 1) div source_size"))
        .select("doc_id", "source_no", "start", "size", "source_size", "_n", "_first", piece)
        .withColumn("words", F.expr("least(start + size, (block + 1) * source_size div _n) - greatest(start, block * source_size div _n)"))
    )
    taken = (
        pieces.join(times, ["source_no", "block"])
        .groupBy("source_no", "start")
        .agg(F.sum(F.col("words") * F.col("times")).alias("taken"),
             F.sum(F.when(F.col("block") == F.col("_first"), F.col("times"))).alias("copies"))
    )
    none = F.lit(0).cast("long")
    mixed = placed.join(taken, ["source_no", "start"], "left").select(
        "doc_id", "source", "size", "source_size", "target", "start",
        F.coalesce("taken", none).alias("taken"), F.coalesce("copies", none).alias("copies"), *carry)
    empty = numbered.filter("size = 0").select("doc_id", "source", "size", "source_size", "target", none.alias("start"), none.alias("taken"), none.alias("copies"), *carry)
    out = mixed.unionByName(empty)
    out.pinned = rows, targets, placed  # what it reads
    return out


def mixed_documents(docs: DataFrame, block_tokens: int = 64, max_epochs: int = 3) -> DataFrame:
    """The mix in whole documents, all columns: each row as often as the schedule takes the block with its first
    word.  Rows are numbered once, so that repeated rows keep copies of their own, and travel as one struct, so
    that no column of theirs can clash.  The schedule works on numbers, sources and sizes; its tables are deleted once
    the copies are known, which are then dealt to the rows by number at every size."""
    rows = pin(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("uid")), "mix-documents")
    narrow = rows.select("uid", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), F.col("row.text").alias("text"))
    mixed = mix_sources(narrow, block_tokens, max_epochs, carry=["uid"])
    times = pin(mixed.filter("copies > 0").select("uid", F.col("copies").cast("int").alias("copies")), "mix-copies")
    unpin(*mixed.pinned)
    return rows.join(times.hint("merge"), "uid").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed to the sources' targets."""
    out = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
