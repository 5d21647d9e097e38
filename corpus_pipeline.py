"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept.  All stages carry every
column of the documents as it is, whatever its name, read whole texts of any length and give an empty result for an
empty table; what each makes of nulls, empty texts, ties and repeated rows is in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pluvia.llm import bagminhash, lpt_shards, simhash_windows, source_schedule, zstd_toxicity
from pluvia.llm._store import pin, unpin


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not reject.

    Null and empty texts are scored like any other, by their lack of windows; repeated rows share their fate; labels
    of null ids or without a value teach nothing, and of several labels of a document the toxic one counts."""
    model = zstd_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return zstd_toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the least doc_id.

    All null texts are one group, as are all texts without words that are equal; of rows that share doc_id and text one
    stays; rows without a doc_id stay, one for each text, where their group has no doc_id at all."""
    return bagminhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts contain nothing and stay; repeated rows share their fate; null items match nothing."""
    return simhash_windows.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix to the sources' targets takes them.

    Null sources are one source; texts without words are not taken; repeated rows are scheduled one by one; ties in the
    shuffle go by doc_id and size."""
    return source_schedule.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every document of the mix.

    Null texts are empty; equal texts, and so all copies that the mix made, share a shard."""
    return lpt_shards.assign_shards(docs).drop("group_key")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The model-based stages cannot be expressed in SQL; tests hold near-duplicates against brute force, toxicity and
#: decontamination against their operators, which have brute-force tests of their own, and mixing and sharding by bounds.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again; a stage's input goes once its output is there."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
        if before is not None:
            unpin(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
