"""Token counts by separator scan of flat, unindexed token files.

A token file is a bare sequence of 16- or 32-bit token ids; every document ends with the end-of-document id.
Files are read in blocks by byte ranges, each block is searched for separators with one vectorised comparison,
and documents that cross blocks are stitched by a prefix scan over the blocks: the number of separators and the
last separator's position before each block.  The scan runs in chunks of blocks and then over the chunks' totals,
so one file may hold any share of the tokens.

:func:`write_token_files` makes such files from texts with a public tokenizer (its vocabulary's path is a
parameter; the driver reads it and sends it to the tasks).  A task attempt writes a file of its own and names it
in its rows; only files named in the written rows are scanned, so retries leave nothing behind in the result.

Defined cases: null and empty texts have 0 tokens; tokens after a file's last separator are a last document with
``terminated`` false; an empty file has none; repeated rows are separate documents; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._store import pin, shared_dir

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END_OF_DOCUMENT = 50_256
#: Fixed value: how this vocabulary's tokenizer cuts a text before merging bytes.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"


def encoder(vocabulary: bytes, pattern: str = PATTERN):
    """text -> token ids, from the lines "base64 rank" of a vocabulary."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def write_token_files(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END_OF_DOCUMENT, pattern: str = PATTERN, dtype: str = "<u2", doc_id: str = "doc_id", text: str = "text") -> tuple[str, DataFrame]:
    """Tokenise and write; returns the folder and one row per document: doc_id, name (of the file), doc_no."""
    folder = shared_dir(docs.sparkSession, "tokens")
    shared = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        encode = encoder(shared.value, pattern)
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name, number = f"{uuid.uuid4().hex}.tokens", 0
        with store.open_output_stream(f"{path}/{name}") as out:
            for batch in batches:
                for text in batch.column("text"):
                    out.write(np.array([*encode(text.as_py() or ""), end], dtype).tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([name] * n, pa.string()), pa.array(np.arange(number, number + n))], ["doc_id", "name", "doc_no"])
                number += n

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return folder, pin(rows.mapInArrow(run, f"doc_id {kind}, name string, doc_no long"), "token-rows")


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, name, length of the token files below ``folder``; their contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    return found.select("path", F.substring_index("path", "/", -1).alias("name"), "length")


def scan_blocks(files: DataFrame, end: int = END_OF_DOCUMENT, dtype: str = "<u2", block_bytes: int = 4 << 20) -> DataFrame:
    """One row per block: name, block, start (token), n, last (position of the last separator in the file),
    gaps (tokens before the first separator, then between separators)."""
    width = np.dtype(dtype).itemsize
    step = block_bytes // width * width

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for rows in batches:
            for path, name, block, length in zip(rows["path"], rows["name"], rows["block"], rows["length"], strict=True):
                store, inside = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
                with store.open_input_file(inside) as source:
                    data = source.read_at(min(step, length - block * step), block * step)
                ids = np.frombuffer(data, dtype, len(data) // width)
                at, start = np.flatnonzero(ids == end), block * step // width
                yield pd.DataFrame({"name": [name], "block": [block], "start": [start], "n": [len(ids)], "last": pd.array([start + at[-1] if len(at) else None], "Int64"),
                                    "gaps": [np.diff(at, prepend=-1) - 1]})

    blocks = files.filter(f"length >= {width}").select("path", "name", "length", F.explode(F.sequence(F.lit(0), F.expr(f"(length - 1) div {step}"))).alias("block"))
    tasks = max(1, min(20_000, int(files.agg(F.sum(F.ceil(F.col("length") / step))).first()[0] or 1)))
    return blocks.repartition(tasks, "name", "block").mapInPandas(run, "name string, block long, start long, n long, last long, gaps array<long>")


def stitch(blocks: DataFrame, chunk: int = 1024) -> DataFrame:
    """name, doc_no, start, n_tokens, terminated of every document."""
    blocks = blocks.withColumn("chunk", F.expr(f"block div {chunk}")).withColumn("seps", F.size("gaps").cast("long"))
    earlier = lambda *keys: Window.partitionBy(*keys).orderBy("block" if "chunk" in keys else "chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("name", "chunk").agg(F.sum("seps").alias("_s"), F.max("last").alias("_l"))
    before = totals.select(
        "name", "chunk", F.coalesce(F.sum("_s").over(earlier("name")), F.lit(0)).alias("_seps"), F.max("_l").over(earlier("name")).alias("_last"))
    own = earlier("name", "chunk")
    placed = (
        blocks.withColumn("_in", F.coalesce(F.sum("seps").over(own), F.lit(0))).withColumn("_near", F.max("last").over(own))
        .join(before, ["name", "chunk"])
        .withColumn("first_doc", F.col("_in") + F.col("_seps"))
        .withColumn("open", F.coalesce("_near", "_last", F.lit(-1)) + 1)  # where the document that enters the block starts
    )
    ended = (
        placed.filter("seps > 0")
        .select("name", "first_doc", "open", F.posexplode(F.transform("gaps", lambda g, i: F.when(i == 0, F.col("start") + g - F.col("open")).otherwise(g))).alias("i", "n_tokens"), "start", "gaps")
        .select("name", (F.col("first_doc") + F.col("i")).alias("doc_no"), "n_tokens", F.lit(True).alias("terminated"))
    )
    files = blocks.groupBy("name").agg(F.max(F.col("start") + F.col("n")).alias("all"), F.max("last").alias("last"), F.sum("seps").alias("seps"))
    rest = F.col("all") - F.coalesce(F.col("last"), F.lit(-1)) - 1
    open_end = files.select("name", F.col("seps").alias("doc_no"), rest.alias("n_tokens"), F.lit(False).alias("terminated")).filter("n_tokens > 0")
    return ended.unionByName(open_end)


def op1_token_scan(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` tokenised into flat files, and their token counts found by scanning these."""
    folder, rows = write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    if rows.isEmpty():  # no task has made the folder
        return rows.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), "doc_no", F.lit(True).alias("terminated"))
    files = list_files(spark, folder).join(rows.select("name").distinct(), "name", "left_semi")
    counts = stitch(pin(scan_blocks(pin(files, "token-files")), "token-blocks"))
    return rows.join(counts, ["name", "doc_no"], "left").select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "doc_no", "terminated")
