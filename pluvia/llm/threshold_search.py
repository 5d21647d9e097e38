"""Ranked lexical search by Fagin's threshold algorithm over impact-sorted lists.

Every document has an entry in a forward index: its length and how often it holds each term of the query items.
A term's impact in a document depends on these counts alone, so the documents are searched shard by shard: a shard's
entries make a dense forward index (documents x terms) and one list a term, sorted by falling impact.  For an item
the lists of its terms are read in turn, some entries of each at a time; documents met for the first time get their
full score by look-ups in the forward index.  The threshold is the score of a document that stands in every list
where reading has come to; once it is strictly below the k-th best score, no unread document can be among the best,
not even by its doc_id among equals.  The best of one shard stay the bar for a task's next shards, and the best k of
each task meet in a window that Spark cuts to k rows before its shuffle.

Documents are read once for each block of about ``block_items`` items, dealt by hash: the block is the stated query
set that is sent to all tasks; documents are neither shuffled nor collected.  A shard has at most ``cells`` entries.

Defined cases: terms are maximal runs of ASCII digits and letters and of non-ASCII characters, A-Z in lower case;
null texts and texts without terms are no documents and count in no statistic; items without terms have no rows;
repeated rows are documents (and items) of their own; equal scores go by rising doc_id, null last; empty tables give
an empty result; other columns are ignored, whatever their names.  Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._store import pin, unpin
from ._words import slices, word_hashes
from .simhash_windows import _blocks

APART = bytes(c for c in range(128) if not chr(c).isalnum())
TOP = 20
_INDEX = "n long, terms array<int>, times array<int>"


def item_terms(texts: list[str | None]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(sorted hashes of all terms, for each text its (term numbers, times))."""
    hashes, at = word_hashes(pa.array(texts, pa.string()), APART)
    known, number = np.unique(hashes, return_inverse=True)
    return known, [np.unique(number[i:j], return_counts=True) for i, j in zip(at[:-1], at[1:], strict=True)]


def forward_index(docs: DataFrame, known: np.ndarray) -> DataFrame:
    """doc_id, text -> doc_id, n (terms with repeats), terms (numbers of those in ``known``), times; only texts with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            hashes, at = word_hashes(batch.column("text"), APART)
            for i, j in slices(at, 1_000_000):
                words, n = hashes[at[i] : at[j]], np.diff(at[i : j + 1])
                number = np.searchsorted(known, words)
                hit = known[np.minimum(number, len(known) - 1)] == words
                owner = np.repeat(np.arange(j - i), n)
                pair, times = np.unique(owner[hit] * len(known) + number[hit], return_counts=True)
                text, term = np.divmod(pair, len(known))
                ends = pa.array(np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, times)]
                out = pa.RecordBatch.from_arrays([batch.slice(i, j - i).column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "times"])
                yield out.filter(pa.array(n > 0))

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_INDEX}")


def weights(index: DataFrame, terms: int) -> tuple[np.ndarray, int, int]:
    """(weight of each term number, documents, all their terms) of a forward index."""
    n, total = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(terms, np.int64)
    for term, count in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a term of the items
        df[term] = count
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(d) + 1))) for d in df], np.int64), n, total


class Shard:
    """Documents as a dense forward index and as impact-sorted lists of their terms."""

    def __init__(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray, terms: int, docs: int, total: int, top: int = TOP):
        self.top = top
        m = 75 + 25 * n * docs // max(1, total)
        impact = 1_000_000_000 * times // (1000 * times + 12 * m[doc])
        self.forward = np.zeros((len(n), terms), np.int32)
        self.forward[doc, term] = impact
        order = np.lexsort((-impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.at = np.searchsorted(term[order], np.arange(terms + 1))

    def search(self, term: np.ndarray, weight: np.ndarray, bar: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(documents, scores, entries read): all documents that can score ``bar`` or more."""
        lo, hi = self.at[term], self.at[term + 1]
        seen, found, read, step = np.zeros(len(self.forward), bool), [], 0, 32
        while True:
            to = np.minimum(lo + read + step, hi)
            rows = np.concatenate([self.doc[i:j] for i, j in zip(np.minimum(lo + read, hi), to, strict=True)])
            rows = np.unique(rows[~seen[rows]])
            seen[rows] = True
            found.append((rows, self.forward[np.ix_(rows, term)].astype(np.int64) @ weight))
            read, step, bar = read + step, step * 2, max(1, bar, self._kth(found))
            threshold = int(np.where(to < hi, self.impact[np.maximum(to - 1, 0)], 0) @ weight)
            if threshold < bar:
                break
        doc, score = (np.concatenate(x) for x in zip(*found, strict=True))
        return doc, score, int((np.minimum(lo + read, hi) - lo).sum())

    def _kth(self, found: list[tuple[np.ndarray, np.ndarray]]) -> int:
        score = np.concatenate([s for _, s in found])
        return int(np.partition(score, len(score) - self.top)[len(score) - self.top]) if len(score) >= self.top else 0


class Best:
    """The k highest-scoring documents of an item so far: equal scores by rising id, null last."""

    def __init__(self, k: int):
        self.k, self.score, self.null, self.id = k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def bar(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        keep = score >= max(1, self.bar)
        score, null, ids = (np.concatenate(x) for x in ((self.score, score[keep]), (self.null, null[keep]), (self.id, ids[keep])))
        order = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.null, self.id = score[order], null[order], ids[order]


def shards(batches: Iterator[pa.RecordBatch], terms: int, docs: int, total: int, cells: int, top: int = TOP) -> Iterator[tuple[pa.Array, Shard]]:
    """(doc_ids, shard) of runs of rows of a forward index."""
    most = max(64, cells // max(1, terms))
    for batch in batches:
        for i in range(0, batch.num_rows, most):
            part = batch.slice(i, most)
            size = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            flat = [part.column(c).flatten().to_numpy().astype(np.int64) for c in ("terms", "times")]
            yield part.column("doc_id"), Shard(part.column("n").to_numpy(), np.repeat(np.arange(part.num_rows), size), *flat, terms, docs, total, top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_items: int = 10_000, cells: int = 1 << 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents with a score above 0 for each row of ``items`` (item_id, text)."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    spark, kind, item = docs.sparkSession, docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    schema = f"item int, item_id {item.simpleString()}, doc_id {kind.simpleString()}, score long"
    arrow_id, arrow_item = to_arrow_type(kind), to_arrow_type(item)

    def of_block(block: list[tuple]) -> DataFrame:
        known, bags = item_terms([t for _, t in block])
        index = pin(forward_index(docs, known), "search-index")
        weight, n, total = weights(index, len(known))
        shared = spark.sparkContext.broadcast((weight, bags, [k for k, _ in block]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, bags, names = shared.value
            best = [Best(top) for _ in bags]
            for ids, shard in shards(batches, len(weight), n, total, cells, top):
                null, number = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy().astype(np.int64)
                for (term, times), own in zip(bags, best, strict=True):
                    if len(term):
                        doc, score, _ = shard.search(term, weight[term] * times, own.bar)
                        own.add(score, null[doc], number[doc])
            sizes = [len(b.score) for b in best]
            every = [np.concatenate([getattr(b, f) for b in best] or [np.zeros(0)]) for f in ("id", "null", "score")]
            at = np.repeat(np.arange(len(best)), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array([names[k] for k in at], arrow_item), pa.array(every[0], pa.int64(), mask=every[1].astype(bool)).cast(arrow_id), pa.array(every[2], pa.int64())],
                ["item", "item_id", "doc_id", "score"])

        by = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        ranked = index.mapInArrow(run, schema).withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
        found = pin(ranked.select("item_id", "rank", "doc_id", "score"), "search-found")
        unpin(index)
        return found

    parts = [of_block(block) for _, block in _blocks(items, block_items) if any(len(t) for t, _ in item_terms([t for _, t in block])[1])]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], f"item_id {item.simpleString()}, rank int, doc_id {kind.simpleString()}, score long")


def op13_threshold_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best of all ``documents`` for each ``benchmark`` item."""
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
