"""Benchmark decontamination by SimHash of item-sized windows.

Every benchmark item has a 128-bit SimHash of its weighted (counted) five-word shingles.  In the documents,
windows as long as an item are fingerprinted at every position within reach of a shingle that an item of that
length has; windows elsewhere share nothing with any item, so their similarity is 0.  The fingerprints are looked
up in a multi-index: 128 bits are 8 blocks of 16 bits, so a fingerprint within 31 bits of an item's differs from it in
at most 3 bits of some block.  Each item is listed under the 697 values within 3 bits of each of its blocks, and a window
looks its 8 blocks up; about 8 % of random pairs are candidates.  Candidates within the radius are verified by the exact
weighted Jaccard similarity of the shingles; pairs from ``similarity`` on are returned, with the best window.

Words are runs without white space and ASCII punctuation, A-Z in lower case.  The items are a stated query
set: they are scanned in blocks of about ``block_items`` (their lists take 35 KB an item), dealt by hash, each of which is sent to all tasks when
its turn comes; documents are neither shuffled nor collected.

Defined cases: null texts and texts without words contain nothing, and so do such items; an item of fewer than
five words is one shingle of its own words, found where they come together; a document shorter than an item is one window; equal windows: the first; repeated documents or items are
reported each; empty tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._store import pin
from ._words import PUNCTUATION, SPACE, mix, shingles, slices, word_hashes

WIDTH, BLOCKS, FLIPS, RADIUS, SIMILARITY = 5, 8, 3, 31, 0.8
APART = SPACE + PUNCTUATION


def fingerprints(items: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHashes (as rows of 16 bytes) of the windows of ``size`` shingles at ``starts``."""
    two = np.stack([items, mix(items ^ np.uint64(0xA5A5A5A5A5A5A5A5))], axis=1)
    sign = np.unpackbits(two.view(np.uint8).reshape(len(items), 16), axis=1).astype(np.int32) * 2 - 1
    upto = np.concatenate([np.zeros((1, 128), np.int32), np.cumsum(sign, axis=0, dtype=np.int32)])
    return np.packbits(upto[starts + size] - upto[starts] > 0, axis=1)


#: The differences of 16-bit blocks that agree but for at most FLIPS bits.
_NEAR = np.flatnonzero(np.bitwise_count(np.arange(1 << 16, dtype=np.uint16)) <= FLIPS).astype(np.uint16)


class MultiIndex:
    """Items of one size; finds all (window, item) within the radius."""

    def __init__(self, numbers: list[int], prints: np.ndarray):
        self.numbers, self.prints, self.blocks = np.array(numbers), prints, []
        for block in prints.view(np.uint16).T:
            value = (block[:, None] ^ _NEAR).ravel()
            order = np.argsort(value, kind="stable")
            self.blocks.append((value[order], (order // len(_NEAR)).astype(np.int32)))

    def candidates(self, prints: np.ndarray) -> np.ndarray:
        """window x items + item of the pairs that agree in a block but for a few bits."""
        pairs = []
        for block, (value, item) in zip(prints.view(np.uint16).T, self.blocks, strict=True):
            lo, hi = np.searchsorted(value, block, "left"), np.searchsorted(value, block, "right")
            n = hi - lo
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            pairs.append(np.repeat(np.arange(len(prints)), n) * len(self.numbers) + item[at])
        return np.unique(np.concatenate(pairs))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        window, item = np.divmod(self.candidates(prints), len(self.numbers))
        keep = np.bitwise_count(prints[window] ^ self.prints[item]).sum(axis=1) <= RADIUS
        return window[keep], self.numbers[item[keep]]


class Benchmark:
    """A block of items: their shingles, the sizes each shingle occurs in, and a multi-index per size.

    Items of at least five words have shingles of ``width`` five; the shorter ones of ``width`` words one of those."""

    def __init__(self, texts: list[str | None], width: int = WIDTH):
        hashes, words = word_hashes(pa.array(texts, pa.string()), APART)
        items, at = shingles(hashes, words, width)
        self.width, n = width, np.diff(words)
        self.bags: dict[int, Counter] = {}
        sizes: dict[int, list[int]] = {}
        for k in np.flatnonzero(n >= width if width == WIDTH else n == width).tolist():
            self.bags[k] = Counter(items[at[k] : at[k + 1]].tolist())
            sizes.setdefault(int(at[k + 1] - at[k]), []).append(k)
        self.index = {}
        for size, own in sizes.items():
            prints = np.concatenate([fingerprints(items[at[k] : at[k + 1]], np.zeros(1, np.int64), size) for k in own])
            self.index[size] = MultiIndex(own, prints)
        pairs = {(s, size) for size, own in sizes.items() for k in own for s in self.bags[k]}
        known = np.array(sorted(pairs), dtype=np.uint64).reshape(-1, 2)
        self.known, self.size = known[:, 0], known[:, 1].astype(np.int64)
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[(self.known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def hits(self, items: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        at = np.flatnonzero(self.sieve[(items & np.uint64((1 << 22) - 1)).astype(np.int64)])
        return at[np.isin(items[at], self.known)]

    def search(self, items: np.ndarray, at: np.ndarray, similarity: float) -> dict[int, tuple[float, int, int]]:
        """item -> (similarity, first shingle, shingles) of the best window of one document with hits ``at``."""
        lo, hi = np.searchsorted(self.known, items[at], "left"), np.searchsorted(self.known, items[at], "right")
        n = hi - lo
        size = self.size[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        place, best = np.repeat(at, n), {}
        for m in np.unique(size).tolist():
            w = min(m, len(items))
            edge = np.zeros(len(items) - w + 2, np.int64)  # starts within reach of a hit
            np.add.at(edge, np.maximum(place[size == m] - w + 1, 0), 1)
            np.add.at(edge, np.minimum(place[size == m], len(items) - w) + 1, -1)
            starts = np.flatnonzero(np.cumsum(edge) > 0)
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > w) + 1):
                for i in range(0, len(part), 4096):
                    some = part[i : i + 4096]
                    prints = fingerprints(items[some[0] : some[-1] + w], some - some[0], w)
                    for k, item in zip(*(x.tolist() for x in self.index[m].near(prints)), strict=True):
                        start, bag = int(some[k]), self.bags[item]
                        common = sum((Counter(items[start : start + w].tolist()) & bag).values())
                        alike = common / (w + m - common)
                        if alike >= similarity and (-alike, start) < (-best.get(item, (0, 0))[0], best.get(item, (0, 0))[1]):
                            best[item] = (alike, start, w)
        return best


#: The last block that this Python worker has indexed.
_indexed: tuple[str, list[Benchmark]] = ("", [])


def _indexes(name: str, block: list[tuple]) -> list[Benchmark]:
    """The block's indexes by shingle width, kept for the worker's further tasks."""
    global _indexed
    if _indexed[0] != name:
        _indexed = name, [b for width in range(WIDTH, 0, -1) if (b := Benchmark([t for _, t in block], width)).bags]
    return _indexed[1]


def _blocks(benchmark: DataFrame, block_items: int) -> Iterator[tuple[str, list[tuple]]]:
    """Name and rows (item_id, text) of blocks of about ``block_items`` items, one at a time."""
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    blocks = -(-items.count() // block_items)
    for k in range(blocks):
        yield uuid.uuid4().hex, [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()]


def scan(benches: list[Benchmark], texts: pa.Array, similarity: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, similarity, first word, words) of the items found in each text."""
    hashes, words = word_hashes(texts, APART)
    for i, j in slices(words, 1_000_000):
        for bench in benches:
            items, at = shingles(hashes[words[i] : words[j]], words[i : j + 1] - words[i], bench.width)
            hits = bench.hits(items)
            owner = np.searchsorted(at, hits, "right") - 1
            for d in np.unique(owner).tolist():
                own = bench.search(items[at[d] : at[d + 1]], hits[owner == d] - at[d], similarity)
                for k, (alike, start, w) in sorted(own.items()):
                    yield i + d, k, alike, start, w + bench.width - 1


def _each_block(rows: DataFrame, benchmark: DataFrame, block_items: int, of_block) -> list[DataFrame]:
    """``of_block(rows, name, shared block)`` for each block.  With several, each one's rows are written before the
    next is sent, so that the driver and the tasks hold one block."""
    out, before = [], None
    for name, block in _blocks(benchmark, block_items):
        if before is not None:
            out[-1] = pin(out[-1], "simhash-block")
            before.destroy()
        before = rows.sparkSession.sparkContext.broadcast(block)
        out.append(of_block(out[-1] if out else rows, name, before))
    return out


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_items: int = 4_000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, similarity, first_word, words."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind, item = docs.schema[doc_id].dataType.simpleString(), benchmark.schema["item_id"].dataType
    schema = f"doc_id {kind}, item_id {item.simpleString()}, similarity double, first_word long, words long"
    item_type = to_arrow_type(item)

    def of_block(_: DataFrame, name: str, shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            benches = _indexes(name, shared.value)
            for batch in batches:
                row, k, alike, start, n = [list(x) for x in zip(*scan(benches, batch.column("text"), similarity), strict=True)] or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array([shared.value[x][0] for x in k], item_type),
                     pa.array(alike, pa.float64()), pa.array(start, pa.int64()), pa.array(n, pa.int64())],
                    ["doc_id", "item_id", "similarity", "first_word", "words"])

        return narrow.mapInArrow(run, schema)

    parts = _each_block(narrow, benchmark, block_items, of_block) or [docs.sparkSession.createDataFrame([], schema)]
    return reduce(DataFrame.unionByName, parts)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_items: int = 4_000, text: str = "text") -> DataFrame:
    """The documents, all columns, in which no item is found."""

    def of_block(rows: DataFrame, name: str, shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            benches = _indexes(name, shared.value)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[x[0] for x in scan(benches, batch.column(text), similarity)]] = False
                yield batch.filter(pa.array(clean))

        return rows.mapInArrow(run, rows.schema)

    return (_each_block(docs, benchmark, block_items, of_block) or [docs])[-1]


def op6_simhash_windows(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` against all ``benchmark`` items."""
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
