"""Near-duplicates by BagMinHash over weighted five-word shingles.

A text is the multiset of its five-word shingles.  Each shingle of weight ``w`` carries Poisson processes over
the discretised weight axis, one for each dyadic interval [0, 1), [1, 2), [2, 4) … that ``w`` reaches; a point
is active if its weight position lies below ``w``, and falls on one of ``m`` signature components.  A component
keeps its earliest active point, so two signatures agree in a component with exactly the weighted Jaccard
similarity.  Points are generated in time order, and a process stops once it is past the latest component.

Signatures are cut into bands.  Texts that share a band are candidates; their exact multiset similarity is
computed, and verified pairs form the classes (connected components).

No bucket is expanded into all pairs.  Texts with too many shingles of their own to reach the similarity with
any other leave first (this loses nothing and takes out those that only share a passage).  Members of a bucket
that are of one class already need not meet: :func:`classes` says which pairs are verified, so that a group of
thousands of near copies costs about one pair for each.  Exact copies are one text from the start.

Defined cases: a text of fewer than five words is one shingle; texts without words match exact copies only;
all null texts are copies of each other; class_id is the least doc_id of the class (null if it has none);
repeated rows get a row each; an empty table gives an empty result; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._store import pin, unpin
from ._words import mix, shingles, slices, word_hashes

BANDS, ROWS, WIDTH, SIMILARITY = 36, 7, 5, 0.8
_UNIT = 1.0 / (1 << 53)
#: Words that a task works on at a time.
_AT_ONCE = 250_000


def weighted(items: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of the distinct shingles of each text."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((items, owner))
    owner, items = owner[order], items[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (items[1:] != items[:-1])])) if len(items) else np.zeros(0, np.int64)
    return owner[first], items[first], np.diff(np.append(first, len(items)))


def signatures(owner: np.ndarray, items: np.ndarray, weight: np.ndarray, texts: int, m: int) -> np.ndarray:
    """BagMinHash values, texts x m; infinite for texts without shingles."""
    parts = [(owner, mix(items), np.ones(len(items)), np.ones(len(items)))]
    low = 1
    while len(weight) and low < weight.max():  # the interval [low, 2 low) of those weights that reach into it
        at = weight > low
        parts.append((owner[at], mix(items[at] + np.uint64(low * 0xD1B54A32D192ED03 % 2**64)), np.full(at.sum(), float(low)), np.minimum(weight[at] / low - 1, 1.0)))
        low *= 2
    doc, seed, rate, share = (np.concatenate(x) for x in zip(*parts, strict=True))
    value, time = np.full(texts * m, np.inf), np.zeros(len(doc))
    step = 0
    while len(doc):
        step += 1
        r = mix(seed + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
        time = time - np.log1p(-(r >> np.uint64(11)).astype(np.float64) * _UNIT) / rate
        r = mix(r)
        part = ((r >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        active = (r & np.uint64(0xFFFFFFFF)).astype(np.float64) < share * 2.0**32
        np.minimum.at(value, (doc * m + part)[active], time[active])
        latest = value.reshape(texts, m).max(axis=1) if step < 4 or step % 8 == 0 else latest
        go = time < latest[doc]
        doc, seed, rate, share, time = doc[go], seed[go], rate[go], share[go], time[go]
    return value.reshape(texts, m)


def band_keys(value: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band: its number in the top byte, then a byte of each of its at most seven values."""
    part = mix(value.view(np.uint64).reshape(len(value), bands, rows)) & np.uint64(0xFF)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) << np.uint64(56), (len(value), bands)).copy()
    for i in range(rows):
        key |= part[:, :, i] << np.uint64(8 * i)
    return key.view(np.int64)


def agreement(x: Column, y: Column) -> Column:
    """Number of equal value bytes of two texts' keys: estimates the similarity, times the values."""
    low, high = F.lit(0x007F7F7F7F7F7F7F), F.lit(0x0080808080808080)

    def differ(p: Column, q: Column) -> Column:
        d = p.bitwiseXOR(q)
        return F.bit_count((d.bitwiseAND(low) + low).bitwiseOR(d).bitwiseAND(high))

    return F.size(x) * 7 - F.aggregate(F.zip_with(x, y, differ), F.lit(0), lambda s, v: s + v)


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def text_key(text: Column) -> Column:
    """Equal texts have equal keys; null is a text of its own."""
    return F.coalesce(F.unhex(F.md5(F.encode(text, "UTF-8"))), F.lit(b""))


def sign(texts: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text -> doc_id, tid (of equal texts), n (shingles), keys (one per band, none without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, offsets = word_hashes(batch.column("text"))
            for i, j in slices(offsets, _AT_ONCE):
                items, at = shingles(hashes[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], WIDTH)
                value = signatures(*weighted(items, at), j - i, bands * rows)
                n = np.diff(at)
                full = n > 0
                ends = np.concatenate([[0], np.cumsum(full * bands)])
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tid"), pa.array(n), _lists(band_keys(value[full], bands, rows).ravel(), ends)],
                    ["doc_id", "tid", "n", "keys"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", text_key(F.col("text")).alias("tid"), "text").mapInArrow(run, f"doc_id {kind}, tid binary, n long, keys array<long>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """tid, text -> tid, items: the multiset as a set, the k-th occurrence of a shingle being an item of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, offsets = word_hashes(batch.column("text"))
            for i, j in slices(offsets, _AT_ONCE):
                items, at = shingles(hashes[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], WIDTH)
                _, item, weight = weighted(items, at)
                first = np.repeat(np.cumsum(weight) - weight, weight)
                nth = (np.arange(len(first)) - first).astype(np.uint64)
                flat = mix(np.repeat(item, weight) + nth * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.slice(i, j - i).column("tid"), _lists(flat, at)], ["tid", "items"])

    return texts.select("tid", "text").mapInArrow(run, "tid binary, items array<long>")


def components(edges: DataFrame, label: str = "components", small: int = 200_000) -> DataFrame:
    """Undirected edges (a, b) -> node, comp (least node of the component).

    Tasks first replace their edges by spanning stars, ``small`` edges at a time.  Then every node takes the least
    label among its own and its neighbours' and follows that label's own label (pointer jumping), until nothing
    changes; each round is written to the shared folder."""
    kind = edges.schema["a"].dataType.simpleString()
    stars = edges.select("a", "b").mapInArrow(partial(_stars, small), f"a {kind}, b {kind}")
    both = pin(stars.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*").distinct(), label)
    state = pin(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("comp")), label)
    while True:
        near = both.join(state.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("comp").alias("near"))
        least = state.join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = state.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        after = pin(least.join(jump, "comp", "left").select("node", "old", F.coalesce(F.least("comp", "root"), "comp").alias("comp")), label)
        unpin(state)
        state = after
        if after.filter("old <> comp").isEmpty():
            unpin(both)
            out = after.drop("old")
            out.pinned_at = after.pinned_at
            return out


def _stars(small: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges -> (node, least node that it hangs together with among ``small`` edges)."""
    for whole in batches:
        step = small or 1
        for i in range(0, whole.num_rows, step):
            batch, root = whole.slice(i, step), {}

            def find(x, root=root):
                top = x
                while root[top] != top:
                    top = root[top]
                while root[x] != top:
                    root[x], x = top, root[x]
                return top

            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                root.setdefault(x, x)
                root.setdefault(y, y)
                lo, hi = sorted((find(x), find(y)))
                root[hi] = lo
            nodes = [x for x in root if find(x) != x]
            kind = batch.schema.field("a").type
            yield pa.RecordBatch.from_arrays([pa.array(nodes, kind), pa.array([find(x) for x in nodes], kind)], ["a", "b"])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose exact multiset Jaccard similarity reaches ``similarity``."""
    left = sets.select(F.col("tid").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("tid").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    return (
        pairs.join(left, "a").join(right, "b")
        .withColumn("common", common)
        .filter(F.col("common") >= similarity * (F.size("x") + F.size("y") - F.col("common")) - 1e-9)
        .select("a", "b")
    )


def own_items(sets: DataFrame) -> DataFrame:
    """handle, own: how many items of a text no other text has (texts without such items are left out)."""
    items = sets.select(F.explode("items").alias("item"), F.xxhash64("tid").alias("handle"))
    alone = items.groupBy("item").agg(F.count("*").alias("n"), F.min("handle").alias("handle")).filter("n = 1")
    return alone.groupBy("handle").agg(F.count("*").alias("own"))


def led_pairs(texts: DataFrame, similarity: float) -> DataFrame:
    """tid, n, own, comp, keys -> pairs (a, b): each bucket's leader with those members that are of another class."""
    members = texts.select("tid", "n", "own", "comp", F.explode("keys").alias("key"))
    lead = F.min(F.struct("own", "tid", "n", "comp")).alias("lead")
    leaders = members.groupBy("key").agg(lead, F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key", "lead.*")
    leaders = leaders.toDF("key", "oa", "a", "na", "ca")
    return _pairs(members.join(leaders, "key").filter((F.col("comp") != F.col("ca")) & _fits(similarity)))


def _fits(similarity: float) -> Column:
    """What two texts have in common is at most what the one with fewer shared items shares with any text."""
    most = F.least(F.col("n") - F.col("own"), F.col("na") - F.col("oa"))
    return most >= similarity * (F.col("n") + F.col("na") - most) - 1e-9


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("a", "tid").alias("a"), F.greatest("a", "tid").alias("b")).distinct()


def classes(texts: DataFrame, sets: DataFrame, similarity: float, first: int = 6, minors: int = 256) -> tuple[DataFrame, list[DataFrame]]:
    """tid, n, own, keys of texts -> the same with comp, the class; and the tables (a, b) of verified pairs.

    A bucket is done once all pairs of members of different classes are verified:

    1. members of the ``first`` bands' buckets meet their bucket's leader, the member with the fewest items of its
       own, which is the most central one; that joins nearly all of a group of any size;
    2. in the buckets of all bands, members of another class than the leader's meet the leader;
    3. in buckets that still hold several classes, the members outside of the largest class meet all others: in
       rounds of about ``minors`` such members a bucket, four times as many each round, until none is left."""
    values = BANDS * ROWS
    least = similarity * values - 6.5 * (similarity * (1 - similarity) * values) ** 0.5  # a pair has less with 1e-10

    edges = []

    def joined(now: DataFrame, pairs: DataFrame) -> DataFrame:
        """``now`` with the classes that the verified ones among ``pairs`` make."""
        pairs = pin(pairs, "bagminhash-pairs")
        if pairs.isEmpty():
            unpin(pairs)
            return now
        edges.append(pin(verified(pairs, sets, similarity), "bagminhash-edges"))
        unpin(pairs)
        if edges[-1].isEmpty():
            return now
        of = now.select("tid", "comp")
        ends = edges[-1].join(of.toDF("a", "ca"), "a").join(of.toDF("b", "cb"), "b")
        merged = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "bagminhash-components")
        after = pin(now.join(merged.toDF("comp", "_root"), "comp", "left").withColumn("comp", F.coalesce("_root", "comp")).drop("_root"), "bagminhash-classes")
        unpin(now, merged)
        return after

    now = pin(texts.withColumn("comp", F.col("tid")), "bagminhash-classes")
    now = joined(now, led_pairs(now.withColumn("keys", F.slice("keys", 1, first)), similarity))
    now = joined(now, led_pairs(now, similarity))
    members = pin(now.select("tid", F.explode("keys").alias("key")), "bagminhash-members")
    while True:
        each = members.join(now.select("tid", "comp"), "tid").groupBy("key", "comp").agg(F.count("*").alias("c"))
        several = (
            each.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("largest"), F.sum("c").alias("all"))
            .select("key", F.col("largest.comp").alias("main"), (F.col("all") - F.col("largest.c")).alias("others")).filter("others > 0")
        )
        several = pin(several, "bagminhash-several")
        most = several.agg(F.max("others")).first()[0]
        if not most:
            unpin(several)
            break
        full = members.join(several, "key").join(now, "tid")
        turn = (F.col("comp") != F.col("main")) & (F.pmod(F.xxhash64("tid"), F.ceil(F.col("others") / minors)) == 0)
        meet = pin(full.filter(turn).select("key", F.col("tid").alias("a"), F.col("n").alias("na"), F.col("own").alias("oa"), F.col("comp").alias("ca"), F.col("keys").alias("ka")), "bagminhash-meet")
        rows = members.join(now, "tid").join(meet, "key")
        once = F.col("key") == F.get(F.array_intersect("keys", "ka"), F.lit(0))
        pairs = _pairs(rows.filter((F.col("comp") != F.col("ca")) & _fits(similarity) & (agreement(F.col("keys"), F.col("ka")) >= least) & once))
        now = joined(now, pairs)
        if most <= minors:
            unpin(several, meet)
            break
        # Those that met all others leave the bucket, and so do buckets in which all outside of the largest class did.
        left = members.join(several.filter(F.col("others") > minors).select("key"), "key", "left_semi").join(meet.select("key", F.col("a").alias("tid")), ["key", "tid"], "left_anti")
        left = pin(left, "bagminhash-members")
        unpin(members, several, meet)
        members, minors = left, minors * 4
    unpin(members)
    return now, edges


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, tid (of its text), class_id, copy_of (least doc_id with the same text),
    links (verified pairs that the document's text is in)."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    signed = pin(sign(texts), "bagminhash-signed")
    nodes = pin(signed.groupBy("tid").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("keys").alias("keys")), "bagminhash-nodes")
    # The many rows of bands and items carry a text's 8-byte handle; what meets is looked up by the text's key.
    keyed = nodes.select(F.xxhash64("tid").alias("handle"), F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").count().filter("count > 1").select("key")
    wanted = keyed.join(shared, "key").select("handle").distinct()
    body = texts.withColumn("tid", text_key(F.col("text"))).withColumn("handle", F.xxhash64("tid"))
    sets = pin(shingle_sets(body.join(wanted, "handle", "left_semi").dropDuplicates(["handle", "tid"])), "bagminhash-sets")
    # A text of whose items more than 1 - similarity are its own is similar to no other text.
    alive = (
        sets.select("tid", F.size("items").alias("n"), F.xxhash64("tid").alias("handle")).join(own_items(sets), "handle", "left").drop("handle")
        .withColumn("own", F.coalesce("own", F.lit(0))).filter(F.col("n") - F.col("own") >= similarity * F.col("n") - 1e-9)
    )
    now, edges = classes(alive.join(nodes.select("tid", "keys"), "tid"), sets, similarity)
    ends = [e.select(F.explode(F.array("a", "b")).alias("tid")) for e in edges]
    links = reduce(DataFrame.unionByName, ends, nodes.select("tid").limit(0)).groupBy("tid").agg(F.count("*").alias("links"))
    # A text with one document and no link is its own class; only the others are joined back.
    special = (
        nodes.select("tid", "rep", "copies").join(now.select("tid", "comp").join(links, "tid"), "tid", "left")
        .filter("copies > 1 OR links > 0").withColumn("comp", F.coalesce("comp", "tid"))
    )
    least = special.groupBy("comp").agg(F.min("rep").alias("class_id"))
    special = pin(special.join(least, "comp").select("tid", "rep", "class_id", "links"), "bagminhash-special")
    unpin(nodes, sets, now, *edges)
    out = signed.select("doc_id", "tid").join(special, "tid", "left").select(
        "doc_id", "tid", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("rep", "doc_id").alias("copy_of"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    out.pinned = signed, special  # what it reads
    return out


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, all columns, with one of each class: that with the least doc_id.

    Of rows that share doc_id and text one stays; rows without a doc_id stay, one for each text, if no row of
    their class has one.  The rows travel as one struct, so that no column of theirs can clash.  They are dealt by key
    at every size: the rows to drop grow with the corpus and are never sent to all tasks."""
    found = near_duplicates(docs, similarity)
    named = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), text_key(F.col("text")).alias("of"))
    same = lambda other: named["id"].eqNullSafe(other["doc_id"]) & (named["of"] == other["tid"])
    drops = pin(found.filter(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select("doc_id", "tid").distinct(), "bagminhash-drops")
    again = pin(found.groupBy("doc_id", "tid").count().filter("count > 1").select("doc_id", "tid"), "bagminhash-repeats")
    unpin(*found.pinned)
    kept = named.join(drops.hint("merge"), same(drops), "left_anti")
    if not again.isEmpty():
        repeated = kept.join(again, same(again), "left_semi").dropDuplicates(["id", "of"])
        kept = kept.join(again, same(again), "left_anti").unionByName(repeated)
    return kept.select("row.*")


def op10_bagminhash(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` with the class of their near-duplicates."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("tid")
