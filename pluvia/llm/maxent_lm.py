"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class).  The class model is a softmax over hashed features of
the history: the previous word, the pair of previous words (n-grams), and the second and third last words
(skips).  The most frequent words are classes of their own; further frequent words are clustered by the words
they follow; all other words, and unknown words as one more type, form the tail class.  Within a class words are
drawn by their counts (add-one in the tail), so probabilities sum to one over the vocabulary and one unknown.

Training runs in ``rounds`` over disjoint parts of all training documents: tasks take gradient steps on their
documents from the shared weights, and the steps, averaged by tokens, are summed in Spark by weight blocks.
Counts cover all training documents.  What reaches the driver is bounded by parameters: ``frequent`` words,
``frequent`` x ``single`` neighbour counts and ``buckets`` x ``classes`` weights.  Counts of other words stay
distributed: their occurrences are joined by word, none of them being frequent, and summed by document.

Defined cases: a null text is empty, that is one end token; null doc_ids are in training; words are compared by
64-bit hashes; repeated rows count and are scored each; without training documents every token is unknown;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import pin
from ._words import mix, slices, word_hashes

#: The end token; no word hashes to it but by chance of 2^-64.
END = np.uint64(0x656E64)
_PER_SLICE = 400_000


@dataclass(frozen=True)
class Shape:
    frequent: int = 1 << 15
    single: int = 20
    clusters: int = 11
    buckets: int = 1 << 14
    rounds: int = 2
    rate: float = 0.25
    batch: int = 4096
    prior: float = 0.02

    @property
    def classes(self) -> int:
        return self.single + self.clusters + 1


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, offsets) with an end token after each text's words."""
    words, at = word_hashes(texts)
    ends = at[1:] + np.arange(len(at) - 1)
    out = np.zeros(len(words) + len(ends), np.uint64)
    here = np.ones(len(out), bool)
    here[ends] = False
    out[here], out[ends] = words, END
    return out, at + np.arange(len(at))


def count_tokens(docs: DataFrame, at_once: int = 4_000_000) -> DataFrame:
    """text -> token, c over all rows; tasks count before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            token, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(c)], ["token", "c"])

        for batch in batches:
            t, _ = tokens(batch.column("text"))
            held.append(t)
            n += len(t)
            if n >= at_once:
                yield flush()
                held, n = [], 0
        yield flush()

    return docs.select("text").mapInArrow(run, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Frequent tokens by rank; ``ids`` gives ranks, ``size`` for all other tokens."""

    def __init__(self, hashes: np.ndarray):
        self.size = len(hashes)
        self.order = np.argsort(hashes)
        self.sorted = hashes[self.order]

    def ids(self, token: np.ndarray) -> np.ndarray:
        if not self.size:
            return np.zeros(len(token), np.int64)
        at = np.minimum(np.searchsorted(self.sorted, token), self.size - 1)
        return np.where(self.sorted[at] == token, self.order[at], self.size)


def histories(ids: np.ndarray, at: np.ndarray, before: int) -> list[np.ndarray]:
    """ids of the 1st, 2nd … last token before each position; ``before`` ahead of a text's start."""
    start = np.repeat(at[:-1], np.diff(at))
    place, out = np.arange(len(ids)), []
    for k in (1, 2, 3):
        out.append(np.where(place - k >= start, ids[np.maximum(place - k, 0)], before))
    return out


def neighbour_counts(docs: DataFrame, vocabulary: Vocabulary, single: int) -> DataFrame:
    """text -> id, near, n: how often frequent word ``id`` comes one to three words after top word ``near``."""
    size = vocabulary.size
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.zeros(size * single, np.int64)
        for batch in batches:
            t, at = tokens(batch.column("text"))
            ids = shared.value.ids(t)
            for h in histories(ids, at, size + 1):
                both = (ids < size) & (h < single)
                grid += np.bincount(ids[both] * single + h[both], minlength=len(grid))
        cell = np.flatnonzero(grid)
        yield pa.RecordBatch.from_arrays([pa.array(cell // single), pa.array(cell % single), pa.array(grid[cell])], ["id", "near", "n"])

    return docs.select("text").mapInArrow(run, "id long, near long, n long").groupBy("id", "near").agg(F.sum("n").alias("n"))


def classify(near: np.ndarray, counts: np.ndarray, shape: Shape) -> np.ndarray:
    """Class of each frequent word: the first ``single`` have their own, the others are clustered by the
    words that they follow (k-means on square roots of shares, seeded by spread-out frequent words)."""
    out = np.arange(len(counts))
    rest = near[shape.single :]
    if not len(rest):
        return out
    x = np.sqrt(rest / np.maximum(rest.sum(axis=1, keepdims=True), 1))
    weight = np.log1p(counts[shape.single :].astype(float))
    centre, gap = x[:1], np.full(len(x), np.inf)
    while len(centre) < min(shape.clusters, len(x)):
        gap = np.minimum(gap, ((x - centre[-1]) ** 2).sum(axis=1))
        centre = np.vstack([centre, x[np.argmax(gap * weight)]])
    for _ in range(20):
        own = np.argmax(x @ centre.T - (centre**2).sum(axis=1) / 2, axis=1)
        for k in range(len(centre)):
            if (own == k).any():
                centre[k] = np.average(x[own == k], axis=0, weights=weight[own == k])
    out[shape.single :] = shape.single + own
    return out


@dataclass
class Model:
    shape: Shape
    vocabulary: Vocabulary
    log_count: np.ndarray  # log10(c + 1) of frequent words, 0 for others
    log_share: np.ndarray  # log10 P(word | class) of frequent words, 0 for others
    of_word: np.ndarray  # class of frequent words, then that of the tail
    weights: np.ndarray
    share: np.ndarray  # of the classes among all training tokens

    def features(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Buckets of the active features, a row for each kind; bucket 0 is the bias that all positions have."""
        one, two, three = (h.astype(np.uint64) for h in histories(ids, at, self.vocabulary.size + 1))
        keys = (one * np.uint64(4), two * np.uint64(4) + np.uint64(1), three * np.uint64(4) + np.uint64(2),
                mix(one * np.uint64(1_000_003) + two) << np.uint64(2) | np.uint64(3))
        return np.stack([(mix(k + np.uint64(17)) % np.uint64(self.shape.buckets - 1)).astype(np.int64) + 1 for k in keys])

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        z = self.weights[0] + self.weights[features[0]]
        for kind in features[1:]:
            z += self.weights[kind]
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z /= z.sum(axis=1, keepdims=True)
        return z

    def step(self, features: np.ndarray, target: np.ndarray, squares: np.ndarray) -> None:
        """One step on a batch of positions; each bucket has a rate that falls with its squared gradients."""
        error = self.probabilities(features)
        n = len(target)
        error[np.arange(n), target] -= 1
        flat = features.ravel()
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) > 0]))
        rows = np.append(flat[order[first]], 0)
        grad = np.vstack([np.add.reduceat(error[order % n], first, axis=0), error.sum(axis=0)])
        squares[rows] += np.einsum("ij,ij->i", grad, grad) / n
        self.weights[rows] -= grad * (self.shape.rate / np.sqrt(n * squares[rows]))[:, None]

    def learn(self, ids: np.ndarray, at: np.ndarray, squares: np.ndarray) -> None:
        f, target, b = self.features(ids, at), self.of_word[ids], self.shape.batch
        for i in range(0, len(ids), b):
            self.step(f[:, i : i + b], target[i : i + b], squares)

    def log_class(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """log10 P(class | history) of each position, mixed with a little of the classes' shares."""
        f, target = self.features(ids, at), self.of_word[ids]
        p = np.empty(len(ids))
        for i in range(0, len(ids), self.shape.batch):
            own = target[i : i + self.shape.batch]
            p[i : i + len(own)] = self.probabilities(f[:, i : i + len(own)])[np.arange(len(own)), own]
        return np.log10((1 - self.shape.prior) * p + self.shape.prior * self.share[target])


def train_round(docs: DataFrame, model: Model, block: int = 256, fan_in: int = 64) -> np.ndarray:
    """Weights after one distributed round: the tasks' weights averaged by their numbers of tokens.

    The sums go up a tree of ``fan_in``, so that a task adds a few MB at a time however many tasks there are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**{**vars(shared.value), "weights": shared.value.weights.copy()})
        squares, n = np.full(len(own.weights), 1e-2, np.float32), 0
        for batch in batches:
            t, at = tokens(batch.column("text"))
            ids = own.vocabulary.ids(t)
            n += len(ids)
            for i, j in slices(at, _PER_SLICE):
                own.learn(ids[at[i] : at[j]], at[i : j + 1] - at[i], squares)
        if n:
            change = (own.weights - shared.value.weights) * np.float32(n)
            parts = [change[i : i + block].tobytes() for i in range(0, len(change), block)]
            k = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(k), pa.int32()), pa.array([TaskContext.get().partitionId()] * k, pa.int32()), pa.array(parts), pa.array([n] * k, pa.int64())],
                ["block", "task", "change", "n"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, np.float32) for x in rows["change"]], axis=0, dtype=np.float32)
        return pd.DataFrame({"block": rows["block"][:1], "task": rows["task"][:1] // fan_in, "change": [total.tobytes()], "n": [rows["n"].sum()]})

    kind = "block int, task int, change binary, n long"
    changes = docs.select("text").mapInArrow(run, kind)
    for _ in range(2):
        changes = changes.groupBy("block", F.expr(f"task div {fan_in}").alias("up")).applyInPandas(add, kind)
    changes = changes.groupBy("block").applyInPandas(add, kind)
    out = model.weights.copy()
    for r in changes.collect():  # one row per block of the weights
        i = r["block"] * block
        size = len(out[i : i + block])
        out[i : i + size] += np.frombuffer(r["change"], np.float32).reshape(size, -1) / np.float32(r["n"])
    return out


def fit(training: DataFrame, counts: DataFrame, shape: Shape) -> Model:
    """The model of all training texts; ``counts`` as from :func:`count_tokens`."""
    top = counts.orderBy(F.col("c").desc(), "token").limit(shape.frequent).collect()
    c = np.array([r["c"] for r in top], np.int64)
    vocabulary = Vocabulary(np.array([r["token"] for r in top], np.int64).view(np.uint64))
    near = np.zeros((len(top), shape.single))
    for r in neighbour_counts(training, vocabulary, shape.single).collect():  # frequent x single at most
        near[r["id"], r["near"]] = r["n"]
    of_word = classify(near, c, shape)
    tail = shape.classes - 1
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()["n"]
    in_class = np.bincount(of_word, weights=c, minlength=shape.classes).astype(float)
    in_class[tail] = total - c.sum() + 1
    share = in_class / in_class.sum()
    weights = np.zeros((shape.buckets, shape.classes), np.float32)
    weights[0] = np.log(np.maximum(share, 1e-9))
    model = Model(shape, vocabulary, np.append(np.log10(c + 1.0), 0.0), np.append(np.log10(c / in_class[of_word]), 0.0), np.append(of_word, tail), weights, share)
    part = F.pmod(F.xxhash64("text"), F.lit(shape.rounds))
    for r in range(shape.rounds):
        model.weights = train_round(training.filter(part == r) if r or shape.rounds > 1 else training, model)
    return model


def score(docs: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """doc_id, text, held_out -> adds n_tokens, n_known, train_tokens, base_score, score."""
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = totals["n"], totals["v"]
    frequent = float(np.round((10.0 ** model.log_count[:-1] - 1).sum()))
    tail_all = n_all - frequent + (v_all - model.vocabulary.size) + 1
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, row = shared.value, TaskContext.get().partitionId() << 40
        size = model.vocabulary.size
        for batch in batches:
            t, at = tokens(batch.column("text"))
            for i, j in slices(at, _PER_SLICE):
                some, where = t[at[i] : at[j]], at[i : j + 1] - at[i]
                ids = model.vocabulary.ids(some)
                tail = ids == size
                add = lambda x: np.add.reduceat(x, where[:-1])  # noqa: B023, E731  every text has a token
                ends = np.concatenate([[0], np.cumsum(add(tail.astype(np.int64)))])
                rare = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(some[tail].view(np.int64)))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(i, j)), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(where)), pa.array(add((~tail).astype(np.int64))),
                     pa.array(add(model.log_count[ids])), pa.array(add(model.log_share[ids] + model.log_class(ids, where))), rare],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "counts", "partial", "rare"])
            row += batch.num_rows

    scored = pin(
        docs.select("doc_id", "held_out", "text")
        .mapInArrow(run, f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, counts double, partial double, rare array<long>"), "lm-scored")
    rare = (
        scored.select("row", F.explode("rare").alias("token")).join(counts, "token")
        .groupBy("row").agg(F.count("*").alias("rare_known"), F.sum(F.log10(F.col("c") + 1.0)).alias("rare_counts"))
    )
    zero = F.lit(0.0)
    extra = F.coalesce("rare_counts", zero)
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("counts") + extra - F.col("n_tokens") * F.log10(F.lit(float(n_all + v_all + 1)))).alias("base_score"),
        (F.col("partial") + extra - F.size("rare") * F.log10(F.lit(float(tail_all)))).alias("score"),
    )


def lm_scores(docs: DataFrame, mod: int = 7, fold: int = 2, shape: Shape | None = None) -> DataFrame:
    """All documents scored by a model of those whose crc32(doc_id) mod ``mod`` is not ``fold``."""
    shape = shape or Shape()
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == fold, F.lit(False))
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    training = rows.filter(~F.col("held_out"))
    counts = pin(count_tokens(training), "lm-counts")
    return score(rows, counts, fit(training, counts, shape))


def op2_maxent_lm(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` scored by the model of the training documents."""
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
