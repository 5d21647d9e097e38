"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text.  A document is cut into short
windows; a window that the toxic dictionary compresses better than the ordinary one speaks for toxicity.
The window differences of a document (largest three, excess, mean) go through a logistic calibration to a
score between 0 and 1.

The toxic dictionary learns from the spans of toxic documents whose byte six-grams are over-represented in
toxic documents, since whole documents are mostly ordinary.  Both dictionaries are set behind the same
dictionary of common text, so that ordinary text costs the same with either.

Fitting uses a bounded sample: at most ``max_toxic`` and ``max_ordinary`` labelled training documents (least
hash of doc_id); of a text over ``max_bytes`` it takes pieces spread over the whole text.  Half of the sample, by
hash, trains the dictionaries and the others the calibration.  Scoring reads every text whole.  Labels come only from rows whose crc32(doc_id) mod 4 is
not 2; lang, source and doc_id are no inputs of a score.

Defined cases: null and empty texts have no windows and get the calibrated score of that; without labels of
both kinds every score is the share of toxic labels; null labels are ignored and of contradictory ones the
toxic one holds; repeated rows are scored separately; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, STRIDE, GRAM = 64, 32, 6
THRESHOLD = 0.3
MODEL = "share double, common binary, toxic binary, ordinary binary, weights array<double>"


def held_out(doc_id: Column, mod: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % mod == fold, F.lit(False))


def normal(text: str | None) -> bytes:
    """Lower case, white space collapsed."""
    return b"" if not text else b" " + " ".join(text.lower().split()).encode("utf-8", "surrogatepass") + b" "


def windows(data: bytes, size: int = WINDOW, stride: int = STRIDE) -> list[bytes]:
    """Overlapping windows that cover the whole text; the last may be shorter."""
    return [data[i : i + size] for i in range(0, max(1, len(data) - size + stride), stride)] if data else []


def grams(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    if len(a) < GRAM:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(a) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | a[i : len(a) - GRAM + 1 + i]
    return out


def contrast_grams(toxic: list[bytes], ordinary: list[bytes], min_share: float = 0.01, min_ratio: float = 60.0) -> np.ndarray:
    """Six-grams in at least ``min_share`` of the toxic texts and ``min_ratio`` times rarer in ordinary ones."""
    ut, nt = np.unique(np.concatenate([np.unique(grams(d)) for d in toxic] + [np.zeros(0, np.uint64)]), return_counts=True)
    ut, nt = (x[nt >= max(3, min_share * len(toxic))] for x in (ut, nt))
    rest = np.zeros(len(ut), np.int64)
    for data in ordinary:
        rest += np.isin(ut, grams(data))
    ratio = ((nt + 0.5) / (len(toxic) + 1)) / ((rest + 0.5) / (len(ordinary) + 1))
    floor = min(min_ratio, (len(ordinary) + 1) / 2)  # what an unseen gram can reach in a small sample
    return ut[ratio >= floor]


def spans(data: bytes, chosen: np.ndarray) -> list[bytes]:
    """Maximal runs of ``data`` that the chosen grams cover."""
    hit = np.isin(grams(data), chosen)
    covered = np.zeros(len(data) + 2, np.int8)
    for i in range(GRAM):
        covered[1 + i : 1 + i + len(hit)] |= hit
    edge = np.diff(covered)
    return [data[i:j] for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; the samples' tail where they are too few to train one."""
    packed = [b"".join(samples[i : i + 24]) for i in range(0, len(samples), 24)]
    try:
        return zstandard.train_dictionary(size, packed, k=24, d=6).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class Distance:
    """Compressed lengths of windows with the ordinary dictionary, less those with the toxic one."""

    def __init__(self, common: bytes, toxic: bytes, ordinary: bytes):
        params = zstandard.ZstdCompressionParameters(
            window_log=18, hash_log=16, chain_log=16, search_log=1, min_match=6, strategy=zstandard.STRATEGY_DFAST,
            write_content_size=0, write_dict_id=0)
        both = (zstandard.ZstdCompressionDict(common + x or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT) for x in (toxic, ordinary))
        self.toxic, self.ordinary = (zstandard.ZstdCompressor(compression_params=params, dict_data=d) for d in both)

    @staticmethod
    def _lengths(packer: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
        out = packer.multi_compress_to_buffer(parts)
        return np.fromiter((len(out[i]) for i in range(len(out))), np.int32, len(out))

    def features(self, texts: list[bytes], at_once: int = 50_000) -> np.ndarray:
        """One row per text: three largest differences, excess, strong windows, mean, log of windows."""
        rows = np.zeros((len(texts), 7))
        for k, data in enumerate(texts):
            best, excess, strong, total, n = np.zeros(3), 0, 0, 0, 0
            for i in range(0, len(data), at_once * STRIDE):
                parts = windows(data[i : i + at_once * STRIDE + WINDOW - STRIDE])
                d = self._lengths(self.ordinary, parts) - self._lengths(self.toxic, parts)
                best = np.sort(np.concatenate([best, d]))[-3:]
                excess, strong = excess + np.maximum(d - 3, 0).sum(), strong + (d >= 6).sum()
                total, n = total + d.sum(), n + len(d)
            rows[k] = [*best[::-1], np.log1p(excess), np.log1p(strong), total / max(1, n), np.log1p(n)]
        return rows


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method with a small ridge; the first weight is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def crossed(f: np.ndarray) -> np.ndarray:
    """The features and their products with the largest difference and the text's length."""
    return np.column_stack([f, f[:, :1] * f[:, 1:2], f[:, 3:4] * f[:, 6:7], f[:, 0:1] * f[:, 6:7], f[:, 0:1] ** 2]) / 10


def sampled(text: Column, max_bytes: int, piece: int = 512) -> Column:
    """The text, or pieces spread evenly over it where it has over ``max_bytes``."""
    last = max_bytes // piece - 1
    at = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda i: F.substring(text, 1 + F.floor(i * (F.length(text) - piece) / last).cast("int"), piece))
    return F.when(F.octet_length(text) <= max_bytes, text).otherwise(F.array_join(at, " "))


def fit(docs: DataFrame, labels: DataFrame, mod: int = 4, fold: int = 2, max_toxic: int = 3000, max_ordinary: int = 5000, max_bytes: int = 32_768) -> dict:
    """The model from a bounded sample of labelled training rows, see above; one task trains it, the driver gets
    the dictionaries and weights."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), mod, fold))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("doc_id")
    pick = lambda y, n: known.filter(F.col("toxic") == y).orderBy(order, "doc_id").limit(n)
    ids = pick(1, max_toxic).unionByName(pick(0, max_ordinary))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").filter(F.octet_length("text") > 0).select(sampled(F.col("text"), max_bytes).alias("text"), "toxic")
    # A text counts once; of equal ids with several texts the first by hash are taken up to the bound.
    rows = rows.distinct().orderBy(F.xxhash64("text"), "text", "toxic").limit(max_toxic + max_ordinary)
    got = rows.withColumn("sample", F.lit(0)).groupBy("sample").applyInArrow(_fit_task, MODEL).first()
    return {"share": 0.0} if got is None else {k: v for k, v in got.asDict().items() if v is not None}


def _fit_task(table: pa.Table) -> pa.Table:
    texts = sorted({(normal(t), y) for t, y in zip(table.column("text").to_pylist(), table.column("toxic").to_pylist(), strict=True)})
    model = dict.fromkeys(("common", "toxic", "ordinary", "weights")) | {"share": sum(y for _, y in texts) / len(texts)}
    side = lambda y, half: [t for t, label in texts if label == y and zlib.crc32(t) % 2 == half]
    toxic, ordinary = side(1, 0), side(0, 0)
    if toxic and ordinary and side(1, 1) and side(0, 1):
        chosen = contrast_grams(toxic, ordinary)
        pieces = lambda docs, n: [w for t in docs for w in windows(t, n, n)]
        parts = {
            "common": train(pieces(ordinary, 128), 96 << 10),
            "toxic": train([s for t in toxic for s in spans(t, chosen)], 2 << 10),
            "ordinary": train(pieces(ordinary, 32), 2 << 10),
        }
        again = side(1, 1) + side(0, 1)
        y = np.array([1.0] * len(side(1, 1)) + [0.0] * len(side(0, 1)))
        model |= parts | {"weights": logistic(crossed(Distance(**parts).features(again)), y).tolist()}
    return pa.table({"share": pa.array([model["share"]], pa.float64()), **{k: pa.array([model[k]], pa.binary()) for k in ("common", "toxic", "ordinary")},
                     "weights": pa.array([model["weights"]], pa.list_(pa.float64()))})


class Scorer:
    """Scores batches of texts in a task."""

    def __init__(self, model: dict):
        self.model = model
        self.distance = Distance(*(bytes(model[k]) for k in ("common", "toxic", "ordinary"))) if "weights" in model else None

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(scores, numbers of windows)."""
        if self.distance is None:
            return np.full(len(texts), float(self.model["share"])), np.zeros(len(texts), np.int64)
        f = self.distance.features([normal(t) for t in texts])
        x = np.column_stack([np.ones(len(f)), crossed(f)])
        return 1 / (1 + np.exp(-np.clip(x @ self.model["weights"], -30, 30))), np.round(np.expm1(f[:, 6])).astype(np.int64)


def score(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, windows of every document."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            p, n = scorer(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array(n)], ["doc_id", "score", "windows"])

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, f"doc_id {kind}, score double, windows long")


def drop_toxic(docs: DataFrame, model: dict, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents, all columns, whose score is under the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array(scorer(batch.column(text).to_pylist())[0] < threshold))

    return docs.mapInArrow(run, docs.schema)


def op7_zstd_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity; learns from rows whose crc32(doc_id) mod 4 is not 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"), "windows")
