import random
import math
import re
import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from pluvia.llm import quality_divergence as Q
from pluvia.llm import zstd_toxicity as Z


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def base(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {x for x in windows if windows.count(x) > 1}
    covered = {i + j for i, x in enumerate(windows) if x in again for j in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_base_counts_equal_brute_force(spark, sf):
    extra = [(9001, None, "en"), (9002, "", None), (9003, "a b c a b c a b c", "en"), (9004, "a a a a", "xx"), (9005, "x\n\n x\nx\n \nx", "en"), (9006, "a b c d\x0b\x0c a b c é|#", "en"), (9003, "a b c a b c a b c", "en")]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    docs = docs.withColumn("words", F.lit(1)).withColumn("key", F.lit("k"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = Q.judge(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        expected = base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected, r["doc_id"]
        assert r["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert r["kept"] is not None and not (r["base_failed"] and r["kept"])


def test_verdict_agrees_with_quality_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = Q.op8_quality_divergence(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("NOT base_failed")
    share = {r["quality"]: r["kept"] for r in out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.98 and share[0] < 0.3


def test_rare_language_has_its_own_reference(spark):
    rnd = random.Random(5)
    stem = lambda: "".join(rnd.choice("bcdfglmnprst") + rnd.choice("aeiou") for _ in range(3))
    content = [stem() for _ in range(3000)]
    text = lambda small, share: " ".join(rnd.choice(small) if rnd.random() < share else rnd.choice(content) for _ in range(300))
    main, own = [f"m{c}" for c in "abcdefghijkl"], [f"q{c}" for c in "abcdefghijkl"]
    rows = [(k, text(main, 0.17), "main") for k in range(200)]  # more than twenty, light common words
    rows += [(1000 + k, text(own, 0.4), "rare") for k in range(8)] + [(2000, text(own, 0), "rare"), (2001, text(main, 0), "main")]
    rows += [(3000, text(own, 0.4), "one")]  # no reference but itself
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not kept[2000] and not kept[2001] and kept[3000]
    assert sum(kept[1000 + k] for k in range(8)) == 8 and sum(kept[k] for k in range(200)) >= 198


def test_divergence_of_empty_table(spark):
    assert Q.judge(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0


def test_js_distance(spark):
    cols = lambda xs: [F.lit(float(x)) for x in xs]
    row = spark.range(1).select(Q.js_distance(cols([1, 1]), cols([5, 5])).alias("same"), Q.js_distance(cols([1, 0]), cols([0, 3])).alias("apart"), Q.js_distance(cols([0, 0]), cols([1, 1])).alias("none")).first()
    assert abs(row["same"]) < 1e-9 and abs(row["apart"] - 1) < 1e-9 and row["none"] is not None


def toxic_corpus():
    rnd = random.Random(2)
    stems = ["an", "er", "th", "on", "re", "ti", "ed", "in", "sh", "ou"]
    word = lambda: "".join(rnd.choice(stems) for _ in range(rnd.randint(1, 4)))
    docs, labels = [], []
    for k in range(1200):
        w = [word() for _ in range(rnd.randint(20, 120))]
        toxic = k % 5 == 0
        for _ in range(6 * toxic):
            w[rnd.randrange(len(w))] = rnd.choice(["vilegrumpf", "sludgeborn", "krakwaste"])
        docs.append((k, " ".join(w), "en", "s"))
        labels.append((k, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_corpus()
    table = spark.createDataFrame(docs + [(5000, None, "x", "y"), (5001, "", "x", "y"), (None, "an er th", "x", "y"), (5, docs[5][1], "x", "y")], "doc_id long, text string, lang string, source string")
    marks = spark.createDataFrame([*labels, (7, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = Z.score(table, Z.fit(table, marks)).collect()
    assert len(got) == len(docs) + 4 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 1200 and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    right = sum((r["score"] >= Z.THRESHOLD) == (r["doc_id"] % 5 == 0) for r in held)
    assert right / len(held) > 0.95
    kept = Z.drop_toxic(table, Z.fit(table, marks))
    assert kept.columns == table.columns
    assert kept.count() == sum(r["score"] < Z.THRESHOLD for r in got)


def test_toxicity_without_labels(spark):
    table = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Z.score(table, Z.fit(table, marks)).first()["score"] == 0.0
    assert Z.score(table.filter("false"), {"share": 0.0}).count() == 0


def test_query_on_small_table(spark, sf):
    out = Z.op7_zstd_toxicity(spark, sf)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def slow_score(model, text):
    """The score from one zstandard frame per window and dictionary."""
    data = b" " + " ".join(text.lower().split()).encode() + b" " if text else b""
    cut = [data[i : i + 64] for i in range(0, len(data), 32) if i == 0 or i + 32 < len(data)]
    params = zstandard.ZstdCompressionParameters(window_log=18, hash_log=16, chain_log=16, search_log=1, min_match=6, strategy=zstandard.STRATEGY_DFAST, write_content_size=0, write_dict_id=0)
    size = {}
    for side in ("toxic", "ordinary"):
        words = zstandard.ZstdCompressionDict(bytes(model["common"]) + bytes(model[side]), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(compression_params=params, dict_data=words)
        size[side] = [len(packer.compress(w)) for w in cut]
    gain = [o - t for o, t in zip(size["ordinary"], size["toxic"])]
    top = sorted([*gain, 0, 0, 0])[::-1][:3]
    f = [*top, math.log1p(sum(max(g - 3, 0) for g in gain)), math.log1p(sum(g >= 6 for g in gain)), sum(gain) / max(1, len(gain)), math.log1p(len(gain))]
    x = [1.0, *(v / 10 for v in [*f, f[0] * f[1], f[3] * f[6], f[0] * f[6], f[0] ** 2])]
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, model["weights"]))))))


def test_query_scores_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = Z.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    assert "weights" in model
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = Z.op7_zstd_toxicity(spark, sf).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    for r in got:
        want = slow_score(model, texts[r["doc_id"]])
        assert abs(r["score"] - want) < 1e-9 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_long_labelled_texts_are_sampled_all_over(spark):
    text = "".join(f"{k:05d}" for k in range(20_000))
    got = spark.createDataFrame([(text,), ("short",), ("é" * 40_000,)], "t string").select(Z.sampled(F.col("t"), 32_768).alias("t")).collect()
    assert got[1]["t"] == "short"
    parts = got[0]["t"].split(" ")
    assert len(parts) == 64 and text.startswith(parts[0]) and text.endswith(parts[-1]) and all(len(p) == 512 and p in text for p in parts)
    assert len(np.unique([text.index(p) for p in parts])) == 64 and len(got[2]["t"]) == 64 * 513 - 1
