import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from pluvia.llm import maxent_lm as L

SMALL = L.Shape(frequent=12, single=4, clusters=3, buckets=256)


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w] + ["</s>"]


def corpus():
    rnd = random.Random(1)
    langs = [[f"{c}{i}" for i in range(30)] for c in "ab"]
    texts = [" ".join(rnd.choices(langs[k % 2], [1 / (i + 1) for i in range(30)], k=rnd.randint(1, 120))) for k in range(300)]
    return list(enumerate(texts)) + [(300, None), (301, ""), (302, "NEVER seen\tbefore Été"), (None, "a1 a2"), (303, texts[0]), (303, texts[0])]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def test_base_equals_brute_force_and_model_beats_it(spark):
    rows = corpus()
    got = L.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), shape=SMALL).collect()
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    expected = Counter((i, held(i), len(words(t)), sum(counts[w] > 0 for w in words(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in rows)
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == expected
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + 0.03 * sum(r["n_tokens"] for r in out)


def test_probabilities_sum_to_one(spark):
    rows = [(i, t) for i, t in corpus() if i is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = L.count_tokens(docs)
    model = L.fit(docs, counts, SMALL)
    known = {r["token"]: r["c"] for r in counts.collect()}
    vocabulary = sorted({w for _, t in rows for w in words(t)[:-1]})
    tests = [(k, f"a1 b2 {w}") for k, w in enumerate([*vocabulary, "unheard"])]
    scored = L.score(spark.createDataFrame([(k, t, True) for k, t in tests], "doc_id long, text string, held_out boolean"), counts, model)
    tokens, at = L.tokens(pa.array([t for _, t in tests]))
    ids = model.vocabulary.ids(tokens)
    log_class, third = model.log_class(ids, at), at[:-1] + 2
    n, v = sum(known.values()), len(known)
    tail_all = n - round((10 ** model.log_count[:-1] - 1).sum()) + v - model.vocabulary.size + 1
    within = lambda token, i: model.log_share[i] if i < model.vocabulary.size else math.log10((known.get(int(token.astype(np.int64)), 0) + 1) / tail_all)
    # After "a1 b2": all words, one unknown word, and the end, whose class probability is taken for the same history.
    p = sum(10 ** (log_class[k] + within(tokens[k], ids[k])) for k in third)
    end = model.vocabulary.ids(np.array([L.END]))[0]
    of_end = model.of_word[end]
    softmax = model.probabilities(model.features(ids, at)[:, third[:1]])[0]
    p += ((1 - SMALL.prior) * softmax[of_end] + SMALL.prior * model.share[of_end]) * 10 ** within(L.END, end)
    assert abs(p - 1) < 1e-4
    # The score is the sum of the parts.
    whole = [sum(log_class[k] + within(tokens[k], ids[k]) for k in range(at[j], at[j + 1])) for j in range(len(tests))]
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert all(abs(got[j] - x) < 1e-6 for j, x in enumerate(whole))


def test_empty(spark):
    assert L.lm_scores(spark.createDataFrame([], "doc_id long, text string"), shape=SMALL).count() == 0
