import math
import random
import re
from collections import Counter

import numpy as np

from pluvia.llm import threshold_search as T

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top):
    """(item_id, rank, doc_id, score) of every row of items."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 75 + 25 * sum(b.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * b[w] // (1000 * b[w] + 12 * m)) for w in terms(text) if w in b)
            scores += [(-s, d is None, d or 0)] * (s > 0)
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:top])]
    return out


def run(spark, docs, items, top, **more):
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, rank string, n int")
    bench = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, score int")
    return sorted((tuple(r) for r in T.search(table, bench, top, **more).collect()), key=str)


def test_best_equal_brute_force(spark):
    rnd = random.Random(7)
    vocabulary = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(400)] + ["Élan", "ß1", "x"]
    text = lambda most: " ".join(rnd.choice(vocabulary) + rnd.choice(["", ".", "-", "\t", "\x00"]) for _ in range(rnd.randint(0, most)))
    docs = [(d, text(60)) for d in range(300)] + [(None, text(60)), (7, None), (8, ""), (9, "... !"), (5, "x x x"), (5, "x x x"), (400, "x x x"), (401, "w1 " * 50_000)]
    items = [(k, text(25)) for k in range(30)] + [(30, None), (31, "?"), (32, "unknown words only"), (33, "X x ß1 ß1"), (33, "X x ß1 ß1"), (34, docs[3][1])]
    want = sorted(brute(docs, items, 5), key=str)
    assert want and run(spark, docs, items, 5) == want
    assert run(spark, docs, items, 5, cells=1, block_items=8) == want


def test_ties_by_id_across_shards(spark):
    docs = [(d, "same words" if d % 2 else "same same words") for d in range(500, 0, -1)] + [(None, "same same words")]
    assert run(spark, docs, [(1, "same")], 20, cells=1) == sorted(brute(docs, [(1, "same")], 20), key=str)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b")], 20) == [] and run(spark, [(1, "a")], [], 20) == []


def test_lists_are_not_read_to_their_end():
    """A rare term's few documents push the bar over what the rest of a frequent term's list can give."""
    n = 20_000
    times = 1 + np.arange(n) % 7
    doc = np.concatenate([np.arange(n), np.arange(40)])
    term = np.concatenate([np.zeros(n, np.int64), np.ones(40, np.int64)])
    shard = T.Shard(np.full(n, 100), doc, term, np.concatenate([times, np.full(40, 3)]), 2, n, 100 * n)
    found, score, read = shard.search(np.array([0, 1]), np.array([1, 9000]), 0)
    assert read < 3_000 and set(found[np.argsort(-score)][:20]) <= set(range(40))
