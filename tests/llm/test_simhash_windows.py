import random
import re
from collections import Counter

import numpy as np

from pluvia.llm import simhash_windows as S

WORDS = [f"w{i}" for i in range(300)]


def words(text):
    return re.findall(r"[^\s!-/:-@\[-`{-~]+", (text or "").lower())


def bag(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute(docs, items):
    """(doc, item) -> best similarity over all item-sized windows."""
    out = {}
    for d, text in docs:
        w = words(text)
        for k, item in items:
            v = words(item)
            if len(v) < 5 or len(w) < 5:
                continue
            b, n = bag(v), min(len(v), len(w))
            for s in range(len(w) - n + 1):
                a = bag(w[s : s + n])
                common = sum((a & b).values())
                alike = common / (sum(a.values()) + sum(b.values()) - common)
                if alike >= 0.8:
                    out[d, k] = max(out.get((d, k), 0), alike)
    return out


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    items = [(k, text(rnd.randint(15, 50))) for k in range(20)] + [(20, None), (21, "too short"), (22, ""), (23, "a b c d e " * 6), (24, "same words here as there")]
    docs = []
    for d in range(120):
        body = text(rnd.randint(0, 300))
        if d % 2:
            passage = items[d % 20][1].split()
            for _ in range(d % 5):
                passage[rnd.randrange(len(passage))] = rnd.choice(WORDS)
            body += ' "' + " ".join(passage).upper() + '." ' + text(rnd.randint(0, 80))
        docs.append((d, body))
    docs += [(500, None), (501, ""), (502, "a b c d e " * 40), (503, "Same words, here as there!"), (504, items[0][1]), (504, items[0][1])]
    table = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = S.find_leaks(table, bench, block_items=7).collect()
    exact = brute(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(exact)
    assert all(abs(r["similarity"] - exact[r["doc_id"], r["item_id"]]) < 1e-9 for r in got)
    assert sum(r["doc_id"] == 504 for r in got) == 2


def test_query_equals_brute_force_on_benchmark_passages(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    shared = {tuple(words(t)[i : i + 5]) for _, t in items for i in range(len(words(t)) - 4)}
    near = [(d, t) for d, t in docs if shared & set(bag(words(t)))]
    assert {(r["doc_id"], r["item_id"]) for r in S.op6_simhash_windows(spark, sf).collect()} == set(brute(near, items))


def test_multi_index_finds_all_within_radius():
    rnd = np.random.default_rng(1)
    items = rnd.integers(0, 256, (50, 16), dtype=np.uint8)
    prints = np.repeat(items, 4, axis=0)
    for row in prints:
        for bit in rnd.choice(128, rnd.integers(0, 40), replace=False):
            row[bit // 8] ^= 1 << (bit % 8)
    got = set(zip(*(x.tolist() for x in S.MultiIndex(list(range(50)), items).near(prints))))
    apart = np.bitwise_count(prints[:, None, :] ^ items[None]).sum(axis=2)
    assert got == set(zip(*(x.tolist() for x in np.nonzero(apart <= S.RADIUS))))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert S.find_leaks(docs, bench).count() == 0
    assert S.find_leaks(bench.select(bench.item_id.alias("doc_id"), "text"), bench.filter("false")).count() == 0


def test_short_items_are_found_whole(spark):
    bench = spark.createDataFrame([(1, "zebra quartz"), (2, "lone"), (3, "a b c d"), (4, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the Zebra, quartz!"), (2, "zebra and quartz"), (3, "a b c"), (4, "x a b c d y"), (5, "lone"), (6, "zebra"), (7, "one two three four five six seven lone")], "doc_id long, text string")
    got = S.find_leaks(docs, bench, block_items=2)
    assert {(r["doc_id"], r["item_id"], r["first_word"], r["words"]) for r in got.collect()} == {(1, 1, 1, 2), (4, 3, 1, 4), (5, 2, 0, 1), (7, 2, 7, 1), (7, 4, 0, 6)}
    assert {r["doc_id"] for r in S.drop_leaks(docs, bench, block_items=2).collect()} == {2, 3, 6}


def test_index_is_selective():
    """Under a tenth of random pairs are candidates, and none within the radius is lost."""
    rnd = np.random.default_rng(9)
    items, prints = (rnd.integers(0, 256, (n, 16), np.uint8) for n in (300, 400))
    index = S.MultiIndex(list(range(300)), items)
    assert len(index.candidates(prints)) < 0.1 * 300 * 400
    for bits in range(S.RADIUS + 1):
        near = items.copy()
        for row in near:
            for bit in rnd.choice(128, bits, replace=False):
                row[bit // 8] ^= 1 << (bit % 8)
        found = set(zip(*(x.tolist() for x in index.near(near)), strict=True))
        assert {(k, k) for k in range(300)} <= found
