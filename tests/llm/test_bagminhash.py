import random
import re
from collections import Counter

import numpy as np
import pytest

from pluvia.llm import bagminhash as B

WORDS = [f"w{i}" for i in range(400)]


def multiset(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower) if w]
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a, b):
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common) if a or b else 0.0


def brute_classes(rows):
    """doc_id -> least doc_id of the class, by comparing all pairs."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = [(i, t, multiset(t)) for i, t in rows]
    for k, (i, t, s) in enumerate(sets):
        for j, u, v in sets[:k]:
            if t == u or similarity(s, v) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i, _ in rows}


def corpus(seed=3):
    rnd, rows = random.Random(seed), []
    for _ in range(25):
        base = [rnd.choice(WORDS) for _ in range(rnd.randint(60, 200))]
        for _ in range(rnd.randint(1, 5)):
            copy = list(base)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = rnd.choice(WORDS)
            rows.append(" ".join(copy))
    passage = " ".join(rnd.choice(WORDS) for _ in range(60))
    rows += [passage + " " + " ".join(rnd.choice(WORDS) for _ in range(10 + k)) for k in range(12)]
    rows += ["spam spam spam spam spam " * 20, "spam spam spam spam spam " * 22, "spam spam spam spam spam " * 5]
    rows += ["", None, "", None, "one two", "one two", "ONE  two", " ", rows[0], rows[0].upper()]
    return list(enumerate(rows))


def test_classes_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, key string, n int")
    got = {r["doc_id"]: r["class_id"] for r in B.near_duplicates(docs).collect()}
    assert got == brute_classes(rows)


def test_query_on_table_equals_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["class_id"] for r in B.op10_bagminhash(spark, sf).collect()}
    assert got == brute_classes(rows)


def test_signature_agreement_is_weighted_jaccard():
    a, b = {1: 3, 2: 1, 3: 8, 4: 1}, {1: 1, 2: 1, 3: 5, 5: 2}
    exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
    m = 20_000
    sides = [(np.full(len(x), i), np.array(list(x), np.uint64), np.array(list(x.values()))) for i, x in enumerate((a, b))]
    value = B.signatures(*(np.concatenate(c) for c in zip(*sides)), 2, m)
    assert np.isfinite(value).all()
    assert abs((value[0] == value[1]).mean() - exact) < 0.015


def test_empty_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert B.near_duplicates(empty).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (7, "a b c d e f"), (8, None)], "doc_id long, text string")
    got = sorted(B.near_duplicates(docs).select("doc_id", "class_id").collect(), key=str)
    assert sorted(r["class_id"] for r in got) == [7, 7, 7, 8]


@pytest.mark.parametrize("small", [0, 1000])
def test_components_of_a_path(spark, small):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["comp"] for r in B.components(edges, small=small).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
