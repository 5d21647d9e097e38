import hashlib
import random
import re
from collections import Counter

from pluvia.llm import imatch as M

md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
SHARES = [256 >> k for k, n in enumerate(M.SUBSETS, 1) for _ in range(n)]


def terms(text):
    return {w for w in re.split("[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text.lower()) if w}


def brute(rows, rarest, commonest):
    """(doc_id, n_chars, sha256, fingerprint, edited fingerprint, near edited, near next) of all rows."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), md5(r[1])))
    df = Counter(w for _, t in rows for w in terms(t))
    digits = {w: "".join(md5(f"{i}:{w}") for i in range(4)) for w, c in df.items() if c * rarest >= len(rows) and c * commonest <= len(rows)}

    def prints(text):
        own = [sorted(w for w in terms(text) if w in digits and int(digits[w][2 * s : 2 * s + 2], 16) < x) for s, x in enumerate(SHARES)]
        return [md5(" ".join(x))[:8] if x else "" for x in own] if any(own) else ["=" + md5(text)]

    def like(f, g):
        either = [(x, y) for x, y in zip(f, g, strict=False) if x or y]
        return sum(x == y for x, y in either) / len(either) if len(f) == len(g) else 0.0

    out = []
    for k, (d, t) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        e = t[: len(t) - len(t) // 2] + other[: len(t) // 2]
        f, g = prints(t), prints(e)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), ".".join(f), ".".join(g), round(like(f, g), 9), round(like(f, prints(other)), 9)))
    return sorted(out, key=str)


def run(spark, rows, **more):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, term string, bucket int")
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in M.fingerprints(table, **more).collect()), key=str)


def test_fingerprints_equal_brute_force(spark):
    rnd = random.Random(3)
    words = [f"w{int(rnd.paretovariate(0.5))}" for _ in range(300)] + ["Élan", "日本", "x1"]
    text = lambda most: "".join(rnd.choice(words) + rnd.choice([" ", ".\n", " - ", "\x00"]) for _ in range(rnd.randint(0, most)))
    rows = [(d * 7 % 101, text(80)) for d in range(90)] + [(None, text(40)), (None, None), (3, ""), (3, "w1 w2 w3"), (3, "w1 w2 w3"), (-5, "..."), (200, text(30_000)), (2**63 - 1, "a"), (-(2**63), "b")]
    want = brute(rows, 50, 3)
    assert sum("=" not in r[3] for r in want) > 60
    for more in ({}, {"buckets": 1}, {"most_sent": 0, "buckets": 40}):
        assert run(spark, rows, rarest=50, commonest=3, **more) == want


def test_one_and_none(spark):
    assert run(spark, []) == []
    (only,) = run(spark, [(1, "Some text, 7 words.")])
    assert only[2] == hashlib.sha256(b"Some text,Some text").hexdigest() and only[6] == 1.0


def test_equal_texts_have_equal_fingerprints(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    of = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = M.op12_imatch(spark, sf).collect()
    by_text = {}
    for r in got:
        by_text.setdefault(of[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert sum(r["near_edited"] > r["near_next"] for r in got) > 0.85 * len(got)
