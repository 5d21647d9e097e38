import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash

from pluvia.llm import lpt_shards as P
from pluvia.llm import source_schedule as S


def targets(sizes):
    """Capped shares by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(1 + i % 3) for i, s in enumerate(order)}
    total, out, open_ = float(sum(sizes.values())), {}, set(sizes)
    while open_:
        level = (total - sum(out.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in open_}
            break
        out |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return out


def mixed_rows():
    rnd = random.Random(4)
    big = [(k, "w " * rnd.randint(0, 900), rnd.choice(["a", "a", "a", "b", "c", None, "ß", "Z"])) for k in range(400)]
    return big + [(900, None, "a"), (901, "", "only empty"), (902, "x y", "tiny"), (903, "x " * 20_000, "b"), (None, "q q q", "c"), (5, "q q", "c"), (5, "q q", "c")]


def test_mix_meets_targets(spark):
    rows = mixed_rows()
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, size int")
    got = S.mix_sources(docs).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = targets(sizes), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-9)
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 3 * 64 + 0.01 * t
    assert sorted(map(str, got)) == sorted(map(str, S.mix_sources(docs.repartition(7)).collect()))


def test_mixed_documents_repeat_whole_rows(spark):
    docs = spark.createDataFrame([(k, f"d{k} " * 70, "a" if k < 60 else "b", k) for k in range(120)], "doc_id long, text string, source string, extra long")
    out = S.mixed_documents(docs)
    assert out.columns == docs.columns
    per = {r["source"]: r["n"] for r in out.groupBy("source").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert abs(per["a"] - 40) <= 3 and abs(per["b"] - 80) <= 3
    assert S.mixed_documents(docs.filter("false")).count() == 0


def check_shards(rows, got, shards):
    assert len(got) == len(rows)
    of_text, loads, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    for r in got:
        of_text[r["group_key"]].add(r["shard"])
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(x) == 1 for x in of_text.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert set(loads) <= set(range(shards))
    return loads


def test_shards(spark):
    rnd = random.Random(8)
    rows = [(k, "x" * rnd.randint(0, 400) + f"é{k % 700}") for k in range(900)] + [(1, None), (1, None), (None, None), (2, ""), (2, "")] + [(k, "copy") for k in range(300)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, shard string, slot int")
    got = P.assign_shards(docs, shards=8, bundles_per_shard=16).collect()
    loads = check_shards(rows, got, 8)
    assert max(loads.values()) - min(loads.values()) <= max(2000, 0.05 * max(loads.values()))
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in got} == {(i, len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for i, t in rows}
    assert P.assign_shards(docs.filter("false")).count() == 0


def test_a_group_larger_than_a_shard_stays_whole(spark):
    docs = spark.createDataFrame([(k, "same" * 50) for k in range(200)] + [(1000 + k, f"t{k}") for k in range(50)], "doc_id long, text string")
    loads = check_shards([0] * 250, P.assign_shards(docs, shards=4).collect(), 4)
    assert len(loads) == 4


def test_lpt_is_greedy():
    assert P.lpt_schedule([(5, "a"), (4, "b"), (3, "c"), (3, "d")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}


def test_mixed_documents_give_out_every_copy(spark):
    """Rows that agree in doc_id, source and words, and user columns of any name."""
    rows = [(7, "x " * 40 + "y" * (k % 3), s, 70, f"c{k}", k) for k in range(10) for s in ("a", "b")] + [(k, "z " * 30, "c", k, "c", k) for k in range(40)]
    rows += [(None, "q " * 50, None, 1, None, None)] * 5 + [(9, None, "a", 0, "n", 0), (9, "", "a", 0, "n", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _words int, _copies string, row int")
    narrow = docs.select("doc_id", "text", "source")
    want = Counter()
    for r in S.mix_sources(narrow).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
    out = S.mixed_documents(docs)
    assert out.columns == docs.columns
    got = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in out.collect())
    assert got == +want
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
    assert {k for k in want if k[1] in ("a", "b") and want[k]} <= set(got)


def slow_lpt(items, shards):
    """Every item, largest first, to the shard that has least; ties by key and by number."""
    loads, where = [0] * shards, {}
    for size, key in sorted(items, key=lambda x: (-x[0], str(x[1]))):
        shard = loads.index(min(loads))
        loads[shard] += size
        where[key] = shard
    return where


def test_query_on_table_equals_brute_force(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    groups = defaultdict(int)
    for _, t in rows:
        groups[hashlib.md5(t.encode()).hexdigest()] += len(t.encode()) + 16
    bundles = 40 * 256
    limit, small, items = sum(groups.values()) / bundles, defaultdict(int), []
    bundle = lambda key: (xxhash.xxh64_intdigest(key, 42) - (1 << 64) * (xxhash.xxh64_intdigest(key, 42) >> 63)) % bundles
    for key, size in groups.items():
        if size > limit:
            items.append((size, key))
        else:
            small[bundle(key)] += size
    where = slow_lpt(items + [(size, b) for b, size in small.items()], 40)
    got = P.op5_lpt_shards(spark, sf).collect()
    slots = defaultdict(list)
    texts = Counter(rows)
    assert len(got) == len(rows) and {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}
    by_id = {i: t for i, t in rows}
    for r in got:
        t = by_id[r["doc_id"]]
        key = hashlib.md5(t.encode()).hexdigest()
        assert texts[r["doc_id"], t] and r["size"] == len(t.encode()) + 16 and r["text_crc32"] == zlib.crc32(t.encode())
        assert r["shard"] == where[key if key in where else bundle(key)]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_without_bundles_it_is_plain_lpt(spark):
    rnd = random.Random(3)
    rows = [(k, "x" * rnd.randint(0, 300) + str(k % 150)) for k in range(200)]
    got = P.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards=5, bundles_per_shard=100_000).collect()
    groups = defaultdict(int)
    for _, t in rows:
        groups[hashlib.md5(t.encode()).hexdigest()] += len(t) + 16
    where = slow_lpt([(size, key) for key, size in groups.items()], 5)
    assert all(r["shard"] == where[r["group_key"]] for r in got)


def test_rows_without_doc_id_are_shuffled(spark):
    from pluvia.llm import source_schedule

    rows = spark.createDataFrame([(None, f"word{k} " * (1 + k % 5), "s") for k in range(300)] + [(None, None, "s")], "doc_id long, text string, source string")
    out = source_schedule.mix_sources(rows).collect()
    assert len(out) == 301 and len({r["start"] for r in out if r["size"]}) == 300
