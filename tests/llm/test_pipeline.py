import corpus_pipeline as C
from pluvia.llm import bagminhash, simhash_windows, source_schedule, zstd_toxicity
from pluvia.llm._store import pin
from tests.llm.test_bagminhash import brute_classes


def test_stages_in_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name, stage in C.STAGES[:-1]:
        out = pin(stage(spark, docs, sf), f"test-{name}")
        assert out.columns == docs.columns
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        ids = [r["doc_id"] for r in out.select("doc_id").collect()]
        if name == "toxicity":
            scores = zstd_toxicity.score(docs, zstd_toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()
            assert sorted(ids) == sorted(r["doc_id"] for r in scores if r["score"] < zstd_toxicity.THRESHOLD)
        elif name == "near_duplicates":
            assert sorted(ids) == sorted(set(brute_classes(sorted(before.items())).values()))
        elif name == "decontamination":
            found = {r["doc_id"] for r in simhash_windows.find_leaks(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
            assert sorted(ids) == sorted(set(before) - found)
        else:
            assert set(ids) <= set(before) and max(ids.count(i) for i in set(ids)) <= 3
        docs = out
    final = C.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted(r["doc_id"] for r in final) == sorted(r["doc_id"] for r in docs.collect())


def test_repeated_rows_leave_one(spark):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, None), (3, None), (None, "x y z"), (None, "x y z"), (4, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = C.near_duplicates(spark, docs, "")
    assert sorted([(r["doc_id"], r["text"]) for r in out.collect()], key=str) == sorted([(1, rows[0][1]), (3, None), (None, "x y z"), (4, "")], key=str)


def test_user_columns_survive(spark):
    """Columns named like the stages' own keep their values, in every stage that returns documents."""
    names = ["_words", "_copies", "_tid", "_doc", "_of", "_doc_id", "_source", "_size", "_copy", "tid", "row", "id", "of", "uid", "copies", "class_id", "size", "start"]
    rows = [(k, f"word{k} " * 3 + "and some more words that all of them have", "en", "s" if k % 2 else None, 1, *[f"{n}{k}" for n in names]) for k in range(12)]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    want = {r[0]: r for r in rows}
    for out in (bagminhash.one_of_each(docs), source_schedule.mixed_documents(docs)):
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(tuple(r) == want[r["doc_id"]] for r in got)
    assert len(bagminhash.one_of_each(docs).collect()) == 12


def test_empty_documents(spark, sf, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        (table.filter("false") if name == "documents" else table).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
