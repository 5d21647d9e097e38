from pathlib import Path

import numpy as np
import pytest

from pluvia.llm import token_scan as T


def brute(files, end):
    out = []
    for name, ids in files.items():
        n, doc = 0, 0
        for i in ids:
            if i == end:
                out.append((name, doc, n, True))
                n, doc = 0, doc + 1
            else:
                n += 1
        if n:
            out.append((name, doc, n, False))
    return sorted(out)


@pytest.mark.parametrize("block_bytes,chunk", [(8, 2), (32, 3), (1 << 20, 1024)])
@pytest.mark.parametrize("dtype", ["<u2", "<u4"])
def test_scan_equals_brute_force(spark, tmp_path, block_bytes, chunk, dtype):
    rnd = np.random.default_rng(2)
    files = {f"{k}.tokens": rnd.integers(0, 9, n) for k, n in enumerate([0, 1, 7, 64, 300])}
    files["none.tokens"] = np.full(50, 3)
    files["only.tokens"] = np.zeros(20, int)
    files["long.tokens"] = np.concatenate([np.full(90, 5), [0], np.full(40, 5)])
    for name, ids in files.items():
        Path(tmp_path, name).write_bytes(ids.astype(dtype).tobytes())
    blocks = T.scan_blocks(T.list_files(spark, f"file://{tmp_path}"), 0, dtype, block_bytes)
    got = sorted((r["name"], r["doc_no"], r["n_tokens"], r["terminated"]) for r in T.stitch(blocks, chunk).collect())
    assert got == brute(files, 0)


def test_query_counts_equal_the_tokenizer(spark, sf):
    encode = T.encoder(Path(T.VOCABULARY).read_bytes())
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r["n_tokens"] for r in T.op1_token_scan(spark, sf).collect()}
    assert got == {r["doc_id"]: len(encode(r["text"] or "")) for r in docs}


def test_edge_rows(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "x " * 50_000), (2, "x " * 50_000), (3, "<|endoftext|> é")]
    folder, written = T.write_token_files(spark.createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, name string"))
    counts = T.stitch(T.scan_blocks(T.list_files(spark, folder), block_bytes=1024))
    got = [(r["doc_id"], r["n_tokens"]) for r in written.join(counts, ["name", "doc_no"]).collect()]
    encode = T.encoder(Path(T.VOCABULARY).read_bytes())
    assert sorted(got, key=str) == sorted([(i, len(encode(t or ""))) for i, t in rows], key=str)
    empty = spark.createDataFrame([], "doc_id long, text string")
    folder, written = T.write_token_files(empty)
    assert written.count() == 0
