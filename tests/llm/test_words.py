import numpy as np
import pyarrow as pa

from pluvia.llm import _words


def test_words_match_split(monkeypatch):
    monkeypatch.setattr(_words, "_PIECE", 7)
    texts = ["The cat sat", None, "", "  the\tCAT\n", "été the", "x" * 700, "a b the"]
    hashes, offsets = _words.word_hashes(pa.array(texts))
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    expected = [[w for w in __import__("re").split("[\x20\x09-\x0d]+", lower(t)) if w] for t in texts]
    assert np.diff(offsets).tolist() == [len(x) for x in expected]
    flat = [w for x in expected for w in x]
    seen = {}
    for w, h in zip(flat, hashes.tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_sliced_column():
    whole = pa.array(["a b", "c d e", "a"])
    hashes, offsets = _words.word_hashes(whole.slice(1, 2))
    assert offsets.tolist() == [0, 3, 4]
    assert hashes[3] == _words.word_hashes(whole)[0][0]


def test_shingles():
    h, o = _words.word_hashes(pa.array(["a b c d e f", "b c d e f", "a b", "", "a b c d e"]))
    s, at = _words.shingles(h, o)
    assert np.diff(at).tolist() == [2, 1, 1, 0, 1]
    assert s[1] == s[2] and s[0] == s[4] and len(set(s.tolist())) == 3
