import base64
import hashlib
from collections import defaultdict

from pluvia.llm import site_lines as S
from pluvia.llm import warc_revisit as W

PAGES = [
    (1, "http://a.example/1", "<p>x</p>"), (2, "http://a.example/2", "<p>x</p>"), (9, "http://b.example/", "<p>x</p>"), (3, None, None), (4, "http://c.example/ü ?\n", ""),
    (None, "http://c.example", "<p>x</p>"), (5, "http://d.example", "é" * 200_000), (6, "http://d.example", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"), (6, "http://d.example", "again"), (6, "http://d.example", "again"),
]


def test_revisits_equal_brute_force(spark):
    pages = spark.createDataFrame([(*r, "x") for r in PAGES], "page_id long, url string, html string, file string").repartition(3)
    raw = W.write_archives(pages)
    final = W.rewrite_archives(raw, W.resolve(W.read_headers(raw)))
    got = W.read_headers(final).collect()
    groups = defaultdict(list)
    for pid, _, html in PAGES:
        groups[html or ""].append(pid)
    expected = []
    for html, ids in groups.items():
        body = html.encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = max(ids, key=lambda i: -1 if i is None else i)
        rest = list(ids)
        rest.remove(first)
        expected += [(first, len(body), digest, "response", None), *[(i, len(body), digest, "revisit", first) for i in rest]]
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=str) == sorted(expected, key=str)


def test_min_bytes_and_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    raw = W.write_archives(pages)
    kept = W.resolve(W.read_headers(raw), min_bytes=6).filter("original IS NOT NULL")
    assert sorted(r["payload_bytes"] for r in kept.collect()) == [8, 8, 8]
    bodies = [block.partition(b"\r\n\r\n")[2] for r in raw.collect() for _, _, block in W.records_of(r["file"])]
    assert sorted(bodies) == sorted((h or "").encode() for _, _, h in PAGES)


def test_no_pages(spark):
    raw = W.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert W.read_headers(W.rewrite_archives(raw, W.resolve(W.read_headers(raw)))).count() == 0


def test_archives_roll(spark, monkeypatch):
    roller = W._Roller(W.shared_dir(spark, "roll"))
    monkeypatch.setattr(W, "ROLL_RECORDS", 2)
    for k in range(5):
        roller.add(W.make_record("response", k, None, W.digest_of(b"x"), 1, b"x"))
    roller.close()
    assert [r[1] for r in roller.done] == [2, 2, 1]


def test_lines(spark):
    html = lambda k: f"<html><head><title>T&amp;{k}</title><script>no()</script></head><body><div>Menu</div><p>Own  {k}<br>Menu</p><b>in</b>line</body></html>"
    rows = [(k, f"http://User@Site.example:80/{k}", html(k)) for k in range(6)] + [(50, "http://few.example/", html(50)), (51, None, html(51)), (52, "nonsense", "<p>Menu</p>"), (53, "http://site.example", None), (1, "http://site.example/1", html(1))]
    docs = spark.createDataFrame([(*r, "h", "l") for r in rows], "page_id long, url string, html string, host string, lines string")
    got = {(r["page_id"], r["host"]): r for r in S.drop_site_lines(docs).collect()}
    assert len(S.drop_site_lines(docs).collect()) == len(rows)
    page = got[2, "site.example"]
    assert (page["host_pages"], page["n_lines"], page["n_dropped"], page["text"]) == (8, 5, 3, "T&2\nOwn 2")
    assert got[50, "few.example"]["n_dropped"] == 0 and got[51, None]["n_dropped"] == 0 and got[52, None]["text"] == "Menu"
    assert (got[53, "site.example"]["n_lines"], got[53, "site.example"]["text"]) == (0, "")
    assert S.drop_site_lines(docs.filter("false")).count() == 0
