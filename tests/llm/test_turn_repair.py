import hashlib
import random
import re
import zlib


from pluvia.llm import turn_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(turns):
    """(cost, edits, repaired lines) of (role, text, fault) by trying all edits, with up to two inserted turns before each and at the end."""
    best = None

    def walk(i, cost, audit, out, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        roles = "".join(r[:1] if r[:1] in "sua" and r else "?" for r, _ in out)
        if not re.fullmatch(r"s?(ua)*u?", roles):
            return
        if i == len(turns):
            if re.fullmatch(r"(s?(ua)+)?", roles):
                best = min(best or (cost, audit, out), (cost, audit, out), key=lambda x: x[:2])
        if inserted < 2:
            for role in ("user", "assistant"):
                walk(i, cost + 3, audit + "I", [*out, (role, "")], inserted + 1)
        if i < len(turns):
            role, text, fault = turns[i]
            walk(i + 1, cost + 4, audit + "D", out, 0)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                walk(i + 1, cost + more, audit + "K", [*out, (role, text)], 0)
                for new in ("user", "assistant"):
                    walk(i + 1, cost + 3 + more, audit + "R", [*out, (new, text)], 0)

    walk(0, 0, "", [], 0)
    return best


def brute(rows):
    """The digest of each conversation of rows (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r or " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for _, role, text in own:
            bare = text.rstrip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, kept = cheapest([(r, x, f) for (_, r, x), f in zip(own, faults, strict=True)])
        sha = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return sorted(out, key=str)


def run(spark, rows, **more):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", nth int, fault string")
    return sorted((tuple(r) for r in R.digests(R.repair(table, **more)).collect()), key=str)


def random_rows(seed, conversations, most):
    rnd = random.Random(seed)
    texts = ["Hello.", "Really?", "cut off", "", " \n", "Yes!  ", "the same."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User"]
    rows = [(c, rnd.choice([None, *range(6)]) if c % 3 else t, rnd.choice(roles), rnd.choice(texts)) for c in range(conversations) for t in range(rnd.randint(1, most))]
    return rows + [(None, 0, "user", "a."), (None, 1, None, None), (None, 2, "user", "a."), (None, 2, "user", "a.")]


def test_digests_equal_brute_force(spark):
    rows = random_rows(1, 60, 5)
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, segment=0) == want  # each turn a segment of its own, all conversations cut


def test_long_conversation_in_segments(spark):
    rnd = random.Random(2)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), rnd.choice([f"t{t}.", f"t{t}", "", "again."])) for t in range(3000)] + [(1, 5, "user", "again.")] * 500
    whole = run(spark, rows)
    assert run(spark, rows, segment=4) == whole and len(whole[0][7]) >= 3500 and whole[0][3] > 500


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(4)] + [(None, 3, "user", "a."), (7, None, "user", "b?"), (8, 1, None, None)]
    want = []
    for c, t, role, text in rows:
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        want += [(c, t, "user" if what == 4 else role, text)] * {0: 0, 3: 2}.get(what, 1)
    got = R.damage(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", what int"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) != len(rows)


def test_edits_are_in_order(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "More."), (2, 0, "assistant", "Only this")]
    got = [tuple(r) for r in R.repair(spark.createDataFrame(rows, SCHEMA)).coalesce(1).collect()]
    of = lambda c: [r[1:] for r in got if r[0] == c]
    assert of(1) == [("K", 0, None, "user", "user", "Hi."), ("D", 1, "duplicate", "user", None, None), ("R", 2, None, "user", "assistant", "More.")]
    assert of(2) == [("D", 0, "truncated", "assistant", None, None)]


def test_no_conversations(spark, tmp_path):
    assert run(spark, []) == []
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame([(1, t, "user", "x.") for t in range(3) if zlib.crc32(f"1:{t}".encode()) % 20 == 0], SCHEMA).write.parquet(path)
    assert R.op11_turn_repair(spark, str(tmp_path)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA).write.mode("overwrite").parquet(path)
    (row,) = R.op11_turn_repair(spark, str(tmp_path)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
