"""Conversation structure repair by composed weighted finite-state machines.

A conversation is a chain of turns; three machines are composed: an acceptor of its turns, an edit transducer that
keeps a turn, changes its role, deletes it or inserts an empty one, and an acceptor of legal role sequences, by default
``(s?(ua)+)?`` on the roles' first letters.  The composed machine is made lazily: a state is (turn, state of the role
acceptor), its arcs are made from the turn's letter and faults when it is visited, and since each inserted turn
advances the role acceptor, at most as many insertions as it has states can be useful before a turn.  The repair is the
shortest path over the lexicographic weight (cost, string of edits).  Costs go backwards in topological order; then the
path runs forwards and takes the least letter among the arcs on a cheapest path, which gives the least string of all
cheapest ones, also where one is the beginning of another.  In the role acceptor each state must allow at most one
role that can be inserted, so that a letter determines the next state.

A conversation of any length is spread over tasks.  All turns are sorted over the cluster and cut into segments of
``SEGMENT`` turns.  A segment is a matrix of costs between acceptor states, and products of matrices give the cost to
go at each segment's end; so each segment is repaired on its own and holds its turns only.  Only conversations that are
cut have matrices.  The edits of a conversation then come out of one task as a stream, in order, since its digest is
that of one sequence.

Defined cases: equal turns of a conversation (also in role and text) are kept apart by number; turns with the same
number go by role and text, null numbers come first; null conv_ids are one conversation; a null role or text is one
space; a role without a first letter in the grammar can't be kept; a blank turn is blank even where it is repeated;
without turns the repair is empty; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ._store import pin

SEGMENT = 12  # bits: 4,096 turns
SPACES = " \t\n\x0b\x0c\r"
_NEVER = 1 << 60


@dataclass(frozen=True)
class Grammar:
    """Acceptor of role sequences: ``arcs[state]`` has the next state of each first letter; the start state is 0.
    ``roles`` are the ones that turns can be given."""

    arcs: tuple = ((("s", 1), ("u", 2)), (("u", 2),), (("a", 3),), (("u", 2),))
    finals: tuple = (0, 3)
    roles: tuple = ("user", "assistant")

    def __post_init__(self):
        if any(len([1 for letter, _ in own if letter in [r[0] for r in self.roles]]) > 1 for own in self.arcs):
            raise ValueError("a state may allow one role that can be inserted")

    def step(self, state: int, letter: str) -> int | None:
        return dict(self.arcs[state]).get(letter)

    def given(self, state: int) -> tuple[str, int] | None:
        """The role that a new turn can have after ``state``, and the state then."""
        return next(((r, q) for r in self.roles if (q := self.step(state, r[0])) is not None), None)


@dataclass(frozen=True)
class Costs:
    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3


class Machine:
    """The composition of the edit transducer with the role acceptor, for one turn at a time."""

    def __init__(self, grammar: Grammar = Grammar(), costs: Costs = Costs()):
        self.grammar, self.costs, self.states = grammar, costs, len(grammar.arcs)
        self.letters = {letter for own in grammar.arcs for letter, _ in own}
        self._made: dict[tuple, np.ndarray] = {}
        last = np.full(self.states, _NEVER)
        last[list(grammar.finals)] = 0
        self.last = self._inserted(last[:, None])[:, 0]

    def arcs(self, q: int, letter: str, forced: bool, truncated: bool) -> Iterator[tuple[str, int, int, str | None]]:
        """(edit, cost, next state, new role) of the ways past a turn."""
        yield "D", self.costs.delete, q, None
        if not forced:
            more = self.costs.truncated * truncated
            if (to := self.grammar.step(q, letter)) is not None:
                yield "K", more, to, None
            if given := self.grammar.given(q):
                yield "R", self.costs.rerole + more, given[1], given[0]

    def _inserted(self, go: np.ndarray) -> np.ndarray:
        """Least costs if turns can be inserted before."""
        for _ in range(self.states):
            go = np.array([np.minimum(go[q], self.costs.insert + go[g[1]]) if (g := self.grammar.given(q)) else go[q] for q in range(self.states)])
        return np.minimum(go, _NEVER)

    def matrix(self, *turn) -> np.ndarray:
        """Least cost from each state before a turn (letter, forced, truncated) to each state after it."""
        if turn not in self._made:
            out = np.full((self.states, self.states), _NEVER)
            for q in range(self.states):
                for _, cost, to, _ in self.arcs(q, *turn):
                    out[q, to] = min(out[q, to], cost)
            self._made[turn] = self._inserted(out)
        return self._made[turn]

    def back(self, turns: list[tuple], go: np.ndarray) -> list[np.ndarray]:
        """Costs to go (states x ends) before each turn and, last, after all; turns are (letter, forced, truncated, copies)."""
        out = [go]
        for letter, forced, truncated, copies in reversed(turns):
            go = np.minimum((self.matrix(letter, forced, truncated)[:, :, None] + (go + self.costs.delete * (copies - 1))[None]).min(axis=1), _NEVER)
            out.append(go)
        return out[::-1]

    def path(self, turns: list[tuple], ends: np.ndarray, q: int) -> Iterator[tuple[int, str, str | None, int]]:
        """(turn, edit, new role, state after it) on the shortest path from state q; the edit of a turn's first copy only."""
        go = [x[:, 0].tolist() for x in self.back(turns, ends[:, None])]
        for i, (letter, forced, truncated, copies) in enumerate(turns):
            after = [x + self.costs.delete * (copies - 1) for x in go[i + 1]]
            while True:
                ways = [x for x in self.arcs(q, letter, forced, truncated) if x[1] + after[x[2]] == go[i][q]]
                if (given := self.grammar.given(q)) and self.costs.insert + go[i][given[1]] == go[i][q]:
                    ways.append(("I", self.costs.insert, given[1], given[0]))
                edit, _, q, role = min(ways)
                yield i, edit, role, q
                if edit != "I":
                    break


def faults(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text -> one row for equal ones: with copies (their number), fault (blank, duplicate or
    truncated of the first copy, null if it has none); the other copies are duplicates, or blank like the first."""
    runs = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    runs = runs.withColumn("said", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    again = runs.groupBy("conv_id", "said").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = again.select(F.col("conv_id").alias("_conv"), F.col("said").alias("_said"), "first")
    joined = runs.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("said") == F.col("_said")), "left")
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(bare == "", "blank").when(later, "duplicate").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated")
    return joined.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def _kind(rows: dict, known: set[str]) -> list[tuple]:
    """(letter, forced, truncated, copies) of turns given as lists; the letter is empty if the grammar does not know it."""
    return [(r[:1] if r[:1] in known else "", f in ("blank", "duplicate"), f == "truncated", c) for r, f, c in zip(rows["role"], rows["fault"], rows["copies"], strict=True)]


def segment_ends(placed: DataFrame, machine: Machine) -> DataFrame:
    """conv_id, segment, go, last: the cost to go from each state at the end of each segment of conversations that have
    several, and whether it is their last."""
    conv = placed.schema["conv_id"].dataType
    kind, arrow = conv.simpleString(), to_arrow_type(conv)
    several = placed.groupBy("conv_id").agg(F.min("segment").alias("lo"), F.max("segment").alias("hi")).filter("lo <> hi").select(F.col("conv_id").alias("_conv"))
    narrow = placed.select("conv_id", "segment", "nth", F.substring("role", 1, 1).alias("role"), "fault", "copies")
    cut = narrow.join(several, narrow["conv_id"].eqNullSafe(several["_conv"]), "left_semi")

    def matrix(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        turns = _kind(rows.sort_by("nth").to_pydict(), machine.letters)
        ends = np.where(np.eye(machine.states, dtype=bool), 0, _NEVER)
        return pa.table({"conv_id": pa.array([key[0].as_py()], arrow), "segment": [key[1].as_py()], "costs": [machine.back(turns, ends)[0].ravel().tolist()]})

    def suffixes(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows, go, out = rows.sort_by("segment").to_pydict(), machine.last, []
        for costs in reversed(rows["costs"]):
            out.append(go.tolist())
            go = np.minimum((np.array(costs).reshape(machine.states, -1) + go[None]).min(axis=1), _NEVER)
        return pa.table({"conv_id": pa.array([key[0].as_py()] * len(out), arrow), "segment": rows["segment"], "go": out[::-1], "last": [False] * (len(out) - 1) + [True]})

    made = cut.groupBy("conv_id", "segment").applyInArrow(matrix, f"conv_id {kind}, segment long, costs array<long>")
    return made.groupBy("conv_id").applyInArrow(suffixes, f"conv_id {kind}, segment long, go array<long>, last boolean")


def repair(turns: DataFrame, grammar: Grammar = Grammar(), costs: Costs = Costs(), segment: int = SEGMENT) -> DataFrame:
    """conv_id, turn, role, text -> the edits of each conversation, in order and in one partition: conv_id, edit (K kept,
    R new role, D deleted, I inserted), turn, fault and old_role of the turn (null for I), role and text (null for D)."""
    machine = Machine(grammar, costs)
    turns = turns.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    spark, keys = turns.sparkSession, ["conv_id", "turn", "role", "text"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = faults(turns).repartitionByRange(tasks, *keys[:3], F.substring("text", 1, 32)).sortWithinPartitions(*keys)
    placed = pin(ordered.withColumn("nth", F.monotonically_increasing_id()), "repair-turns").withColumn("segment", F.shiftright("nth", segment))
    ends = segment_ends(placed, machine).select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "go", "last")
    rows = placed.join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("segment") == F.col("_segment")), "left")
    rows = rows.select(*keys, "copies", "fault", "nth", "segment", "go", F.coalesce("last", F.lit(True)).alias("last")).repartition("conv_id").sortWithinPartitions("conv_id", "nth")
    conv, turn = turns.schema["conv_id"].dataType, turns.schema["turn"].dataType
    names = ["conv_id", "edit", "turn", "fault", "old_role", "role", "text"]
    kinds = [to_arrow_type(conv), pa.string(), to_arrow_type(turn), *[pa.string()] * 4]

    def segment_edits(own: list[dict], q: int, last: bool) -> Iterator[tuple]:
        """The edits of a segment's rows from state q; then the state after them."""
        rows = {c: [r[c] for r in own] for c in ("role", "fault", "copies")}
        ends = machine.last if own[-1]["go"] is None else np.array(own[-1]["go"])
        for i, edit, role, after in machine.path(_kind(rows, machine.letters), ends, q):
            r, q = own[i], after
            if edit == "I":
                yield (r["conv_id"], edit, None, None, None, role, "")
                continue
            gone = edit == "D"
            yield (r["conv_id"], edit, r["turn"], r["fault"], r["role"], None if gone else role or r["role"], None if gone else r["text"])
            for _ in range(r["copies"] - 1):
                yield (r["conv_id"], "D", r["turn"], "blank" if r["fault"] == "blank" else "duplicate", r["role"], None, None)
        while last and q not in grammar.finals:
            role, q = grammar.given(q)
            yield (own[-1]["conv_id"], "I", None, None, None, role, "")
        return 0 if last else q

    def edits_of(rows: Iterator[dict]) -> Iterator[tuple]:
        q = 0
        for _, own in groupby(rows, lambda r: (r["conv_id"], r["segment"])):
            own = list(own)
            q = yield from segment_edits(own, q, own[-1]["last"])

    schema = f"conv_id {conv.simpleString()}, edit string, turn {turn.simpleString()}, fault string, old_role string, role string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits = edits_of(r for batch in batches for r in batch.to_pylist())
        while some := list(islice(edits, 5_000)):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], names)

    return rows.mapInArrow(run, schema)


def digests(edits: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """The edits of :func:`repair` -> one row per conversation: gaps, blank, duplicate, truncated and illegal of the turns
    before the repair, cost, audit (the edits) and repaired_sha256 (``role:text`` of the turns after it, a line each).

    Runs on the stream of edits; of a conversation it holds the audit string and running figures."""
    conv = edits.schema["conv_id"].dataType
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    price = {"K": 0, "R": costs.rerole, "D": costs.delete, "I": costs.insert}
    names = ["conv_id", *counts, "audit", "repaired_sha256"]
    kinds = [to_arrow_type(conv), *[pa.int64()] * len(counts), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out = (), []

        def done() -> tuple:
            gaps = most - least + 1 - distinct if distinct else 0
            return (at[0], gaps, *(found[c] for c in counts[1:]), "".join(audit), sha.hexdigest())

        for batch in batches:
            for r in batch.to_pylist():
                if (r["conv_id"],) != at:
                    if at:
                        out.append(done())
                    at, audit, sha, lines, before = (r["conv_id"],), [], hashlib.sha256(), 0, None
                    found, least, most, distinct = dict.fromkeys(counts, 0), None, None, 0
                audit.append(r["edit"])
                found["cost"] += price[r["edit"]] + costs.truncated * (r["edit"] in "KR" and r["fault"] == "truncated")
                if r["edit"] != "D":
                    sha.update(("\n" * (lines > 0) + f"{r['role']}:{r['text']}").encode())
                    lines += 1
                if r["edit"] != "I":
                    if r["fault"]:
                        found[r["fault"]] += 1
                    if before is not None and before + r["old_role"][:1] not in ("su", "ua", "au"):
                        found["illegal"] += 1
                    before, turn = r["old_role"][:1], r["turn"]
                    if turn is not None and turn != most:  # turns come in order
                        least, most, distinct = turn if least is None else least, turn, distinct + 1
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names)
            out = []
        if at:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(done(), kinds, strict=True)], names)

    return edits.mapInArrow(run, f"conv_id {conv.simpleString()}, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults by the CRC-32 of ``conv_id:turn``, nulls being one space; see the README."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), what.alias("what")).filter("what <> 0")
    text = F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("what") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("what") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("_")).drop("_")


def op11_turn_repair(spark, sf_dir: str) -> DataFrame:
    """All ``conversations``, damaged and repaired."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    ids = conversations.select(F.col("conv_id").alias("id")).distinct()
    found = digests(repair(damage(conversations)))
    out = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in figures),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
