"""Repair of conversation structure by a suffix-shared automaton.

Each conversation becomes a signature: one letter a row for its role and its first fault.
Read from the end, signatures share their common suffixes: the automaton has one node for
each distinct suffix. A node holds, for each state of the role grammar ``(s?(ua)+)?``, the
cost to go and the first edit of the best audit; the rest of that audit is the best one of
the node and state which the edit leads to, so it is stored once for all conversations
that end alike. Cost vectors that differ by a constant only are one class, so a node is a
class and an offset, and the step from class and letter to class is computed once.

Signatures are sorted by their reverse, so the nodes of a range of them are visited once
each and only those of the present signature are held. A conversation of any number of rows
is split over ranges while its rows are read; its signature (a byte a row) is one value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.arrow import prepare
from obsflow.llm.order import ordered, range_of
from obsflow.session import materialize

# Edits and what they cost.
DELETE, INSERT, KEEP, REROLE = "DIKR"
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED_COST = 5

# Faults of a row, in the order in which they are looked for.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
ROLES = "sua"  # initials; any other is the fourth
FIRST = ord("A")

# Grammar states: nothing yet, after s, after u, after a. Nothing and after-a may end.
_AFTER = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_NEXT = (2, 2, 3, 2)  # where a user or assistant row, whichever fits, leads
_ENDS = (0, 3)

NOT_BLANK = r"[^\x20\x09-\x0D]"
_SPLIT = 1 << 16


class Class(NamedTuple):
    """Nodes with equal costs to go (less the least) and equal first edits."""

    cost: tuple[int, int, int, int]
    edit: tuple[str, str, str, str]  # "" where the audit ends


class Automaton:
    """The classes of nodes, grown as letters call for them."""

    def __init__(self) -> None:
        self.classes: list[Class] = []
        self._ids: dict[Class, int] = {}
        self._steps: dict[tuple[int, int], tuple[int, int]] = {}
        self.end, self.end_cost = self._node([{"": 0} if s in _ENDS else {} for s in range(4)])

    def _node(self, choices: list[dict[str, int]]) -> tuple[int, int]:
        """(class, offset) of a node whose states have these edits and costs, besides inserts."""
        best = [min(c.values(), default=1 << 60) for c in choices]
        for _ in range(2):  # two inserts in a row at most: the third is back at the first's state
            best = [min(b, COST[INSERT] + best[_NEXT[s]]) for s, b in enumerate(best)]
        for s, c in enumerate(choices):
            c[INSERT] = COST[INSERT] + best[_NEXT[s]]
        edit = tuple(min(e for e, cost in c.items() if cost == best[s]) for s, c in enumerate(choices))
        low = min(best)
        found = Class(tuple(b - low for b in best), edit)
        if found not in self._ids:
            self._ids[found] = len(self.classes)
            self.classes.append(found)
        return self._ids[found], low

    def step(self, node: int, letter: int) -> tuple[int, int]:
        """(class, added offset) of the node one row further from the end."""
        if (node, letter) not in self._steps:
            role, fault = divmod(letter - FIRST, 4)
            to_go = self.classes[node].cost
            choices = []
            for s in range(4):
                c = {DELETE: COST[DELETE] + to_go[s]}
                if fault in (SOUND, TRUNCATED):
                    more = TRUNCATED_COST * (fault == TRUNCATED)
                    c[REROLE] = COST[REROLE] + more + to_go[_NEXT[s]]
                    if (s, role) in _AFTER:
                        c[KEEP] = COST[KEEP] + more + to_go[_AFTER[s, role]]
                choices.append(c)
            self._steps[node, letter] = self._node(choices)
        return self._steps[node, letter]


class Suffixes:
    """Audits of signatures, given in the order of their reverses."""

    def __init__(self) -> None:
        self.automaton = Automaton()
        self.path = b""  # the reversed signature whose nodes are held
        self.node, self.offset = [self.automaton.end], [self.automaton.end_cost]
        self.said: tuple[int, str, str] | None = None

    def solve(self, signature: bytes) -> tuple[int, str, str]:
        """(cost, audit, role initial of each edit, ``-`` where it leaves no row)."""
        back = signature[::-1]
        if self.said is not None and back == self.path:
            return self.said
        low, high = 0, min(len(back), len(self.path))
        while low < high:  # the shared suffix
            mid = (low + high + 1) // 2
            low, high = (mid, high) if back[:mid] == self.path[:mid] else (low, mid - 1)
        del self.node[low + 1 :], self.offset[low + 1 :]
        for letter in back[low:]:
            node, more = self.automaton.step(self.node[-1], letter)
            self.node.append(node)
            self.offset.append(self.offset[-1] + more)
        self.path = back
        audit, roles, state, at = [], [], 0, len(back)
        classes = self.automaton.classes
        while edit := classes[self.node[at]].edit[state]:
            if edit != DELETE:
                role = (back[at - 1] - FIRST) // 4 if edit == KEEP else 2 if state == 2 else 1
                state = _AFTER[state, role]
            audit.append(edit)
            roles.append("-" if edit == DELETE else ROLES[role])
            at -= edit != INSERT
        self.said = self.offset[-1] + classes[self.node[-1]].cost[0], "".join(audit), "".join(roles)
        return self.said


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    suffixes = Suffixes()
    for batch in batches:
        out: list[tuple] = []
        size = 0
        begin = 0
        for i, signature in enumerate(batch.column("signature")):
            text = signature.as_py().encode()
            letters = np.frombuffer(text, np.uint8) - FIRST
            fault, role = letters % 4, letters // 4
            legal = (role[:-1] < 2) & (role[1:] == role[:-1] + 1) | (role[:-1] == 2) & (role[1:] == 1)
            out.append((*(int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)), int((~legal).sum()), *suffixes.solve(text)))
            size += 2 * len(text)
            if size > 4 << 20 or i == batch.num_rows - 1:
                kinds = [pa.int64()] * 5 + [pa.string()] * 2
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                part = batch.slice(begin, i + 1 - begin)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("conv_id", "first", "n")), *columns], names=["conv_id", "first", "n", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "roles"])
                out, size, begin = [], 0, i + 1


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each edit that leaves a row; ``pos`` is the row it edits, null for inserts."""
    for batch in batches:
        for conv, first, n, audit, roles in zip(*(batch.column(c) for c in ("conv_id", "first", "n", "audit", "roles")), strict=True):
            letters, kinds = np.frombuffer(audit.as_py().encode(), np.uint8), np.frombuffer(roles.as_py().encode(), np.uint8)
            counts = n.values.to_numpy()
            starts = np.concatenate([[0], np.cumsum(counts)])
            shift = first.values.to_numpy() - starts[:-1]
            row = np.cumsum(letters != ord(INSERT)) - 1
            for a in range(0, len(letters), _SPLIT):
                place = a + np.flatnonzero(letters[a : a + _SPLIT] != ord(DELETE))
                own = row[place]
                fragment = np.maximum(np.searchsorted(starts, own, "right") - 1, 0)
                added = letters[place] == ord(INSERT)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([conv.as_py()] * len(place), pa.int64()), pa.array(place),
                        pa.array(np.where(added, 0, own + shift[np.minimum(fragment, len(shift) - 1)]), mask=added),
                        pa.array(letters[place].view("S1").astype("U1")), pa.array(kinds[place].view("S1").astype("U1")),
                    ],
                    names=["conv_id", "place", "pos", "edit", "initial"],
                )


class Repaired(NamedTuple):
    #: conv_id, blank, duplicate, truncated, illegal, cost, audit, gaps; a row a conversation
    conversations: DataFrame
    #: conv_id, place, edit, role, text; the repaired conversations' rows, in order of place
    rows: DataFrame


def repair(spark: SparkSession, turns: DataFrame) -> Repaired:
    """The cheapest edits that make each conversation's roles read ``(s?(ua)+)?``.

    Reads ``conv_id, turn, role, text`` only. A null role or text is one space; rows without
    a conversation id form one conversation of their own. Rows go by ``turn`` (null first),
    ties by role, then the text's first 64 characters, then its SHA-256; equal rows are
    rows of their own, all but one of them duplicates. A blank text, a repeat of an earlier
    role and text, and a text whose last character (white space aside) is none of ``.!?``
    are faults; a row counts under its first one. Empty tables give empty results. Rows,
    texts and repeats of any number are spread over tasks; a conversation's audit is one value.
    """
    prepare(spark)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    tail = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = F.when(~F.col("text").rlike(NOT_BLANK), BLANK).when(~tail.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    rows = rows.withColumns({"digest": F.sha2("text", 256), "head": F.substring("text", 1, 64), "fault": fault, "row": F.monotonically_increasing_id()})
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("digest"), F.col("row")]
    placed = ordered(spark, rows, order, "turns").drop("row", "head")

    heads = placed.where(F.col("fault") != BLANK).groupBy("conv_id", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    known = placed.select("conv_id", "turn", "role", "fault", "pos").join(heads, "pos", "left")
    first_fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("new").isNull(), DUPLICATE).otherwise(F.col("fault"))
    initial = F.instr(F.lit(ROLES), F.substring("role", 1, 1))
    kind = F.when((initial == 0) | (F.col("role") == ""), len(ROLES)).otherwise(initial - 1)
    letter = F.char((F.lit(FIRST) + 4 * kind + first_fault).cast("long"))
    pieces = known.groupBy("conv_id", range_of("pos").alias("range")).agg(
        F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", letter.alias("l")))), lambda x: x["l"]), "").alias("part"),
    )
    whole = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("first", "n", "part"))).alias("p"))
    whole = whole.select("conv_id", F.array_join("p.part", "").alias("signature"), F.col("p.first").alias("first"), F.col("p.n").alias("n"))
    back = F.reverse("signature")
    near = whole.repartitionByRange(F.substring(back, 1, 256), F.col("conv_id").asc_nulls_first()).sortWithinPartitions(back, F.col("conv_id").asc_nulls_first())
    solved = materialize(
        spark,
        near.select("conv_id", "signature", "first", "n").mapInArrow(
            _solve, "conv_id long, first array<long>, n array<long>, blank long, duplicate long, truncated long, illegal long, cost long, audit string, roles string"
        ),
        "audits",
    )
    stops = placed.select("conv_id", "turn").distinct().groupBy("conv_id")
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    stops = stops.agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps")).withColumnRenamed("conv_id", "c")
    told = solved.select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    told = told.join(stops, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    edits = solved.select("conv_id", "first", "n", "audit", "roles").mapInArrow(_edits, "conv_id long, place long, pos long, edit string, initial string")
    named = F.when(F.col("initial") == "u", "user").otherwise("assistant")
    own = edits.where("pos is not null").join(placed.select("pos", "role", "text"), "pos")
    own = own.select("conv_id", "place", "edit", F.when(F.col("edit") == KEEP, F.col("role")).otherwise(named).alias("role"), "text")
    added = edits.where("pos is null").select("conv_id", "place", "edit", named.alias("role"), F.lit("").alias("text"))
    return Repaired(told, own.unionByName(added))


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    open_id, state = None, None
    done: list[tuple[int | None, str]] = []
    for batch in batches:
        for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if state is None or conv != open_id:
                if state is not None:
                    done.append((open_id, state.hexdigest()))
                open_id, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done])], names=["conv_id", "repaired_sha256"])
            done = []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([open_id], pa.int64()), pa.array([state.hexdigest()])], names=["conv_id", "repaired_sha256"])


def digests(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation's ``role:text`` lines, read as a stream: a digest
    needs its conversation's rows in one place in order, but never in memory together."""
    prepare(spark)
    dealt = rows.select("conv_id", "place", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.select("conv_id", "role", "text").mapInArrow(_hash, "conv_id long, repaired_sha256 string")
