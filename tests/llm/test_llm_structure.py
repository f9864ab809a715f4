"""Conversation repair, hard negatives and source mixing against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm import conversation_repair, hard_negatives, mixing
from obsflow.llm.conversation_repair import FIRST, Suffixes

TURNS = "conv_id long, turn long, role string, text string, cost long, pos long"


def _turns(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], TURNS).repartition(3)


def _roles_after(audit, rows):
    """The roles that an audit leads to, or None where it breaks a rule."""
    out, i = [], 0
    for e in audit:
        if e == "I":
            out.append(None)
            continue
        role, fault = rows[i]
        i += 1
        if e == "D":
            continue
        if fault in ("blank", "duplicate"):
            return None
        out.append(role if e == "K" else None)
    if i != len(rows):
        return None
    body = out[1:] if out and out[0] == "s" else out
    if len(body) % 2 or (out and not body):
        return None
    for k, r in enumerate(body):
        if r not in (None, "ua"[k % 2]):
            return None
    return out[: len(out) - len(body)] + ["ua"[k % 2] for k in range(len(body))]


def _cost(audit, rows):
    total, i = 0, 0
    for e in audit:
        total += {"K": 0, "R": 1, "D": 2, "I": 5}[e]
        if e != "I":
            total += 5 * (e != "D" and rows[i][1] == "truncated")
            i += 1
    return total


def _all_audits(n):
    """Audits of n rows with at most two inserts."""
    for inserts in range(3):
        for letters in itertools.product("DKR", repeat=n):
            for places in itertools.combinations(range(n + inserts), inserts):
                rest = iter(letters)
                yield "".join("I" if k in places else next(rest) for k in range(n + inserts))


def test_suffix_automaton_equals_a_search_of_all_audits():
    faults = ["", "truncated", "blank", "duplicate"]
    rng = random.Random(3)
    cases = [[(rng.choice("suax"), rng.choice(faults + [""] * 4)) for _ in range(n)] for n in (0, 1, 2, 3, 4) for _ in range(30)]
    coded = [(bytes(FIRST + 4 * "suax".index(r) + faults.index(f) for r, f in rows), rows) for rows in cases]
    suffixes = Suffixes()
    for code, rows in sorted(coded, key=lambda c: c[0][::-1]):
        cost, audit, roles = suffixes.solve(code)
        want = min((_cost(a, rows), a) for a in _all_audits(len(rows)) if _roles_after(a, rows) is not None)
        assert (cost, audit) == want, rows
        assert [r for r in roles if r != "-"] == _roles_after(audit, rows)
    assert suffixes.solve(code) == (cost, audit, roles)
    assert len(suffixes.automaton.classes) < 200  # nodes are shared


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _conversations(seed=8):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(0, 7)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            text = rng.choice(["Yes.", "No!", "so", " \t", "", "Why?  ", f"Text {rng.randrange(9)}.", "Ende…"])
            rows += [(conv, rng.choice([turn, turn, None]) if conv % 9 == 0 else turn * (1 + conv % 3), role, text)] * rng.choice([1, 1, 1, 2])
    return rows + [(None, 0, "user", "Hi."), (None, 2, None, None), (77, 0, "user", "z " * 200000 + "."), (77, 1, "assistant", "Well."), (78, None, "user", "One."), (78, None, "user", "One.")]


def _expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, got in by.items():
        got.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        lines = [(role, text) for _, role, text in got]
        faults = _faults(lines)
        initials = [r[:1] for r, _ in lines]
        known = [t for t, _, _ in got if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[conv] = (Counter(faults), sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), gaps, lines, faults)
    return out


def test_repair_equals_brute_force(spark):
    rows = _conversations()
    done = conversation_repair.repair(spark, _turns(spark, rows))
    told = {r["conv_id"]: r for r in done.conversations.collect()}
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in conversation_repair.digests(spark, done.rows).collect()}
    kept = defaultdict(list)
    for r in sorted(done.rows.collect(), key=lambda r: r["place"]):
        kept[r["conv_id"]].append((r["role"], r["text"]))
    want = _expected(rows)
    assert set(told) == set(want)
    solver = Suffixes()
    names = ["", "truncated", "blank", "duplicate"]
    for conv, (count, illegal, gaps, lines, faults) in want.items():
        r = told[conv]
        assert (r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["gaps"]) == (count["blank"], count["duplicate"], count["truncated"], illegal, gaps)
        code = bytes(FIRST + 4 * ("sua".find(role[:1]) % 4 if role else 3) + names.index(f) for (role, _), f in zip(lines, faults, strict=True))
        cost, audit, roles = solver.solve(code)
        assert (r["cost"], r["audit"]) == (cost, audit)
        text, said = iter(lines), []
        for e, kind in zip(audit, roles, strict=True):
            line = ("", "") if e == "I" else next(text)
            if e != "D":
                said.append((line[0] if e == "K" else {"u": "user", "a": "assistant"}[kind], line[1]))
        assert kept[conv] == said
        if said:
            assert hashes[conv] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in said).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(a[:1] for a, _ in said))


def test_repair_of_one_conversation_over_many_ranges(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Line {i}.") for i in range(3000)] + [(2, 0, "user", "Copy.")] * 500
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = conversation_repair.repair(spark, _turns(spark, rows))
        told = {r["conv_id"]: r for r in done.conversations.collect()}
        assert told[1]["audit"] == "K" * 3000 and told[1]["cost"] == 0 and told[1]["illegal"] == 0
        assert told[2]["duplicate"] == 499 and told[2]["cost"] == 499 * 2 + 2 and told[2]["audit"] == "D" * 500
        line = "\n".join(f"{r}:{t}" for _, _, r, t in rows[:3000])
        assert conversation_repair.digests(spark, done.rows).collect()[0]["repaired_sha256"] == hashlib.sha256(line.encode()).hexdigest()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repair_of_an_empty_table(spark):
    done = conversation_repair.repair(spark, spark.createDataFrame([], TURNS))
    assert done.conversations.count() == 0 and done.rows.count() == 0
    assert conversation_repair.digests(spark, done.rows).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, key long, score long, anchor string"


def _negatives(rows, s):
    part = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        part.append((k, i, label, np.floor(s.scale * np.array(v, np.float32).astype(float)).astype(int)))
    by_id = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    out = []
    for k, i, label, v in part:
        if i is None or i % 5:
            continue
        scored = [(int(v @ w) if len(w) else 0, j, m, other) for m, j, other, w in part if m != k and len(w) == len(v)]
        best = sorted(x for x in scored if x[3] == label)
        best = sorted((x for x in scored if x[3] == label), key=by_id)[: s.positives]
        for p in best:
            inside = sorted((x for x in scored if x[3] != label and s.low * p[0] <= 100 * x[0] <= s.high * p[0]), key=by_id)[: s.negatives]
            out += [(i, p[1], r + 1, x[1], p[0], x[0]) for r, x in enumerate(inside)]
    return out


@pytest.mark.parametrize(("block", "step", "rounds"), [(8192, 4, 1 << 24), (16, 1, 1 << 24), (64, 3, 700)])
def test_hard_negatives_equal_brute_force(spark, block, step, rounds):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(4, 12))
    rows = []
    for i in range(240):
        label = int(rng.integers(4))
        rows.append((i, [float(x) for x in (centre[label] * 0.4 + rng.normal(size=12) * 0.5).astype(np.float32)], label))
    rows += [rows[0], rows[0], rows[7], (300, None, 1), (305, [1.0] * 12, None), (310, [None] + [0.5] * 11, 2), (315, [float("nan")] * 12, 2)]
    rows += [(320, [0.5, 0.25], 1), (325, [0.5, 0.5], 1), (326, [0.25, 0.5], 2), (330, [], 1), (331, [], 2), (None, rows[3][1], 3), (335, [0.0] * 12, 0), (340, [1e30] + [0.0] * 11, 0)]
    s = hard_negatives.Settings(block=block, step=step, anchor_bytes=rounds)
    df = spark.createDataFrame([(*r, 5, 6, "a") for r in rows], VECTORS).repartition(4)
    got = hard_negatives.hard_negatives(spark, df, F.col("vec_id") % 5 == 0, s).collect()
    capped = [(i, None if v is None else [x if x is None or not np.isfinite(x) or abs(x) < 1e9 else float(np.sqrt(2**55 // 12) // 1) / 256 for x in v], label) for i, v, label in rows]
    known = [tuple(r) for r in got if r["anchor_id"] != 340 and 340 not in (r["positive_id"], r["negative_id"])]
    want = [r for r in _negatives(capped, s) if 340 not in (r[0], r[1], r[3])]
    assert len(want) > 100 and sorted(map(str, known)) == sorted(map(str, want))


def test_hard_negatives_without_rows_or_anchors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(spark, empty, F.col("vec_id") % 5 == 0).count() == 0
    some = spark.createDataFrame([(1, [1.0, 0.0], 1, 0, 0, ""), (2, [1.0, 0.0], 2, 0, 0, "")], VECTORS)
    assert hard_negatives.hard_negatives(spark, some, F.col("vec_id") > 9).count() == 0


def test_scan_prunes_and_keeps_exact_scores():
    rng = np.random.default_rng(1)
    vec = rng.integers(-200, 200, size=(500, 16)).astype(np.int64)
    block = hard_negatives.Block(np.arange(500), np.arange(500), np.zeros(500, np.int64), vec)
    anchor = vec[3]
    seen = []

    def keep(low, high):
        seen.append(len(low))
        return high >= np.sort(low)[-3]

    rows, score = hard_negatives._scan(block, anchor, [(0, 500)], keep, 2)
    exact = vec @ anchor
    assert set(np.argsort(-exact, kind="stable")[:3].tolist()) <= set(rows.tolist())
    assert (score == exact[rows]).all() and seen[-1] < seen[0]


DOCS = "doc_id long, text string, source string, key long, rank long, size string"


def _mix_rows(seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(300):
        source = rng.choice(["b", "a", "z", None, "é", "tiny", "b", "b"])
        if source == "tiny" and rng.random() < 0.8:
            continue
        rows.append((i, " \n".join(f"w{i}x{j}" for j in range(rng.randrange(0, 90))), source))
    return rows + [(900, None, "a"), (901, "", "b"), (902, " \t", None), (None, "no id here", "a"), (5, rows[5][1], "a"), (5, rows[5][1], "a"), (903, "v " * 30000, "z"), (904, None, "none")]


def _targets(sizes, weights, repeats):
    """Shares by weight; what exceeds a source's most is shared anew among the others."""
    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_names = float(sum(sizes.values())), set(names)
    while open_names and left > 1e-9:
        level = left / sum(weight[n] for n in open_names)
        over = {n for n in open_names if target[n] + level * weight[n] > repeats * sizes[n]}
        if not over:
            for n in open_names:
                target[n] += level * weight[n]
            break
        for n in over:
            left -= repeats * sizes[n]
            target[n] = float(repeats * sizes[n])
        open_names -= over
    return target


def test_mixing_meets_targets(spark):
    rows = _mix_rows()
    df = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], DOCS).repartition(5)
    mixed = mixing.mix(spark, df, mixing.Settings(block=8, shard=64))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(re.findall(mixing.WORD, text or ""))
    want = _targets(dict(sizes), (1, 2, 3), 3)
    sources = {r["source"]: r for r in mixed.sources.collect()}
    assert {n: r["size"] for n, r in sources.items()} == dict(sizes)
    for n, t in want.items():
        assert sources[n]["target"] == pytest.approx(t)
    taken = {r["key"]: r["taken"] for r in mixing.taken(mixed).collect()}
    by_rank = {r["rank"]: n for n, r in sources.items()}
    total = Counter()
    for r in mixed.rows.collect():
        assert taken.get(r["key"], 0) <= 3 * r["size"]
        total[by_rank[r["rank"]]] += taken.get(r["key"], 0)
    for n, t in want.items():
        assert abs(total[n] - t) <= 16
    # brute force: the words of the blocks that the slots name
    slots = mixed.slots.collect()
    places = sorted((r["shard"], r["slot"]) for r in slots)
    assert places == [divmod(i, 64) for i in range(len(slots))]
    per_pass = Counter((r["rank"], r["pass"], r["block"]) for r in slots)
    assert max(per_pass.values()) == 1 and max(r["pass"] for r in slots) <= 2
    uses = Counter((r["rank"], r["block"]) for r in slots)
    again = Counter()
    filled = defaultdict(list)
    for p in mixed.pieces.collect():
        again[p["key"]] += p["length"] * uses[p["rank"], p["block"]]
        filled[p["rank"], p["block"]].append((p["begin"], p["length"]))
    assert {k: v for k, v in again.items() if v} == {k: v for k, v in taken.items() if v}
    for (rank, block), spans in filled.items():  # gapless, whole but for a stream's last block
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(spans)) and spans[0][0] == 0
        assert sum(n for _, n in spans) == min(8, sources[by_rank[rank]]["size"] - 8 * block)
    counts = {(r["shard"], r["rank"]): r["n"] for r in mixing.shard_counts(mixed).collect()}
    assert counts == Counter((r["shard"], r["rank"]) for r in slots)


def test_mixing_is_the_same_again_and_writes_whole_blocks(spark):
    rows = _mix_rows()[:120]
    first = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], DOCS).repartition(2)
    second = spark.createDataFrame([(*r, 1, 2, "s") for r in rows[::-1]], DOCS).repartition(7)
    s = mixing.Settings(block=8, shard=32)
    a, b = (sorted(map(str, mixing.mixed_blocks(spark, d, s).collect())) for d in (first, second))
    assert a == b
    mixed = mixing.mix(spark, first, s)
    words = sum(r["n"] for r in mixed.pieces.groupBy("rank", "block").agg(F.sum("length").alias("n")).join(mixed.slots, ["rank", "block"]).collect())
    got = mixing.mixed_blocks(spark, first, s).collect()
    assert sum(len(r["text"].split()) for r in got) == words and len(got) == mixed.slots.count()
    streams = defaultdict(str)
    for r in sorted({(r["source"] or "", r["block"], r["text"]) for r in got}):
        streams[r[0]] += f" {r[2]}"
    full = [r["source"] for r in mixed.sources.collect() if r["draws"] >= r["n_blocks"] > 0]
    assert full  # every block of these is there: documents run on over blocks, none is torn
    for name in full:
        for i, text, source in rows:
            words = re.findall(mixing.WORD, text or "") if source == name else []
            assert not words or f" {' '.join(words)} " in f"{streams[name or '']} ", i


def test_mixing_of_tables_without_words(spark):
    none = mixing.mix(spark, spark.createDataFrame([], DOCS))
    assert none.sources.count() == none.slots.count() == none.pieces.count() == none.rows.count() == mixing.taken(none).count() == 0
    blank = mixing.mix(spark, spark.createDataFrame([(1, None, "a", 1, 2, ""), (2, " ", None, 1, 2, "")], DOCS))
    assert [r["target"] for r in blank.sources.collect()] == [0.0, 0.0] and blank.slots.count() == 0 and blank.rows.count() == 2


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_index_permutations_are_permutations(spark, n):
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(4), F.lit("s")).alias("p")).collect()
    assert sorted(r["p"] for r in got) == list(range(n))
