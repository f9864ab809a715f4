"""The operators in Spark on small tables: nulls, empty and long texts, ties, repeats, extra
columns, empty tables, and brute-force results."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from obsflow.llm import chat, components, dac, decontam, language, lattice, license_scan, lm_scoring, near_dedup, packing, toxicity

SCHEMA = "doc_id long, text string, lang string, score double, node long, key string"
PATH = public_tokenizers.path("word_bpe_49k.json")


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 0.5, 7, "k") for i, t in rows], SCHEMA).repartition(3)


def _mutants(seed=5):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = []
    for i in range(70):
        words = list(base)
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        rows.append((i + 10, " ".join(words)))
    rows += [(200, rows[3][1]), (5, rows[3][1].upper()), (300, None), (301, ""), (302, " \n"), (303, "one two"), (304, "ONE  two"), (None, rows[0][1]), (305, "z " * 30000), (10, rows[0][1])]
    return rows


def _sets(rows, k):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        out.append((i, {tuple(w[j : j + k]) for j in range(max(len(w) - k + 1, min(len(w), 1)))}))
    return out


def _components(rows, k, percent):
    sets = [(i, s) for i, s in _sets(rows, k) if i is not None]
    label = {i: i for i, _ in sets}
    links = [(a, b) for a, s in sets for b, t in sets if a < b and s and t and 100 * len(s & t) >= percent * len(s | t)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("small", [16, 2])
def test_near_dedup_equals_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows = _mutants()
    got = near_dedup.near_duplicate_groups(spark, _docs(spark, rows)).collect()
    want, size = _components(rows, 3, 85), _sets(rows, 3)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"]) for r in got) == sorted((i is None, i or 0, len(s)) for i, s in size)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"]) and r["kept"] == (r["doc_id"] is None or want[r["doc_id"]] == r["doc_id"])


def test_near_dedup_of_ids_that_repeat_under_different_texts(spark):
    a = [f"a{i}" for i in range(60)]
    b = [f"b{i}" for i in range(60)]
    near = lambda w: " ".join([*w[:-1], "else"])
    rows = [(4, " ".join(a)), (4, " ".join(b)), (9, near(a)), (2, near(b)), (4, " ".join(a)), (7, "alone here now"), (7, " ".join(b)), (None, " ".join(b))]
    got = near_dedup.near_duplicate_groups(spark, _docs(spark, rows)).collect()
    by = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_shingles"], r["component_id"] or -1) for r in got)
    assert by == [(False, 2, 58, 2), (False, 4, 58, 2), (False, 4, 58, 4), (False, 4, 58, 4), (False, 7, 1, 7), (False, 7, 58, 2), (False, 9, 58, 4), (True, 0, 58, -1)]


def test_near_dedup_with_blocks_that_hold_no_node(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 100)
    rows = _mutants()[:20]
    got = near_dedup.near_duplicate_groups(spark, _docs(spark, rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == _components(rows, 3, 85)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (101, 100), (None, 3)]
    got = components.connected_components(spark, spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}}


def test_empty_tables(spark):
    docs, none = _docs(spark, [(1, "a")]).where("false"), spark.createDataFrame([], "item_id long, text string")
    assert near_dedup.near_duplicate_groups(spark, docs).count() == 0
    assert toxicity.score(spark, docs, toxicity.fit(spark, docs, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0
    assert language.predict(spark, docs, language.fit(spark, docs)).count() == 0
    assert license_scan.scan(spark, docs, license_scan.template_table(spark)).count() == 0
    assert license_scan.scan(spark, _docs(spark, [(1, "a")]), license_scan.template_table(spark, {"x": "a"}).where("false")).count() == 0
    assert packing.pack(spark, docs, PATH).count() == 0
    assert lm_scoring.score_texts(spark, docs, docs).count() == 0
    assert decontam.contamination(spark, docs, none).count() == 0
    assert not decontam.contamination(spark, _docs(spark, [(1, "a b")]), none).first()["contaminated"]
    assert chat.format_conversations(spark, spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert lattice.near_duplicate_vectors(spark, spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_toxicity_learns_an_interaction(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(50)}" for _ in range(15)] + ["insult"] * insult + ["groupe"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult and group)))
    docs = _docs(spark, [*rows, (5000, None), (5001, ""), (None, "insult groupe")])
    model = toxicity.fit(spark, docs, spark.createDataFrame([*labels[:700], (None, 1), (3, None)], "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(spark, docs, model).collect()}
    assert sum(got[i]["predicted"] == y for i, y in labels[700:]) >= 195
    assert got[5000]["score"] == got[5001]["score"] and got[None]["predicted"] == 1
    assert toxicity.clean(spark, docs, model).columns == docs.columns


def test_toxicity_learns_what_no_single_word_tells(spark):
    """Toxic with exactly one of two words: each word alone is as often toxic as not."""
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(1200):
        one, other = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(40)}" for _ in range(8)] + ["first"] * one + ["second"] * other
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(one != other)))
    docs = _docs(spark, [*rows, *[rows[0]] * 50, (rows[1][0], "another text of the id")])
    model = toxicity.fit(spark, docs, spark.createDataFrame(labels[:1000], "doc_id long, toxic int"))
    got = {(r["doc_id"], r["text"]): r["predicted"] for r in docs.join(toxicity.score(spark, docs, model).distinct(), "doc_id").collect()}
    assert sum(got[i, t] == y for (i, t), (_, y) in zip(rows[1000:], labels[1000:], strict=True)) >= 190
    kept = toxicity.clean(spark, docs.withColumn("_row_key", F.lit(1)), model)
    wrong = {i for (i, t) in rows if got[i, t] == 0} ^ {r["doc_id"] for r in kept.collect() if r["doc_id"] != rows[1][0]}
    assert wrong <= {rows[1][0]} and "_row_key" in kept.columns
    assert toxicity.clean(spark, docs.limit(0), model).count() == 0


def test_toxicity_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(5)
    machine = toxicity.Machine(8, np.arange(30), 0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    rows = [rng.choice(30, size=n, replace=False) for n in (0, 1, 2, 7, 30)]
    got = machine.raw(np.concatenate(rows).astype(int), np.cumsum([0, *map(len, rows)]))
    for r, score in zip(rows, got, strict=True):
        pairs = sum(float(machine.v[a] @ machine.v[b]) for k, a in enumerate(r) for b in r[:k])
        assert score == pytest.approx(0.3 + sum(machine.w[i] for i in r) + pairs)


def test_toxicity_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(6, size=n, replace=False)) for n in (2, 3, 1, 5, 0)]
    flat, off = np.concatenate(rows).astype(int), np.cumsum([0, *map(len, rows)])
    y, weight, scale = np.array([0.0, 1, 1, 0, 1]), np.array([1.0, 2, 1, 1, 3]), rng.uniform(0.5, 1, 6)
    held, w0, l2 = rng.normal(size=(6, 3)), 0.2, 0.01

    def loss(h, c):
        raw = toxicity.Machine(8, np.arange(6), c, h[:, 0], h[:, 1:]).raw(flat, off)
        return (weight * (np.log1p(np.exp(raw)) - y * raw)).sum() / weight.sum() + l2 / 2 * ((h / scale[:, None]) ** 2).sum()

    batch = toxicity._Batch(flat, off, y, weight)
    g0, g = batch.gradient(toxicity.Machine(8, np.arange(6), w0, held[:, 0], held[:, 1:]), scale, l2)
    assert g0 == pytest.approx((loss(held, w0 + 1e-6) - loss(held, w0 - 1e-6)) / 2e-6, abs=1e-6)
    for i, j in itertools.product(range(len(batch.terms)), range(3)):
        up, down = held.copy(), held.copy()
        up[batch.terms[i], j] += 1e-6
        down[batch.terms[i], j] -= 1e-6
        # parameters are held over their scale, so a step of one moves the parameter by the scale
        assert g[i, j] == pytest.approx((loss(up, w0) - loss(down, w0)) / 2e-6 * scale[batch.terms[i]], abs=1e-6)


def test_language(spark):
    said = {"aa": "lorem ipsum dolor sit amet ", "bb": "zwölf boxkämpfer jagen viktor quer ", "cc": "съешь же ещё этих мягких булок "}
    rows = [(i, t * (1 + i % 3), k) for i, (k, t) in enumerate(list(said.items()) * 20)]
    docs = spark.createDataFrame([*rows, (900, None, "aa"), (901, "", None), (902, "12 !?", "bb"), (None, said["cc"], None)], "doc_id long, text string, lang string")
    model = language.fit(spark, docs)
    got = {r["doc_id"]: r for r in language.predict(spark, docs, model).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k in rows) and got[None]["lang_pred"] == "cc"
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    cutoffs = language.calibrate(spark, docs, model)
    assert language.known(spark, docs, model, cutoffs).count() == len(rows) + 1
    assert language.known(spark, docs.limit(0), model, language.calibrate(spark, docs.limit(0), model)).count() == 0
    nothing = language.fit(spark, docs.limit(0))
    assert language.known(spark, docs, nothing, language.calibrate(spark, docs, nothing)).count() == 0


def test_language_kernel_equals_its_definition():
    """The kernel counts the n-grams that two texts share, here by sets."""
    texts = ["abc abd", "bcd aab", "xyz xyy", "yzz zzx", "abd bca xyz"]

    def grams(t):
        b = bytes(c if 97 <= c < 123 or c > 127 else 32 for c in t.lower().encode())
        return {b[i : i + n] for n in (1, 2, 3, 4) for i in range(len(b) - n + 1)}

    held = np.concatenate(list(language.presence(pa.array(texts), 4, 1 << 20)))
    got = held.astype(int) @ held.T.astype(int)
    assert got.tolist() == [[len(grams(a) & grams(b)) for b in texts] for a in texts]


def test_language_stage_rejects_what_it_has_not_learned(spark):
    sf = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text is not null")
    learn = sf.where("doc_id % 5 <> 0")
    model = language.fit(spark, learn)
    cutoffs = language.calibrate(spark, learn, model)
    russian = "не было в этом городе человека который бы знал как все произошло и почему она ушла тогда из дома без слов "
    finnish = "ei ole olemassa mitään syytä miksi hän lähti kotoa silloin kun kaikki muut olivat vielä nukkumassa yöllä talossa "
    foreign = [(1, russian), (2, russian * 30), (3, russian * 20000), (4, finnish * 20), (5, finnish * 9000), (6, "x q z z z " * 20)]
    mixed = " ".join(r["text"] for r in sf.where("lang = 'de'").limit(3).collect() + sf.where("lang = 'fr'").limit(3).collect())
    kept = [(10, mixed), (11, mixed + russian), (12, "Avec."), (13, "Re."), (14, "The end of the")]
    docs = spark.createDataFrame([*foreign, *kept, (20, None), (21, "12 !?"), (11, mixed)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in language.known(spark, docs, model, cutoffs).collect()) == [10, 11, 11, 12, 13, 14]
    held = sf.where("doc_id % 5 = 0").where(F.col("text").rlike(language.LETTER))
    n = held.count()
    assert n > 1500 and language.known(spark, held, model, cutoffs).count() >= 0.999 * n


def test_language_of_short_and_megabyte_texts(spark):
    sf = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("text is not null and lang is not null")
    model = language.fit(spark, sf)
    rows = [(i, t, None) for i, t in enumerate(["A.\nAll rights reserved.", "Avec.", "Re.", "x"])]
    for lang in ("de", "en", "es", "fr"):
        joined = " ".join(r["text"] for r in sf.where(F.col("lang") == lang).orderBy("doc_id").select("text").limit(3000).collect())
        rows += [(10 + len(rows), (joined * 4)[:size], lang) for size in (800_000, 1_600_000)]
    docs = spark.createDataFrame([*rows, (900, None, None), (901, "12 !?", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(spark, docs, model).collect()}
    assert all(got[i] == lang for i, _, lang in rows if lang)
    cutoffs = language.calibrate(spark, sf, model)
    assert {r["doc_id"] for r in language.known(spark, docs, model, cutoffs).collect()} == {i for i, _, _ in rows}


def test_license_scan(spark):
    text = license_scan.TEMPLATES["mit-grant"]
    rows = [(1, "Foo. Released under the MIT License. bar"), (2, "x " * 500 + text + " y" * 500), (3, text[: len(text) // 3]), (4, None), (5, ""), (5, "RELEASED under the MIT license"), (None, text)]
    got = license_scan.scan(spark, _docs(spark, rows), license_scan.template_table(spark)).collect()
    assert {(r["doc_id"], r["license_id"], r["containment"]) for r in got} == {(1, "mit", 1.0), (2, "mit-grant", 1.0), (5, "mit", 1.0), (None, "mit-grant", 1.0)}


def test_packing(spark):
    rows = [(1, "hello world " * 700), (2, None), (3, ""), (4, "abc"), (4, "abc"), (None, "x, y.")]
    got = packing.pack(spark, _docs(spark, rows), PATH, capacity=256).collect()
    spans, total = {}, Counter()
    for r in got:
        assert len(r["ids"]) == 4 * r["length"]
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        total[r["doc_id"]] += r["length"]
    for parts in spans.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        size = sum(n for _, n in parts)
        assert size <= 256 and size & (size - 1) == 0
    assert total[2] == total[3] == 1 and total[1] == 1401
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(spark, _docs(spark, rows), PATH, capacity=100)


def test_dac_store(spark, tmp_root):
    rows = [(9, "hello world"), (3, None), (4, "a, b."), (4, "A"), (None, "z"), (7, "word " * 3000)]
    dac.write_store(spark, _docs(spark, rows), tmp_root, PATH)
    got = sorted(dac.read_store(spark, tmp_root).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 3, 4, 4, 7, 9]
    flat = b"".join(bytes(r["ids"]) for r in got)
    ids = [int.from_bytes(flat[i : i + 4], "little") for i in range(0, len(flat), 4)]
    assert [r["start"] for r in got] == [sum(x["n_tokens"] for x in got[:i]) for i in range(len(got))]
    asked = spark.createDataFrame([(0,), (5,), (len(ids) - 1,), (len(ids),), (-1,), (5,), (None,)], "position long")
    assert {(r["position"], r["token_id"]) for r in dac.random_access(spark, tmp_root, asked).collect()} == {(0, ids[0]), (5, ids[5]), (len(ids) - 1, ids[-1])}


def test_lattice_equals_brute_force(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(lattice, "BLOCK", 8)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 32))
    x = np.concatenate([base[i] + rng.normal(size=(20, 32)) * 0.12 for i in range(6)])
    rows = [(i, [float(v) for v in np.float32(r)]) for i, r in enumerate(x)]
    rows += [(500, rows[3][1]), (501, None), (502, [0.0] * 32), (503, [float("nan")] * 32), (504, [1.0, None]), (505, []), (None, rows[0][1]), (506, [1.0, 2.0]), (507, [2.0, 4.0])]
    got = {r["vec_id"]: r for r in lattice.near_duplicate_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    real = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: {j for j, w in real.items() if j != i and len(v) == len(w) and v @ w >= 0.9} for i, v in real.items()}
    found = sum(got[i]["n_links"] for i in real)
    assert found >= 0.97 * sum(map(len, links.values())) and all(got[i]["n_links"] <= len(links[i]) for i in real)
    assert got[500]["component_id"] == got[3]["component_id"] and got[507]["component_id"] == 506
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (501, 502, 503, 504, 505, None))


def test_lattice_ids_may_repeat_under_different_vectors(spark):
    rng = [[1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]]
    rows = [(4, rng[0]), (4, rng[1]), (9, [1.0, 0.01, 0.0, 0.0]), (2, [0.0, 0.0, 1.0, 0.01]), (9, [1.0, 0.0, 0.0, 0.0]), (7, [0.0, 0.0, 0.0, -1.0])]
    got = lattice.near_duplicate_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    # 4 and 9 share one direction (three rows), 4 and 2 the other (two rows)
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got.collect()) == [
        (2, 1, 2, True), (4, 1, 2, False), (4, 2, 4, True), (7, 0, 7, True), (9, 2, 4, False), (9, 2, 4, False)
    ]


def test_lattice_sign_bound_keeps_near_pairs():
    import numpy as np

    s = lattice.Settings()
    most = lattice.most_signs(s)
    p = np.arccos(s.cosine) / np.pi
    drawn = np.random.default_rng(2).binomial(lattice.SIGNS, p, 200_000)
    assert p * lattice.SIGNS < most < lattice.SIGNS / 2 - 3 * np.sqrt(lattice.SIGNS / 4) and (drawn > most).sum() <= 2
    unit = np.random.default_rng(3).normal(size=(2000, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    words = lattice.sketches(unit, s)
    signs = lattice.differing(words[:-1, 0], words[1:, 0]) + lattice.differing(words[:-1, 1], words[1:, 1])
    assert signs[0] == sum(bin(int(a) & (1 << 64) - 1).count("1") for a in words[0] ^ words[1])
    angle = np.arccos((unit[:-1] * unit[1:]).sum(axis=1)) / np.pi
    assert abs((signs / lattice.SIGNS - angle).mean()) < 0.01


def test_lattice_recall_near_the_threshold(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(2, 1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    c = rng.uniform(0.901, 0.92, (1500, 1))
    x = np.concatenate([a, c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b, axis=1, keepdims=True)])
    links = np.triu(x @ x.T >= 0.9, 1).sum()
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = lattice.near_duplicate_vectors(spark, rows).agg(F.sum("n_links")).first()[0] / 2
    assert links == 1500 and 0.98 * links <= found <= links


def test_lm_scoring_base(spark):
    rows = [(i, t) for i, t in enumerate(["a b a", "B c", None, "", "a z", "q " * 40]) ] + [(None, "a"), (2, "b b")]
    train = rows[:4]
    got = lm_scoring.score_texts(spark, _docs(spark, rows), _docs(spark, train), lm_scoring.Settings(share=0.4)).collect()
    count = Counter(w for _, t in train for w in (t or "").lower().split())
    total, distinct = sum(count.values()) + len(train), len(count) + 1
    want = []
    for i, t in rows:
        w = (t or "").lower().split()
        base = sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in w) + math.log10((len(train) + 1) / (total + distinct + 1))
        want.append((i is None, i or 0, len(w) + 1, sum(count[x] > 0 for x in w) + 1, round(base, 9)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["n_known"], round(r["base_score"], 9)) for r in got) == sorted(want)
    assert all(r["train_tokens"] == total and r["score"] < 0 for r in got)


@pytest.mark.parametrize(("order", "share"), [(5, 0.02), (2, 0.05), (5, 1e-9)])
def test_lm_scoring_keeps_every_string(spark, order, share):
    from obsflow.llm import ppm
    from tests.llm.test_llm_text import _brute_ppm

    rng = random.Random(6)
    train = ["".join(rng.choice("aab cé") for _ in range(60)) for _ in range(12)] + [None, "once upon"]
    asked = [*train[:3], "once upon", "zzz abc", "", None, "é aab" * 9]
    settings = lm_scoring.Settings(ppm=ppm.Settings(order, share))
    got = lm_scoring.score_texts(spark, _docs(spark, list(enumerate(asked))), _docs(spark, list(enumerate(train))), settings).collect()
    want = {i: _brute_ppm([x or "" for x in train], t or "", order, 0) for i, t in enumerate(asked)}
    assert len(got) == len(want) and all(abs(r["score"] - want[r["doc_id"]]) < 1e-9 for r in got)


def test_decontamination(spark, monkeypatch):
    item = "alpha beta gamma delta eps zeta eta theta iota kappa lambda mu"
    bench = spark.createDataFrame([(10, item), (9, "Short item"), (8, None), (None, item), (10, item), (7, "alpha " * 10)], "item_id long, text string")
    rows = [(1, "x " + item.upper() + " y"), (2, item.replace("kappa", "k")), (3, "a SHORT, item! b short item"), (4, None), (5, "alpha " * 13), (1, "none"), (None, item)]
    for block in (decontam.BLOCK, 1):
        monkeypatch.setattr(decontam, "BLOCK", block)
        got = decontam.contamination(spark, _docs(spark, rows), bench).collect()
        assert {(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in got} == {
            (1, 14, 12, ("10",)), (2, 12, 0, ()), (3, 6, 4, ("9",)), (4, 0, 0, ()), (5, 13, 13, ("7",)), (1, 1, 0, ()), (None, 12, 12, ("10",)),
        }
    windows = decontam.item_windows(spark.createDataFrame([(1, "red green blue")], "item_id long, text string"))
    index = decontam.build_index(spark, _docs(spark, [(1, "red green blue"), (2, "green x red blue"), (3, "red green")]), windows)
    found = decontam.search(spark, index, windows, slop=3).join(index.select("row", "doc_id"), "row")
    assert {(r["doc_id"], r["kind"]) for r in found.collect()} == {(1, "phrase"), (2, "proximity")}


def test_chat_in_spark(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "[a]"), (2, None, None, None), (None, 0, "user", "x"), (1, 1, "assistant", "b")]
    formatted = chat.format_conversations(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in chat.digest(spark, formatted).collect()}
    assert set(got) == {1, 2} and got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 2 and got[2]["n_turns"] == 1


def test_held_out_hash(spark):
    from obsflow.llm.queries import remainder

    got = spark.range(50).select("id", remainder(5, "id").alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("extra", F.lit(1))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
    kept = [r["doc_id"] for r in P.drop_near_duplicates(spark, docs, sf).select("doc_id").collect()]
    label = _components([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
    assert sorted(kept) == sorted({*label.values()})
    assert P.run(spark, sf).agg(F.max("length")).first()[0] <= 2048


def test_pipeline_drops_rows_not_ids(spark, tmp_root):
    import corpus_pipeline as P

    item = "alpha beta gamma delta eps zeta eta theta iota kappa lambda mu"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_root}/benchmark.parquet")
    a, b, c = (" ".join(f"{k}{i}" for i in range(30)) for k in "abc")
    docs = _docs(spark, [(3, a), (5, a), (5, b), (7, c), (7, c), (None, c), (None, None), (8, item), (8, "clean words"), (None, item)])
    kept = P.drop_near_duplicates(spark, docs, tmp_root)
    assert kept.columns == docs.columns
    want = [(3, a), (5, b), (7, c), (8, "clean words"), (8, item), (None, None)]
    order = lambda rows: sorted(rows, key=str)
    assert order((r["doc_id"], r["text"]) for r in kept.collect()) == order(want)
    clean = P.drop_contaminated(spark, docs, tmp_root)
    assert clean.columns == docs.columns
    assert order((r["doc_id"], r["text"]) for r in clean.collect()) == order([(3, a), (5, a), (5, b), (7, c), (7, c), (None, c), (None, None), (8, "clean words")])
