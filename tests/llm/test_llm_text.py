"""Helpers on whole columns against plain Python: words, shingles, tokens, DAC, PPM, E8, chat."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from obsflow.llm import chat, dac, lattice, near_dedup, ppm
from obsflow.llm.minhash import least_matches, signature
from obsflow.llm.packing import cut_lengths
from obsflow.llm.textops import ALNUM, LOWER, NOT_BLANK, shingles, span_hash, text_slices, words
from obsflow.llm.tokens import UnitTokenizer

TEXTS = [
    "Don't, I'd.x 3.5.. é,b <|endoftext|>A <|ENDOFTEXT|> o'clock,'s ...\"x\" ×, İstanbul. ΣΑΣ, क़.a —,x…. 中文,字 Å,b",
    None, "", "  ", ".", "'S.S'", "a.'ll b,'LL", "x,́y a.́b", "1.2,3 a1.b2", " .a\x85b,\x1cc", "hello|World.Foo <|startoftext|>", "word " * 3000,
]


@pytest.mark.parametrize(("table", "pattern"), [(NOT_BLANK, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_and_hashes(table, pattern):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    seen = {}
    for limit in (1, 40, 1 << 20):
        got = []
        for first, last, data, off in text_slices(pa.array(TEXTS), limit):
            low = LOWER[data]
            start, end, cut = words(low, off, table)
            h = span_hash(low, start, end)
            for i in range(last - first):
                got.append([low[a:b].tobytes().decode() for a, b in zip(start[cut[i] : cut[i + 1]], end[cut[i] : cut[i + 1]], strict=True)])
            for a, b, x in zip(start, end, h, strict=True):
                assert seen.setdefault(low[a:b].tobytes(), x) == x
        assert got == [re.findall(pattern, (t or "").translate(lower)) for t in TEXTS]
    assert len(set(seen.values())) == len(seen)


def test_shingles_of_short_texts():
    h = np.arange(1, 8, dtype=np.uint64)
    values, off = shingles(h, np.array([0, 0, 2, 7]), 3)
    assert off.tolist() == [0, 0, 1, 4] and len(set(values.tolist())) == 4


def test_tokens_equal_the_library():
    tokenizer = UnitTokenizer.of(public_tokenizers.path("word_bpe_49k.json"))
    got = [ids[off[i] : off[i + 1]].tolist() for _, _, ids, off in tokenizer.encode(pa.array(TEXTS), 7) for i in range(len(off) - 1)]
    assert got == [tokenizer.model.encode(t or "", add_special_tokens=False).ids + [7] for t in TEXTS]


def test_tokens_of_marks_after_capitals_equal_the_library():
    """The library composes before it lower-cases: T with U+0308 stays two characters, t becomes one."""
    tokenizer = UnitTokenizer.of(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["T\u0308 t\u0308", "H\u0331 J\u030c", "aW\u030a.Y\u030a", "É\u0323 Éé×Ö ÀÞ"]
    got = [ids[off[i] : off[i + 1]].tolist() for _, _, ids, off in tokenizer.encode(pa.array(texts), 7) for i in range(len(off) - 1)]
    assert got == [tokenizer.model.encode(t, add_special_tokens=False).ids + [7] for t in texts]


def test_tokens_of_random_texts_equal_the_library():
    tokenizer = UnitTokenizer.of(public_tokenizers.path("word_bpe_49k.json"))
    rng = np.random.default_rng(3)
    parts = [*"aTs0 .,'$=-<>|_\"\n", "'s", "'LL", "<|endoftext|>", *"éÉß×÷İΣµÅ中\u0308\u0331\u0338\u00a0\u0085\u1c4e\u212a…", "word", "Über"]
    texts = ["".join(rng.choice(parts, n)) for n in rng.integers(0, 12, 4000)]
    got = [ids[off[i] : off[i + 1]].tolist() for _, _, ids, off in tokenizer.encode(pa.array(texts), 7) for i in range(len(off) - 1)]
    wrong = [t for t, ids in zip(texts, got, strict=True) if ids != tokenizer.model.encode(t, add_special_tokens=False).ids + [7]]
    assert wrong == []


def test_words_beside_signs_and_capitals_are_encoded_once_and_many_to_a_text(monkeypatch):
    """A word in quotes, brackets, with a sign or a Latin capital is no new unit, and none goes to the library alone."""
    tokenizer = UnitTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    alone, words = [], [a + b for a in ("löwe", "hund", "katze") for b in ("n", "chen", "haus", "és")]
    model = tokenizer.model

    class Counted:
        def encode_batch_fast(self, texts, **options):
            alone.extend(texts)
            return model.encode_batch_fast(texts, **options)

    monkeypatch.setattr(tokenizer, "model", Counted())
    forms = ['"%s"', "(%s)", "%s$$", "%s!", "[%s]-", "%s:", "#%s;"]
    texts = [f % (w if k % 2 else w.upper()) for k, f in enumerate(forms) for w in words]
    got = [ids[off[i] : off[i + 1]].tolist() for _, _, ids, off in tokenizer.encode(pa.array(texts), 7) for i in range(len(off) - 1)]
    assert got == [model.encode(t, add_special_tokens=False).ids + [7] for t in texts]
    assert len(alone) <= 11 and not any(c.isalpha() for c in "".join(alone))


def test_dac_round_trip_and_access():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 5000):
        ids = rng.integers(0, 1 << 20, n).astype(np.uint32)
        ids[::3] %= 200
        seg = dac.Segment(dac.encode_segment(np.arange(2), np.zeros(2), np.array([0, n // 3, n]), ids))
        assert (seg.decode() == ids).all() and (seg.access(np.arange(n)) == ids).all()
    with pytest.raises(ValueError, match="DAC1"):
        dac.Segment(b"nope" + bytes(24))


def test_cut_lengths_are_powers_of_two():
    n = np.arange(0, 5000)
    length, pieces = cut_lengths(n, 2048)
    assert (np.add.reduceat(np.r_[length, 0], np.r_[0, np.cumsum(pieces)[:-1]])[pieces > 0] == n[pieces > 0]).all()
    assert ((length & (length - 1)) == 0).all() and length.max() == 2048


def test_bayesian_floor_is_the_posterior_bound():
    floor = least_matches(64, 32, 0.85, 1e-6)
    for n, m in zip((32, 64), floor, strict=True):
        tail = lambda k: sum(math.comb(n + 1, i) * 0.85**i * 0.15 ** (n + 1 - i) for i in range(k + 1))  # noqa: B023, E731
        assert tail(m) >= 1e-6 > tail(m - 1)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 1200).astype(np.uint64)
    same = (signature(x[:1100], 256, 3) == signature(x[100:], 256, 3)).mean()
    assert abs(same - 1000 / 1200) < 0.1


def test_common_sizes():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, n)).astype(np.uint64) for n in (1, 10, 30, 50, 50)]
    left, right = (x.ravel() for x in np.meshgrid(range(5), range(5)))
    assert near_dedup._common(sets, left, right).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(left, right, strict=True)]


def _trie(texts, order, share):
    codes = np.concatenate([ppm.gram_codes(d, o, order)[0] for _, _, d, o in text_slices(pa.array(texts))])
    grams, counts, contexts, totals = [], [], [], []
    for length in range(1, order + 2):
        code = codes & np.uint64((1 << 8 * length) - 1)
        gram, n = np.unique(code, return_counts=True)
        grams.append(gram[n >= max(1, share * len(codes))])
        counts.append(n[n >= max(1, share * len(codes))])
        above, total = np.unique(code >> np.uint64(8), return_counts=True)
        contexts.append(above)
        totals.append(total)
    return ppm.Trie(order, tuple(grams), tuple(counts), tuple(contexts), tuple(totals))


def _brute_ppm(train, text, order, share):
    seen, whole = defaultdict(Counter), Counter()
    for t in train:
        b = [255] * order + list(t.encode()) + [255]
        for i in range(order, len(b)):
            for k in range(order + 1):
                seen[tuple(b[i - k : i])][b[i]] += 1
    total = sum(seen[()].values())
    for c in list(seen):
        whole[c] = sum(seen[c].values())
        seen[c] = {s: n for s, n in seen[c].items() if n >= max(1, share * total)}
    b, out = [255] * order + list(text.encode()) + [255], 0.0
    for i in range(order, len(b)):
        gone: set = set()
        for k in range(order, -1, -1):
            known = seen.get(tuple(b[i - k : i]))
            if not known:
                continue
            rest = {s: n for s, n in known.items() if s not in gone}
            n = sum(rest.values())
            escape = len(rest) + whole[tuple(b[i - k : i])] - sum(known.values())
            if b[i] in rest:
                out += math.log10(rest[b[i]] / (n + escape))
                break
            if escape:
                out += math.log10(escape / (n + escape))
            gone |= set(known)
        else:
            out -= math.log10(256 - len(gone))
    return out


@pytest.mark.parametrize("share", [0, 0.05])
def test_ppm_equals_a_plain_walk(share):
    train = ["abracadabra", "abc", "", "hello world hello", "abracadabra abra"]
    asked = [*train, "zebra", "abra hello", "é"]
    scorer = ppm.Scorer(_trie(train, 3, share))
    got = np.concatenate(list(ppm.text_scores(pa.array(asked), scorer)))
    assert np.allclose(got, [_brute_ppm(train, t, 3, share) for t in asked], atol=1e-9)


def test_e8_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(3)
    roots = lattice.e8_roots()
    assert len(roots) == 240 and np.allclose((roots**2).sum(1), 2)
    x = rng.normal(size=(300, 8)) * 2
    point = lattice.nearest_e8(x)
    near = ((x - point) ** 2).sum(1)
    assert (near <= (((x[:, None, :] - (point[:, None, :] + roots)) ** 2).sum(2)).min(1) + 1e-9).all() and near.max() <= 1 + 1e-9


def test_chat_assembly_round_trip():
    turns = pa.table({
        "conv_id": pa.array([1, 1, 1, 2, 3], pa.int64()),
        "role": ["system", "user", "assistant", "to\\ol<|text|>", None],
        "text": ["</s>[INST] ok [/INST]", "é<|role|>\\", "", None, "<<SYS>>[["],
    })
    rows = chat._assemble(turns).to_pylist()
    assert chat.parse(rows[0]["formatted"]) == [("system", "</s>[INST] ok [/INST]"), ("user", "é<|role|>\\"), ("assistant", "")]
    assert chat.parse(rows[1]["formatted"]) == [("to\\ol<|text|>", "")]
    assert chat.parse(rows[2]["formatted"]) == [("", "<<SYS>>[[")]
    assert [len(r["loss_start"]) for r in rows] == [1, 0, 0]
    with pytest.raises(ValueError, match="stray"):
        chat.parse("x[INST]a[/INST]")
