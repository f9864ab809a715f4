"""Text scoring by prediction by partial matching over bytes.

**Model.** A byte-context trie of order ``order``: for each length L = 1 ... order + 1 every
byte string of the training texts with its count. It is kept as a written table of the
longest strings, from which the shorter ones follow, and grows with the corpus. Every text
is led by ``order`` end marks (byte 0xFF, which UTF-8 never uses) and closed by one.

**Where it is scored.** A string that was seen in training is found in its longest context,
so its score needs that context's sums only. Strings whose share of all training strings is
at least ``share`` (at most ``1 / share`` of them) are scored where the text is read. All
others, seen or not, are dealt by the last ``NEAR`` bytes of their context together with the
table's strings: contexts of at least ``NEAR`` bytes are then complete in one group, and the
shorter strings, at most 256 ** ``NEAR``, are broadcast.

**Score.** From the longest known context: a symbol seen there costs
count / (total + distinct); otherwise the escape is paid and the context is shortened by
its first byte. The escape is method C's, distinct / (total + distinct), with the counts of
symbols that a trie leaves out (that of a corpus leaves out none) added above the line. Symbols that the longer context
knew are excluded from the shorter one's counts. The tables are closed under shortening,
so the longer context's symbols are always a subset of the shorter one's, and what
exclusion leaves is a function of the longer context alone; it is kept with it. Past the
empty context a symbol costs one over the number of symbols not excluded.

A text's score is the sum over its bytes and end mark of log10 of these probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.arrow import prepare, whole_runs
from obsflow.llm.textops import text_slices
from obsflow.session import materialize

END = 0xFF
SYMBOLS = 256
NEAR = 3
_U = np.uint64


@dataclass(frozen=True)
class Settings:
    """``share`` bounds the broadcast: at most ``1 / share`` strings of the greatest length."""

    order: int = 5
    share: float = 2e-7


def gram_codes(data: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, offsets): for every byte and the end mark of each text, the ``order`` bytes
    before it and itself, as one integer whose lowest byte is the symbol."""
    n = len(off) - 1
    size = np.diff(off) + order + 1
    at = np.concatenate([[0], np.cumsum(size)])
    padded = np.full(at[-1], END, np.uint8)
    body = np.ones(at[-1], bool)
    for k in range(order):
        body[at[:-1] + k] = False
    body[at[1:] - 1] = False
    padded[body] = data
    code = np.zeros(max(len(padded) - order, 0), _U)
    for k in range(order + 1):
        code = (code << _U(8)) | padded[k : len(padded) - order + k]
    symbol = np.zeros(len(padded), bool)
    symbol[order:] = True
    for k in range(order):
        symbol[at[1:-1] + k] = False
    return code[symbol[order:]], off + np.arange(n + 1)


def _count(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, data, off in text_slices(batch.column("text"), 4 << 20):
            codes, n = np.unique(gram_codes(data, off, order)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n.astype(np.int64))], names=["gram", "n"])


@dataclass(frozen=True)
class Trie:
    """``grams[L]`` and ``counts[L]``: the known strings of length L + 1 in code order, the
    lowest byte last; ``contexts[L]`` and ``totals[L]``: contexts of length L in code order,
    each that a known string has among them, and the counts of all their symbols."""

    order: int
    grams: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    totals: tuple[np.ndarray, ...]


class Cached:
    """Values of (context, symbol) codes that ``exact`` gives, with a direct-mapped cache."""

    CACHE_BITS = 20

    def __init__(self) -> None:
        self.keys = np.full(1 << self.CACHE_BITS, (1 << 64) - 1, _U)
        self.values = np.zeros(1 << self.CACHE_BITS)

    def score(self, codes: np.ndarray) -> np.ndarray:
        slot = ((codes * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.CACHE_BITS)).astype(np.int64)
        out = self.values[slot]
        miss = np.flatnonzero(self.keys[slot] != codes)
        if len(miss):
            new, back = np.unique(codes[miss], return_inverse=True)
            got = self.exact(new)
            out[miss] = got[back]
            place = ((new * _U(0x9E3779B97F4A7C15)) >> _U(64 - self.CACHE_BITS)).astype(np.int64)
            # of codes that share a slot the last one written stays; key and value agree
            last = np.unique(place[::-1], return_index=True)
            keep = len(place) - 1 - last[1]
            self.keys[place[keep]], self.values[place[keep]] = new[keep], got[keep]
        return out


class Scorer(Cached):
    """Log10 probabilities of (context, symbol) codes in a trie."""

    def __init__(self, trie: Trie) -> None:
        super().__init__()
        self.trie = trie
        # of each context: the counts and number of its known symbols and the counts of the
        # others; then the same of the next shorter context without this one's symbols
        self.contexts, self.seen, self.distinct, self.other = [], [], [], []
        self.seen_left, self.distinct_left = [], []
        for length in range(trie.order + 1):
            gram, count = trie.grams[length], trie.counts[length].astype(np.float64)
            known, start = np.unique(gram >> _U(8), return_index=True)
            seen = np.add.reduceat(count, start) if len(start) else np.zeros(0)
            distinct = np.diff(np.r_[start, len(gram)]).astype(np.float64)
            total = trie.totals[length][np.searchsorted(trie.contexts[length], known)]
            self.contexts.append(known)
            self.seen.append(seen)
            self.distinct.append(distinct)
            self.other.append(total - seen)
            if length and len(gram):
                shorter = np.searchsorted(trie.grams[length - 1], gram & _U((1 << (8 * length)) - 1))
                taken = np.add.reduceat(trie.counts[length - 1].astype(np.float64)[shorter], start)
                parent = np.searchsorted(self.contexts[length - 1], known & _U((1 << (8 * (length - 1))) - 1))
                self.seen_left.append(self.seen[length - 1][parent] - taken)
                self.distinct_left.append(self.distinct[length - 1][parent] - distinct)
            else:
                self.seen_left.append(np.zeros(len(known)))
                self.distinct_left.append(np.zeros(len(known)))

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Positions, -1 where absent."""
        if not len(table):
            return np.full(len(keys), -1, np.int64)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, at, -1)

    def exact(self, codes: np.ndarray) -> np.ndarray:
        """Scores of distinct codes, by walking from the longest known context down."""
        trie, n = self.trie, len(codes)
        score, open_, above = np.zeros(n), np.ones(n, bool), np.full(n, -1, np.int64)
        for length in range(trie.order, -1, -1):
            context = self._find(self.contexts[length], (codes >> _U(8)) & _U((1 << (8 * length)) - 1))
            here = open_ & (context >= 0)
            at, up = context[here], above[here]
            first = up < 0
            if length < trie.order and len(self.seen_left[length + 1]):
                seen = np.where(first, self.seen[length][at], self.seen_left[length + 1][np.maximum(up, 0)])
                distinct = np.where(first, self.distinct[length][at], self.distinct_left[length + 1][np.maximum(up, 0)])
            else:
                seen, distinct = self.seen[length][at], self.distinct[length][at]
            escape = distinct + self.other[length][at]
            gram = self._find(trie.grams[length], codes[here] & _U((1 << (8 * (length + 1))) - 1))
            rows, known = np.flatnonzero(here), gram >= 0
            hit = rows[known]
            score[hit] += np.log10(trie.counts[length][gram[known]] / (seen + escape)[known])
            open_[hit] = False
            leave = ~known & (escape > 0)
            score[rows[leave]] += np.log10((escape / np.maximum(seen + escape, 1))[leave])
            above[:] = np.where(context >= 0, context, -1)
        known = len(trie.grams[0])
        score[open_] -= np.log10(max(SYMBOLS - known, 1))
        return score


@dataclass(frozen=True)
class Frequent:
    """The scores of the frequent strings, in code order."""

    order: int
    grams: np.ndarray
    scores: np.ndarray


class Lookup(Cached):
    """Scores of frequent strings; NaN for all others."""

    def __init__(self, frequent: Frequent) -> None:
        super().__init__()
        self.frequent = frequent

    def exact(self, codes: np.ndarray) -> np.ndarray:
        at = Scorer._find(self.frequent.grams, codes)
        return np.where(at >= 0, self.frequent.scores[at], np.nan) if len(self.frequent.grams) else np.full(len(codes), np.nan)


def count(spark: SparkSession, docs: DataFrame, s: Settings) -> DataFrame:
    """``(gram, n)``: every string of ``order + 1`` bytes of ``docs(text)`` and its count,
    written to the shared scratch folder; null counts as empty."""
    prepare(spark)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(partial(_count, order=s.order), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return materialize(spark, counted, "ppm-grams")


def frequent(counted: DataFrame, s: Settings) -> Frequent:
    total = counted.agg(F.sum("n")).first()[0] or 0
    context = F.shiftright("gram", 8).alias("context")
    sums = counted.groupBy(context).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"))
    often = counted.where(F.col("n") >= max(1.0, s.share * total)).select("gram", "n", context)  # at most 1 / share rows
    got = often.join(sums, "context").select("gram", F.log10(F.col("n") / (F.col("total") + F.col("distinct"))).alias("score")).toArrow()
    gram, score = (got.column(c).to_numpy() for c in ("gram", "score"))
    order = np.argsort(gram)
    return Frequent(s.order, gram[order].astype(_U), score[order])


def _level(gram: np.ndarray, n: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The strings of ``length`` bytes that end ``gram``, their counts, their contexts and
    the contexts' totals."""
    code, back = np.unique(gram & _U((1 << (8 * length)) - 1), return_inverse=True)
    times = np.bincount(back, n, len(code)).astype(np.int64)
    above, back = np.unique(code >> _U(8), return_inverse=True)
    return code, times, above, np.bincount(back, times, len(above)).astype(np.int64)


def _exact(batches: Iterator[pa.RecordBatch], shared, order: int, near: int) -> Iterator[pa.RecordBatch]:
    """Scores of the strings asked for (``n`` of 0); rows arrive sorted by key."""
    short = [_level(*shared.value, length) for length in range(1, near + 1)]

    def scored(tables: list[pa.Table]) -> pa.RecordBatch:
        rows = pa.concat_tables(tables)
        gram, n = rows.column("gram").to_numpy().astype(_U), rows.column("n").to_numpy()
        known, asked = n > 0, gram[n == 0]
        levels = short + [_level(gram[known], n[known], length) for length in range(near + 1, order + 2)]
        score = Scorer(Trie(order, *(tuple(x) for x in zip(*levels, strict=True)))).exact(asked) if len(asked) else np.zeros(0)
        return pa.RecordBatch.from_arrays([pa.array(asked.astype(np.int64)), pa.array(score)], names=["gram", "score"])

    held: list[pa.Table] = []
    for rows in whole_runs(batches, ["key"]):
        held.append(rows)
        if sum(len(x) for x in held) >= 1 << 18:
            yield scored(held)
            held = []
    if held:
        yield scored(held)


def exact_scores(spark: SparkSession, counted: DataFrame, asked: DataFrame, s: Settings) -> DataFrame:
    """``(gram, score)`` of the distinct strings ``asked(gram)``, from all counted strings."""
    near = min(NEAR, s.order)
    ends = F.col("gram").bitwiseAND(F.lit((1 << (8 * near)) - 1)).alias("gram")
    got = counted.groupBy(ends).agg(F.sum("n").alias("n")).toArrow()  # at most 256 ** NEAR rows
    shared = spark.sparkContext.broadcast((got.column("gram").to_numpy().astype(_U), got.column("n").to_numpy()))
    key = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << (8 * near)) - 1))
    rows = counted.select("gram", "n").unionByName(asked.select("gram", F.lit(0).cast("long").alias("n")))
    rows = rows.withColumn("key", key).repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(partial(_exact, shared=shared, order=s.order, near=near), "gram long, score double")


def text_scores(column: pa.Array, scorer: Scorer) -> Iterator[np.ndarray]:
    for _, _, data, off in text_slices(column):
        codes, cut = gram_codes(data, off, scorer.trie.order)
        yield np.add.reduceat(scorer.score(codes), cut[:-1])
