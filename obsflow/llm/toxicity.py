"""Toxicity scores by a factorization machine over hashed terms.

A text's terms are its distinct lower-cased words and, for longer words, their first five
bytes, hashed to ``2**bits`` buckets. The machine scores
``w0 + sum w_i + sum_{i<j} <v_i, v_j>`` over the terms present, so a pair of terms can
count more (or less) than the sum of both. It is fitted on a bounded sample of labelled
rows: at most ``sample`` ids of each label, in the order of a hash of the id, one row an
id, weighted back to the labels' true shares. Every term that at least ``least_share`` of
the sample's rows hold has parameters, whatever their labels: a term that tells nothing
alone may tell much together with another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.arrow import filter_rows, prepare, tidy
from obsflow.llm.textops import ALNUM, LOWER, span_hash, text_slices, words
from obsflow.session import materialize

PREFIX = 5


@dataclass(frozen=True)
class Settings:
    sample: int = 6000
    bits: int = 20
    least_share: float = 0.0025
    factors: int = 8
    batch: int = 256
    epochs: int = 250
    tolerance: float = 0.01
    rate: float = 1.0
    l2: float = 1e-6
    seed: int = 7


@dataclass(frozen=True)
class Machine:
    """``ids``: the buckets that have parameters; ``w`` and ``v`` follow their order."""

    bits: int
    ids: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def raw(self, flat: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Scores of rows of positions into ``ids``."""
        linear = _sums(self.w[flat], off)
        s = _sums(self.v[flat], off)
        return self.w0 + linear + 0.5 * ((s * s).sum(1) - _sums((self.v[flat] ** 2).sum(1), off))


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that ``off`` cuts; empty runs give zero."""
    out = np.zeros((len(off) - 1, *values.shape[1:]))
    full = np.flatnonzero(off[1:] > off[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, off[full], axis=0)
    return out


def text_terms(column: pa.Array, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, offsets) of the distinct terms of each text, a slice of texts at a time."""
    for first, last, data, off in text_slices(column):
        low = LOWER[data]
        start, end, word_off = words(low, off, ALNUM)
        doc = np.repeat(np.arange(last - first), np.diff(word_off))
        long_ = end - start > PREFIX
        h = np.concatenate([span_hash(low, start, end), ~span_hash(low, start[long_], start[long_] + PREFIX)])
        row = np.concatenate([doc, doc[long_]])
        keys = np.unique((row.astype(np.uint64) << np.uint64(bits)) | (h >> np.uint64(64 - bits)))
        yield (keys & np.uint64((1 << bits) - 1)).astype(np.int64), np.searchsorted(keys, np.arange(last - first + 1, dtype=np.uint64) << np.uint64(bits))


def _features(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [flat[off[i] : off[i + 1]].astype(np.int32) for flat, off in text_terms(batch.column("text"), bits) for i in range(len(off) - 1)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "toxic", "terms"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class _Batch:
    """Some rows, with their entries also ordered by term."""

    flat: np.ndarray
    off: np.ndarray
    y: np.ndarray
    weight: np.ndarray

    def __post_init__(self) -> None:
        by_term = np.argsort(self.flat, kind="stable")
        self.row = np.repeat(np.arange(len(self.y), dtype=np.int32), np.diff(self.off))[by_term]
        self.terms, head = np.unique(self.flat[by_term], return_index=True)
        self.cut = np.r_[head, len(self.row)]

    def gradient(self, model: Machine, scale: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
        """Of the weighted mean logistic loss by w0, and by each of the batch's terms (a column
        for w, then those of v), whose parameters are held over their ``scale``."""
        pooled = _sums(model.v[self.flat], self.off)
        err = self.weight * (_sigmoid(model.raw(self.flat, self.off)) - self.y) / self.weight.sum()
        held = np.c_[model.w[self.terms], model.v[self.terms]]
        gw = _sums(err[self.row], self.cut)
        gv = _sums((err[:, None] * pooled)[self.row], self.cut) - held[:, 1:] * gw[:, None]
        own = scale[self.terms][:, None]
        return float(err.sum()), np.c_[gw, gv] * own + l2 * held / own


def _batches(flat: np.ndarray, off: np.ndarray, y: np.ndarray, weight: np.ndarray, size: int, rng: np.random.Generator) -> list[_Batch]:
    order = rng.permutation(len(y))
    out = []
    for k in range(0, len(y), size):
        rows = np.sort(order[k : k + size])
        own = np.diff(off)[rows]
        cut = np.concatenate([[0], np.cumsum(own)])
        at = np.repeat(off[rows] - cut[:-1], own) + np.arange(cut[-1])
        out.append(_Batch(flat[at], cut, y[rows], weight[rows]))
    return out


def _descend(flat: np.ndarray, off: np.ndarray, y: np.ndarray, weight: np.ndarray, ids: np.ndarray, s: Settings) -> Machine:
    """Adam over batches of rows on the weighted logistic loss, a term being moved when a
    batch holds it. A term's parameters are learned over the root of its share of the rows,
    whatever their labels, so rare terms are bound closer to zero. Steps shrink by the epoch;
    the descent ends when an epoch's mean gradient is at most ``tolerance`` of the longest one."""
    rng = np.random.default_rng(s.seed)
    scale = np.sqrt(np.bincount(flat, minlength=len(ids)) / max(len(y), 1)).astype(np.float32)
    batches = _batches(flat, off, y, weight, s.batch, rng)
    w0, held = 0.0, np.zeros((len(ids), 1 + s.factors), np.float32)
    held[:, 1:] = rng.normal(0, 0.02, (len(ids), s.factors))
    first, second, moves = np.zeros_like(held), np.zeros_like(held), np.zeros(len(ids), np.int32)
    first0 = second0 = 0.0
    t, longest = 0, 0.0
    for epoch in range(1, s.epochs + 1):
        rate = s.rate / np.sqrt(epoch)
        mean0, mean = 0.0, np.zeros_like(held)
        for k in rng.permutation(len(batches)):
            b = batches[k]
            g0, g = b.gradient(Machine(s.bits, ids, w0, held[:, 0], held[:, 1:]), scale, s.l2)
            mean0, t = mean0 + g0 / len(batches), t + 1
            mean[b.terms] += g / len(batches)
            first0, second0 = 0.9 * first0 + 0.1 * g0, 0.999 * second0 + 0.001 * g0 * g0
            w0 -= rate * (first0 / (1 - 0.9**t)) / ((second0 / (1 - 0.999**t)) ** 0.5 + 1e-8)
            moves[b.terms] += 1
            n = moves[b.terms].astype(np.float32)[:, None]
            m, q = 0.9 * first[b.terms] + 0.1 * g, 0.999 * second[b.terms] + 0.001 * g * g
            first[b.terms], second[b.terms] = m, q
            held[b.terms] -= rate * scale[b.terms][:, None] * (m / (1 - 0.9**n)) / (np.sqrt(q / (1 - 0.999**n)) + 1e-8)
        length = (mean0**2 + float((mean**2).sum())) ** 0.5
        longest = max(longest, length)
        if length <= s.tolerance * longest:
            break
    return Machine(s.bits, ids, w0, held[:, 0].copy(), held[:, 1:].copy())


def _positions(ids: np.ndarray, bits: int) -> np.ndarray:
    table = np.full(1 << bits, -1, np.int32)
    table[ids] = np.arange(len(ids), dtype=np.int32)
    return table


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Machine:
    """Fit on ``labels(doc_id, toxic)`` joined with ``docs``; callers pass only rows that may
    be learned from. A document labelled both ways counts as toxic; null labels are left
    out; of rows that repeat an id one is taken, by a hash of its text. Without both labels
    the machine is a constant; texts without terms teach it only its constant."""
    s = settings or Settings()
    prepare(spark)
    truth = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = {r["toxic"]: r["n"] for r in truth.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect() if r["toxic"] in (0, 1)}
    constant = Machine(s.bits, np.zeros(0, np.int64), -4.0, np.zeros(0), np.zeros((0, s.factors)))
    if len(share) < 2:
        return constant
    picks = [truth.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample) for y in (0, 1)]
    chosen = picks[0].unionByName(picks[1])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # at most 2 * sample ids, a row each
    terms = rows.mapInArrow(tidy(partial(_features, bits=s.bits)), "doc_id long, toxic int, terms array<int>")
    held = materialize(spark, terms, "toxic-sample").orderBy("doc_id").toArrow()
    y = held.column("toxic").to_numpy().astype(float)
    n = {c: float((y == c).sum()) for c in (0, 1)}
    if not n[0] or not n[1]:
        return constant
    lists = held.column("terms").combine_chunks()
    flat, off = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
    rows_with = np.bincount(flat, minlength=1 << s.bits)
    ids = np.flatnonzero(rows_with >= max(1, s.least_share * len(y)))
    at, off = _known(flat, off, _positions(ids, s.bits))
    return _descend(at, off, y, np.where(y == 1, share[1] / n[1], share[0] / n[0]), ids, s)


def _known(flat: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms that have parameters, by their places among them."""
    at = table[flat]
    known = at >= 0
    return at[known], np.concatenate([[0], np.cumsum(known)])[off]


def _scores(column: pa.Array, model: Machine, table: np.ndarray) -> np.ndarray:
    out = [np.zeros(0)]
    for flat, off in text_terms(column, model.bits):
        out.append(_sigmoid(model.raw(*_known(flat, off, table))))
    return np.concatenate(out)


def _apply(batches: Iterator[pa.RecordBatch], model: Machine) -> Iterator[pa.RecordBatch]:
    table = _positions(model.ids, model.bits)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_scores(batch.column("text"), model, table))], names=["doc_id", "score"])


def score(spark: SparkSession, docs: DataFrame, model: Machine) -> DataFrame:
    """``(doc_id, score, predicted)``, one row for each row of ``docs(doc_id, text)``; other
    columns are not read. Null and empty texts score as texts without terms; ids may be
    null or repeat; an empty table gives an empty result."""
    prepare(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(tidy(partial(_apply, model=model)), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(spark: SparkSession, docs: DataFrame, model: Machine) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns. Null and empty
    texts stay or go as texts without terms; repeated rows fare alike; texts of any type are
    read as strings; an empty table gives an empty result."""
    prepare(spark)
    tables: list[np.ndarray] = []  # one a task

    def keep(batch: pa.RecordBatch) -> np.ndarray:
        if not tables:
            tables.append(_positions(model.ids, model.bits))
        return _scores(batch.column("text").cast(pa.string()), model, tables[0]) < 0.5

    return filter_rows(docs, keep)
