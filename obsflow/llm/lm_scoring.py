"""Scores of whole texts: PPM over bytes, beside a smoothed word-unigram base line.

Word counts cover every training text. A text needs the count of each of its words. Words
whose share of all training tokens is at least ``share`` (at most ``1 / share`` of them)
are counted where the text is read; the others are dealt by word and joined with the
counts, then summed by text. Words are compared as 64-bit hashes. The byte strings of a text
go the same two ways (see ``ppm``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm import ppm
from obsflow.llm.arrow import prepare
from obsflow.llm.textops import LOWER, NOT_BLANK, span_hash, text_slices, words
from obsflow.session import materialize


@dataclass(frozen=True)
class Settings:
    share: float = 2e-6
    ppm: ppm.Settings = field(default_factory=ppm.Settings)


def _hashes(column: pa.Array, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, _, data, off in text_slices(column, limit):
        low = LOWER[data]
        start, end, word_off = words(low, off, NOT_BLANK)
        yield span_hash(low, start, end).astype(np.int64), word_off


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for hashes, _ in _hashes(batch.column("text"), 8 << 20):
            word, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], names=["word", "n"])


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    word, count, frequent = shared.value
    lookup, row = ppm.Lookup(frequent), TaskContext.get().partitionId() << 40
    logs = np.log10(count + 1.0)
    for batch in batches:
        text = batch.column("text")
        score, grams, gram_times = [], [], []
        for _, _, data, off in text_slices(text):
            codes, cut = ppm.gram_codes(data, off, frequent.order)
            value = lookup.score(codes)
            other = np.isnan(value)
            score.append(np.add.reduceat(np.where(other, 0.0, value), cut[:-1]))
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                g, n = np.unique(codes[a:b][other[a:b]], return_counts=True)
                grams.append(g.astype(np.int64))
                gram_times.append(n)
        tokens, known, base, rare, times = [], [], [], [], []
        for hashes, off in _hashes(text, 2 << 20):
            at = np.minimum(np.searchsorted(word, hashes), max(len(word) - 1, 0))
            hit = word[at] == hashes if len(word) else np.zeros(len(hashes), bool)
            sums = np.concatenate([[0.0], np.cumsum(np.where(hit, logs[at], 0.0) if len(word) else np.zeros(len(hashes)))])
            hits = np.concatenate([[0], np.cumsum(hit)])
            tokens.append(np.diff(off) + 1)
            known.append(np.diff(hits[off]))
            base.append(np.diff(sums[off]))
            for a, b in zip(off[:-1], off[1:], strict=True):
                w, n = np.unique(hashes[a:b][~hit[a:b]], return_counts=True)
                rare.append(w)
                times.append(n)
        n = batch.num_rows
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (tokens, known, base, score)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(row + np.arange(n)), batch.column("doc_id"), pa.array(joined[0].astype(np.int64)), pa.array(joined[1].astype(np.int64)), pa.array(joined[2].astype(float)), pa.array(joined[3].astype(float)),
             *(pa.array(x, pa.list_(pa.int64())) for x in (rare, times, grams, gram_times))],
            names=["row", "doc_id", "n_tokens", "known", "logs", "score", "rare", "times", "grams", "gram_times"],
        )
        row += n


_SCORED = "row long, doc_id long, n_tokens long, known long, logs double, score double, rare array<long>, times array<long>, grams array<long>, gram_times array<long>"


def score_texts(spark: SparkSession, docs: DataFrame, training: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)``, one row for each row
    of ``docs(doc_id, text)``, learned from all rows of ``training(text)``.

    Null and empty texts are the end mark alone; ids may be null or repeat; other columns
    are not read. Without training rows the base is log10(1 / 1) a token and the model
    knows no symbol.
    """
    s = settings or Settings()
    prepare(spark)
    learn = training.select(F.col("text").cast("string").alias("text"))
    counts = materialize(spark, learn.mapInArrow(_count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    ends = learn.count()
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = (sums["n"] or 0) + ends, sums["v"] + (1 if ends else 0)
    frequent = counts.where(F.col("n") >= max(1.0, s.share * total)).toArrow()  # at most 1 / share rows
    word, count = (frequent.column(c).to_numpy() for c in ("word", "n"))
    order = np.argsort(word)
    strings = ppm.count(spark, learn, s.ppm)
    shared = spark.sparkContext.broadcast((word[order], count[order].astype(float), ppm.frequent(strings, s.ppm)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = materialize(spark, texts.mapInArrow(partial(_score, shared=shared), _SCORED), "lm-scored")
    pairs = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    found = pairs.join(counts, "word").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"))
    asked = scored.select("row", F.explode(F.arrays_zip("grams", "gram_times")).alias("x")).select("row", F.col("x.grams").alias("gram"), F.col("x.gram_times").alias("times"))
    exact = ppm.exact_scores(spark, strings, asked.select("gram").distinct(), s.ppm)
    rest = asked.join(exact, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("score")).alias("more_score"))
    end_log, unit = F.log10(F.lit(float(ends + 1))), F.log10(F.lit(float(total + distinct + 1)))
    return scored.join(found, "row", "left").join(rest, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + end_log - F.col("n_tokens") * unit).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
