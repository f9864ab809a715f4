"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams (n = 1 to ``longest``, lower-cased,
non-letters folded to blanks, hashed to ``width`` columns) that both contain, over the
geometric mean of the numbers either contains: a normalised blended-spectrum presence
kernel. A Nystrom map through ``landmarks`` sample texts turns it into features, and one
ridge regression for each language against the rest is solved on a bounded sample of
about ``sample`` labelled texts a language. Texts are scored in blocks: presence matrix
times landmark matrix, then times the regression's coefficients. A text of more than
``PIECE`` bytes, whose n-grams would fill the columns, is scored in even pieces of the whole
text, and their margins are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.arrow import filter_rows, prepare, tidy
from obsflow.llm.textops import LOWER, text_slices

UNKNOWN = "und"
LETTER = r"\p{L}"
PIECE = 16 << 10
LONGEST_CLASS = PIECE.bit_length() - 1
_FOLD = LOWER.copy()
_FOLD[: ord("a")] = 32
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("z") + 1 : 128] = 32


@dataclass(frozen=True)
class Settings:
    """``sample`` texts a language are aimed at and ``limit`` texts are taken at most;
    ``languages`` bounds the number of distinct values of ``lang`` (the most frequent)."""

    sample: int = 400
    limit: int = 6000
    languages: int = 500
    landmarks: int = 192
    longest: int = 4
    width: int = 8192
    ridge: float = 1e-3
    sharpness: float = 6.0


@dataclass(frozen=True)
class Classifier:
    languages: tuple[str, ...]
    marks: np.ndarray  # landmarks as columns, each divided by the root of its n-gram count
    coef: np.ndarray
    root: np.ndarray  # from kernel values to the coordinates of the Nystrom map
    longest: int
    width: int
    sharpness: float

    def measures(self, presence: np.ndarray) -> np.ndarray:
        """The margins of all languages and, last, the share of the text's kernel norm that
        the landmarks explain: low for texts unlike any that were learned from."""
        size = np.sqrt(np.maximum(presence.sum(axis=1, dtype=np.float64), 1.0))
        kernel = (presence.astype(np.float32) @ self.marks) / size[:, None]
        return np.c_[kernel @ self.coef, ((kernel @ self.root) ** 2).sum(axis=1)]


def _blocks(data: np.ndarray, off: np.ndarray, longest: int, width: int, rows: int) -> Iterator[np.ndarray]:
    shift = np.uint32(32 - int(width).bit_length() + 1)
    for a in range(0, len(off) - 1, rows):
        b = min(a + rows, len(off) - 1)
        part = _FOLD[data[off[a] : off[b]]].astype(np.uint32)
        cut = off[a : b + 1] - off[a]
        row = np.repeat(np.arange(b - a, dtype=np.int64), np.diff(cut))
        out = np.zeros((b - a) * width, bool)
        code = np.zeros(len(part), np.uint32)
        for n in range(1, longest + 1):
            m = len(part) - n + 1
            if m <= 0:
                break
            code = (code[:m] << np.uint32(8)) | part[n - 1 :]
            slot = ((code + np.uint32(n * 0x01000193)) * np.uint32(2654435761)) >> shift
            inside = row[:m] == row[n - 1 :]
            out[(row[:m] * width + slot)[inside]] = True
        yield out.reshape(b - a, width)


def presence(column: pa.Array, longest: int, width: int, rows: int = 256) -> Iterator[np.ndarray]:
    """Boolean matrices (at most ``rows`` texts by ``width``), in row order."""
    for _, _, data, off in text_slices(column):
        yield from _blocks(data, off, longest, width, rows)


def text_measures(column: pa.Array, model: Classifier, rows: int = 256) -> Iterator[np.ndarray]:
    """``measures`` of texts, in row order; long texts have the mean of their pieces."""
    for _, _, data, off in text_slices(column):
        size = np.diff(off)
        pieces = np.maximum(1, -(-size // PIECE))
        head = np.cumsum(pieces) - pieces
        text = np.repeat(np.arange(len(size)), pieces)
        cut = np.r_[off[text] + size[text] * (np.arange(len(text)) - head[text]) // pieces[text], off[-1]]
        found = np.concatenate([model.measures(x) for x in _blocks(data, cut, model.longest, model.width, rows)])
        yield np.add.reduceat(found, head, axis=0) / pieces[:, None]


def text_margins(column: pa.Array, model: Classifier, rows: int = 256) -> Iterator[np.ndarray]:
    """Matrices (texts by languages), in row order."""
    for found in text_measures(column, model, rows):
        yield found[:, :-1]


def _pack(batches: Iterator[pa.RecordBatch], longest: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = [x.tobytes() for block in presence(batch.column("text"), longest, width) for x in np.packbits(block, axis=1)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(bits, pa.binary())], names=["doc_id", "lang", "bits"])


def fit(spark: SparkSession, docs: DataFrame, settings: Settings | None = None) -> Classifier:
    """Fit on ``docs(doc_id, text, lang)``; callers pass only rows that may be learned from.
    Rows whose id, text or lang is null are left out. With no row left the classifier
    knows no language and answers ``und``."""
    s = settings or Settings()
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where("doc_id is not null and text is not null and lang is not null")
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(s.languages).collect()
    if not counts:
        return Classifier((), np.zeros((s.width, 0), np.float32), np.zeros((0, 0)), np.zeros((0, 0)), s.longest, s.width, s.sharpness)
    # each row is taken by a hash of its id, at the rate that its language's count asks for
    rate = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, s.sample / r["n"]))])
    spread = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = rows.where(spread < F.try_element_at(rate, F.col("lang")))
    packed = picked.mapInArrow(tidy(partial(_pack, longest=s.longest, width=s.width)), "doc_id long, lang string, bits binary")
    got = packed.orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "bits").limit(s.limit).collect()
    bits = np.unpackbits(np.frombuffer(b"".join(bytes(r["bits"]) for r in got), np.uint8).reshape(len(got), s.width // 8), axis=1).astype(np.float32)
    names = tuple(sorted({r["lang"] for r in got}))
    truth = np.array([names.index(r["lang"]) for r in got])
    turn = np.zeros(len(got), int)
    for k in range(len(names)):
        turn[truth == k] = np.arange((truth == k).sum())
    marks = bits[np.lexsort((truth, turn))[: s.landmarks]]  # the languages take turns
    marks = (marks / np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))).T.copy()
    unit = bits / np.sqrt(np.maximum(bits.sum(1, keepdims=True), 1))
    kernel = (unit @ marks).astype(np.float64)
    value, vector = np.linalg.eigh((marks.T @ marks).astype(np.float64))
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])
    phi = kernel @ root
    target = np.where(truth[:, None] == np.arange(len(names)), 1.0, -1.0)
    share = 1.0 / np.bincount(truth, minlength=len(names))[truth]
    gram = phi.T @ (phi * share[:, None]) + s.ridge * len(names) * np.eye(phi.shape[1])
    return Classifier(names, marks, root @ np.linalg.solve(gram, phi.T @ (target * share[:, None])), root, s.longest, s.width, s.sharpness)


def _apply(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        best, sure = [], []
        for margin in text_margins(batch.column("text"), model):
            margin = margin * model.sharpness
            p = np.exp(margin - margin.max(axis=1, keepdims=True))
            best.append(margin.argmax(axis=1))
            sure.append(p.max(axis=1) / p.sum(axis=1))
        at = np.concatenate(best) if best else np.zeros(0, np.int64)
        names = pa.array(model.languages, pa.string()).take(pa.array(at))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lettered"), names, pa.array(np.concatenate(sure) if sure else np.zeros(0))], names=["doc_id", "lettered", "best", "sure"])


def predict(spark: SparkSession, docs: DataFrame, model: Classifier) -> DataFrame:
    """``(doc_id, lang_pred, score)``, one row for each row of ``docs(doc_id, text)``; other
    columns are not read. ``und`` with score 0 for a null text or one without a letter;
    ids may be null or repeat; an empty table gives an empty result."""
    prepare(spark)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(text.rlike(LETTER), F.lit(False)).alias("lettered"))
    if not model.languages:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    scored = rows.mapInArrow(tidy(partial(_apply, model=model)), "doc_id long, lettered boolean, best string, sure double")
    return scored.select("doc_id", F.when(F.col("lettered"), F.col("best")).otherwise(UNKNOWN).alias("lang_pred"), F.when(F.col("lettered"), F.col("sure")).otherwise(0.0).alias("score"))


def _measure(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.concatenate([*text_measures(batch.column("text"), model), np.zeros((0, len(model.languages) + 1))])
        columns = [pa.array(length_class(batch.column("text"))), pa.array(found[:, :-1].max(axis=1)), pa.array(found[:, -1])]
        yield pa.RecordBatch.from_arrays(columns, names=["length", "margin", "explained"])


def length_class(column: pa.Array) -> np.ndarray:
    """Binary logarithms of the texts' bytes; beyond a piece all lengths are scored alike."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), LONGEST_CLASS)


def calibrate(spark: SparkSession, docs: DataFrame, model: Classifier, loss: float = 0.001, slack: float = 0.15) -> np.ndarray:
    """Cut-offs (margin, explained share) for each length class, from the lettered, labelled rows
    of ``docs(text, lang)``: half of their median margin, and the explained share that all but
    ``loss`` of them reach, less ``slack`` of it for texts a little unlike those. A class
    without such rows takes the lower cut-offs of its neighbours that have some; texts
    shorter than all of them are not cut off."""
    prepare(spark)
    cutoffs = np.full((LONGEST_CLASS + 1, 2), -np.inf)
    if not model.languages:
        return cutoffs
    text = F.col("text").cast("string")
    rows = docs.where("lang is not null").select(text.alias("text")).where(F.col("text").rlike(LETTER))
    measured = rows.mapInArrow(tidy(partial(_measure, model=model)), "length long, margin double, explained double")
    # one row a length class; rows beyond the approximation's accuracy only move a cut-off by that share
    limits = [F.percentile_approx(c, share, 100_000).alias(c) for c, share in (("margin", 0.5), ("explained", loss))]
    got = {r["length"]: (r["margin"] / 2, r["explained"] * (1 - slack)) for r in measured.groupBy("length").agg(*limits).collect()}
    for k in range(LONGEST_CLASS + 1):
        below, above = max((x for x in got if x <= k), default=None), min((x for x in got if x >= k), default=None)
        if below is not None:
            cutoffs[k] = np.minimum(got[below], got[below if above is None else above])
    return cutoffs


def known(spark: SparkSession, docs: DataFrame, model: Classifier, cutoffs: np.ndarray) -> DataFrame:
    """The rows of ``docs`` in a language that the classifier learned, with all their columns.

    Every text is scored. A row goes if its text is null or has no letter, if the classifier
    knows no language, or if both its best margin and its explained share are below the
    ``cutoffs`` (of ``calibrate``) of its length: it is near no language, and unlike all that
    was learned from. A text of several known languages has low margins, but is explained. Rows are decided one by one, so repeated rows and ids fare
    alike; an empty table gives an empty result.
    """
    prepare(spark)
    if not model.languages:
        return docs.where("false")
    text = F.col("text").cast("string")
    lettered = docs.where(F.coalesce(text.rlike(LETTER), F.lit(False)))

    def keep(batch: pa.RecordBatch) -> np.ndarray:
        column = batch.column("text").cast(pa.string())
        found = np.concatenate([*text_measures(column, model), np.zeros((0, len(model.languages) + 1))])
        least = cutoffs[length_class(column)]
        return (found[:, :-1].max(axis=1) >= least[:, 0]) | (found[:, -1] >= least[:, 1])

    return filter_rows(lettered, keep)
