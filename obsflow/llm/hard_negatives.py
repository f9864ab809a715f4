"""Hard negatives by a vertical scan with branch-and-bound (BOND).

Vectors lie dimension by dimension. An anchor reads the dimensions in the order of its own
descending magnitudes; after every few of them the partial inner products, widened by the
least and the most that the remaining dimensions can add (from each dimension's minimum
and maximum in the block), bound every candidate's score. Candidates that can neither
enter the anchor's best rows nor lie in one of its score windows leave the bitmap, until
the scores of the rest are exact.

Two scans: the first finds each anchor's best rows of its own label, the second the best
rows of other labels in the window that each of these sets. A task keeps the best few rows
of each anchor; Spark merges them. Anchors are a stated query set; they are broadcast
``anchor_bytes`` at a time, so what a task holds does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.llm.arrow import prepare
from obsflow.session import materialize

LOWEST = np.iinfo(np.int64).min
#: Greatest magnitude of a score, so that a hundred times it fits a long.
MOST = 1 << 55
_NO_ROW = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    #: A window in hundredths of the positive's score.
    low: int = 50
    high: int = 95
    #: Vectors scanned together, dimensions between two prunings, bytes of anchors broadcast together.
    block: int = 8192
    step: int = 4
    anchor_bytes: int = 16 << 20


def _matrix(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable rows, their dimension counts, flat integer components in row order)."""
    lists = column.cast(pa.list_(pa.float64()))
    flat = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    off = np.concatenate([[0], np.cumsum(size)])
    usable = pc.is_valid(lists).to_numpy(zero_copy_only=False) & (bad[off[1:]] == bad[off[:-1]])
    values = np.floor(scale * flat[np.repeat(usable, size)])
    bound = np.repeat([isqrt(MOST // max(int(d), 1)) for d in size[usable]], size[usable]).astype(np.float64)
    return np.flatnonzero(usable), size[usable], np.clip(values, -bound, bound).astype(np.int64)


def _encode(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Rows that take part, their components as little-endian 64-bit integers."""
    for batch in batches:
        rows, size, values = _matrix(batch.column("embedding"), scale)
        off = np.concatenate([[0], np.cumsum(size)])
        vec = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((8 * off).astype(np.int32)), pa.py_buffer(values.astype("<i8"))])
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in ("key", "vec_id", "label", "anchor")), vec], names=["key", "vec_id", "label", "anchor", "vec"])


class Block:
    """Vectors of one length, sorted by label, stored dimension by dimension."""

    def __init__(self, key: np.ndarray, ids: np.ndarray, label: np.ndarray, vec: np.ndarray) -> None:
        order = np.argsort(label, kind="stable")
        self.key, self.ids, self.label = key[order], ids[order], label[order]
        self.by_dim = np.ascontiguousarray(vec[order].T)
        self.most = int(np.abs(vec).max(initial=0))
        self.extent: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def bounds(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest component of each dimension among rows a to b."""
        if (a, b) not in self.extent:
            part = self.by_dim[:, a:b]
            self.extent[a, b] = part.min(axis=1), part.max(axis=1)
        return self.extent[a, b]

    def ranges(self, label: int, same: bool) -> list[tuple[int, int]]:
        a, b = (int(x) for x in np.searchsorted(self.label, [label, label + 1]))
        return [r for r in ([(a, b)] if same else [(0, a), (b, len(self.label))]) if r[0] < r[1]]


def _scan(block: Block, anchor: np.ndarray, spans: list[tuple[int, int]], keep, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, exact scores) of the candidates that ``keep(low, high)`` never turned down."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    # whole numbers below 2^53 are exact as doubles, whose products are faster
    exact = np.float64 if int(np.abs(anchor).max(initial=0)) * block.most * max(len(anchor), 1) < 1 << 53 else np.int64
    rows, scores = [], []
    for a, b in spans:
        low, high = block.bounds(a, b)
        least, greatest = np.minimum(anchor * low, anchor * high)[order], np.maximum(anchor * low, anchor * high)[order]
        rest_low = np.concatenate([np.cumsum(least[::-1])[::-1], [0]])
        rest_high = np.concatenate([np.cumsum(greatest[::-1])[::-1], [0]])
        live = np.arange(a, b)
        part = np.zeros(b - a, exact)
        whole = True  # no candidate has left yet: read slices instead of gathering
        for d in range(0, len(order), step):
            dims = order[d : d + step]
            columns = block.by_dim[dims, a:b] if whole else block.by_dim[dims[:, None], live]
            part = part + anchor[dims].astype(exact) @ columns.astype(exact)
            stay = keep(part + exact(rest_low[min(d + step, len(order))]), part + exact(rest_high[min(d + step, len(order))]))
            if not stay.all():
                live, part, whole = live[stay], part[stay], False
                if not len(live):
                    break
        rows.append(live)
        scores.append(part.astype(np.int64))
    return (np.concatenate(rows), np.concatenate(scores)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _best(score: np.ndarray, ids: np.ndarray, key: np.ndarray, n: int) -> np.ndarray:
    return np.lexsort((key, ids, -score))[:n]


class Anchors:
    """A block of anchors as a task gets it, with the best rows found so far."""

    def __init__(self, key: np.ndarray, label: np.ndarray, vectors: list[np.ndarray], windows: list[np.ndarray] | None, s: Settings) -> None:
        self.key, self.label, self.vectors, self.windows, self.s = key, label, vectors, windows, s
        #: For each anchor and wish (one wish, or one for each window): score, id and key of its best rows.
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def _merge(self, wish: tuple[int, int], score: np.ndarray, ids: np.ndarray, key: np.ndarray, n: int) -> None:
        if wish in self.found:
            score, ids, key = (np.concatenate(x) for x in zip(self.found[wish], (score, ids, key), strict=True))
        best = _best(score, ids, key, n)
        self.found[wish] = score[best], ids[best], key[best]

    def _floor(self, wish: tuple[int, int], n: int) -> int:
        """The score that a row must reach to be among the best."""
        score = self.found[wish][0] if wish in self.found else ()
        return int(score[-1]) if len(score) == n else LOWEST

    def read(self, block: Block) -> None:
        for a, vector in enumerate(self.vectors):
            if len(vector) == len(block.by_dim):
                if self.windows is None:
                    self._positives(block, a, vector)
                elif len(self.windows[a]):
                    self._negatives(block, a, vector)

    def _positives(self, block: Block, a: int, vector: np.ndarray) -> None:
        n, own = self.s.positives, self.key[a]
        floor = self._floor((a, 0), n)

        def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            # one row more than asked for, as the anchor itself may be among them
            sure = np.partition(low, -n - 1)[-n - 1] if len(low) > n else LOWEST
            return high >= max(floor, sure)

        rows, score = _scan(block, vector, block.ranges(self.label[a], True), keep, self.s.step)
        other = block.key[rows] != own
        rows, score = rows[other], score[other]
        if len(rows):
            self._merge((a, 0), score, block.ids[rows], block.key[rows], n)

    def _negatives(self, block: Block, a: int, vector: np.ndarray) -> None:
        n, windows = self.s.negatives, self.windows[a]
        floor = [max(low, self._floor((a, w), n)) for w, (low, _) in enumerate(windows.tolist())]
        top = windows[:, 1].tolist()

        def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            stay = np.zeros(len(low), bool)
            for w, (f, t) in enumerate(zip(floor, top, strict=True)):
                inside = low[(low >= f) & (high <= t)]  # surely in the window
                sure = np.partition(inside, -n)[-n] if len(inside) >= n else f
                stay |= (high >= sure) & (low <= t)
            return stay

        rows, score = _scan(block, vector, block.ranges(self.label[a], False), keep, self.s.step)
        for w, (low, high) in enumerate(windows.tolist()):
            inside = (score >= low) & (score <= high)
            if inside.any():
                self._merge((a, w), score[inside], block.ids[rows[inside]], block.key[rows[inside]], n)

    def rows(self) -> pa.RecordBatch:
        names = ["anchor_key", "wish", "score", "vec_id", "key"]
        wishes = list(self.found)
        count = [len(self.found[w][0]) for w in wishes]
        columns = [np.repeat(self.key[[a for a, _ in wishes]], count) if wishes else [], np.repeat([w for _, w in wishes], count)]
        columns += [np.concatenate(c) if wishes else [] for c in (zip(*self.found.values(), strict=True) if wishes else ((), (), ()))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    """Blocks of up to ``size`` vectors of one length."""
    held: dict[int, list[tuple[np.ndarray, ...]]] = {}
    count: dict[int, int] = {}

    def block(dims: int) -> Block:
        count.pop(dims)
        return Block(*(np.concatenate(x) for x in zip(*held.pop(dims), strict=True)))

    for batch in batches:
        for first in range(0, batch.num_rows, size):
            part = batch.slice(first, size)
            ids = pc.fill_null(part.column("vec_id"), _NO_ROW).to_numpy(zero_copy_only=False)
            lengths = pc.binary_length(part.column("vec")).to_numpy(zero_copy_only=False) // 8
            for dims in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == dims)
                vec = np.frombuffer(b"".join(part.column("vec").take(pa.array(rows)).to_pylist()), "<i8").reshape(len(rows), dims)
                got = (part.column("key").to_numpy()[rows], ids[rows], part.column("label").to_numpy()[rows].astype(np.int64), vec)
                held.setdefault(dims, []).append(got)
                count[dims] = count.get(dims, 0) + len(rows)
                if count[dims] >= size:
                    yield block(dims)
    for dims in list(held):
        yield block(dims)


def _search(batches: Iterator[pa.RecordBatch], sent, s: Settings) -> Iterator[pa.RecordBatch]:
    table = pa.ipc.open_stream(sent.value).read_all()
    windows = None
    if "windows" in table.column_names:
        windows = [np.array([(w["low"], w["high"]) for w in x or []], np.int64).reshape(-1, 2) for x in table.column("windows").to_pylist()]
    vectors = [np.frombuffer(v.as_py(), "<i8") for v in table.column("vec").combine_chunks()]
    anchors = Anchors(table.column("key").to_numpy(), table.column("label").to_numpy(), vectors, windows, s)
    for block in _blocks(batches, s.block):
        anchors.read(block)
    yield anchors.rows()


def _merged(spark: SparkSession, rows: DataFrame, anchors: DataFrame, rounds: int, n: int, s: Settings, name: str) -> DataFrame:
    """(anchor_key, wish, rank, score, vec_id, key): each wish's best ``n`` rows of the table."""
    parts = []
    for r in range(rounds):
        some = anchors.where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == r).toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, some.schema) as writer:
            writer.write_table(some)
        sent = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
        schema = "anchor_key long, wish long, score long, vec_id long, key long"
        parts.append(materialize(spark, rows.select("key", "vec_id", "label", "vec").mapInArrow(partial(_search, sent=sent, s=s), schema), name))
        sent.unpersist()
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    best = Window.partitionBy("anchor_key", "wish").orderBy(F.col("score").desc(), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


def hard_negatives(spark: SparkSession, vectors: DataFrame, anchors: Column, settings: Settings | None = None) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors(vec_id, embedding, label)``; ``anchors`` says which rows are queries. A score
    is the inner product of the components' ``floor(scale * x)``. For each anchor and each
    of its best ``positives`` other rows of its label: the best ``negatives`` rows of other
    labels that score from ``low`` to ``high`` hundredths of the positive's score. Higher
    scores come first, ties by smaller id (null last).

    Rows with a null label or vector, or with null or non-finite components, take no part;
    vectors meet only those of their own length (empty ones score 0). Rows that repeat an
    id are rows of their own. Components are held at the square root of 2^55 / length, so
    that a hundred times any score fits a long. Other columns are not read; an empty table, or one without
    anchors, gives an empty result.
    """
    s = settings or Settings()
    prepare(spark)
    rows = vectors.where("label is not null and embedding is not null").select(
        F.monotonically_increasing_id().alias("key"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col("embedding").cast("array<double>").alias("embedding"),
    )
    coded = rows.mapInArrow(partial(_encode, scale=s.scale), "key long, vec_id long, label long, anchor boolean, vec binary")
    coded = materialize(spark, coded, "integer-vectors")
    n_rows, n_anchors, size = coded.agg(F.count(F.lit(1)), F.count_if("anchor"), F.sum(F.when(F.col("anchor"), F.length("vec") + 64))).first()
    rounds = max(1, ceil((size or 0) / s.anchor_bytes))
    # every task reads all anchors of a round: enough tasks to share the scan, none smaller than a block
    tasks = max(1, min(ceil(n_rows / s.block), ceil(n_rows * max(n_anchors, 1) / 2e6)))
    coded = materialize(spark, coded.repartition(tasks), "dealt-vectors")
    asked = coded.where("anchor").select("key", "label", "vec")
    best = materialize(spark, _merged(spark, coded, asked, rounds, s.positives, s, "positives").select("anchor_key", "rank", "score", "vec_id", "key"), "positives")

    # 100 * negative >= low * positive and 100 * negative <= high * positive, in whole numbers
    low, high = F.expr(f"div({s.low} * score + 99 - pmod({s.low} * score + 99, 100), 100)"), F.expr(f"div({s.high} * score - pmod({s.high} * score, 100), 100)")
    windows = best.groupBy("anchor_key").agg(F.array_sort(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("windows"))
    asked = asked.join(windows, asked["key"] == windows["anchor_key"]).select("key", "label", "vec", F.transform("windows", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"))).alias("windows"))
    worst = _merged(spark, coded, asked, rounds, s.negatives, s, "negatives")
    worst = worst.select("anchor_key", (F.col("wish") + 1).alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = best.select("anchor_key", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).join(worst, ["anchor_key", "positive_rank"])
    named = coded.where("anchor").select(F.col("key").alias("anchor_key"), F.col("vec_id").alias("anchor_id"))
    absent = lambda c: F.when(F.col(c) != _NO_ROW, F.col(c)).alias(c)
    return pairs.join(named, "anchor_key").select("anchor_id", absent("positive_id"), F.col("rank").cast("int").alias("rank"), absent("negative_id"), "positive_score", "negative_score")
