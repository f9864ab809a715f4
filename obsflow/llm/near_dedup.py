"""MinHash near-duplicate groups with sequential Bayesian verification.

1. One pass over the texts gives every row its shingle set's size and 128-bit fingerprint,
   band keys, and a signature of one byte per MinHash. Rows with equal sets become one
   node (their smallest id) through a map-side combined aggregate.
2. Rows are dealt by band key. Inside a bucket the signatures are compared a batch of
   hashes at a time, and a pair leaves once the posterior probability that its similarity
   reaches the threshold falls below ``miss``. A pair that shares several bands is compared
   in the first only.
3. Survivors are verified exactly on full shingle sets. Buckets of up to ``SMALL`` nodes
   hand on their survivors as pairs, which are joined with the sets. Larger buckets are
   split into blocks of at most about ``BLOCK`` nodes and ``BLOCK_SHINGLES`` shingles; each
   pair of blocks is a group of its own whose rows bring their sets, verifies its survivors
   in place and hands on only a star of every component it finds. So no large group is
   expanded to pairs, and every survivor is verified.
4. Components are found by distributed star contraction.

Shingles are compared as 64-bit hashes. Two different shingles of one pair of texts
collide with probability below 1e-9 even for texts of 20,000 words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.components import connected_components
from obsflow.llm.minhash import least_matches, signature
from obsflow.llm.arrow import prepare, tidy, whole_runs
from obsflow.llm.textops import LOWER, NOT_BLANK, mix, shingles, span_hash, text_slices, words
from obsflow.session import materialize

BLOCK = 2048
BLOCK_SHINGLES = 1 << 20
SMALL = 16


@dataclass(frozen=True)
class Settings:
    """``shingle`` words, links at ``100 * intersection >= percent * union``, ``bands`` of
    ``rows`` hashes (at the threshold 0.85, 32 bands of 8 miss a pair with probability 4e-5),
    pruning after every ``batch`` hashes at posterior ``miss``."""

    shingle: int = 3
    percent: int = 85
    bands: int = 32
    rows: int = 8
    batch: int = 32
    miss: float = 1e-6
    seed: int = 20240

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def floors(self) -> tuple[int, ...]:
        t = self.percent / 100
        return least_matches(self.hashes, self.batch, t + (1 - t) / 256, self.miss)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in row order."""
    for first, last, data, off in text_slices(column):
        low = LOWER[data]
        start, end, word_off = words(low, off, NOT_BLANK)
        values, cut = shingles(span_hash(low, start, end), word_off, k)
        for i in range(last - first):
            yield np.unique(values[cut[i] : cut[i + 1]])


def _sign(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        size, fp = np.zeros(n, np.int64), np.zeros((n, 2), np.int64)
        sig, keys = [], []
        for i, values in enumerate(shingle_sets(batch.column("text"), s.shingle)):
            size[i] = len(values)
            if not len(values):
                sig.append(None)
                keys.append(None)
                continue
            with np.errstate(over="ignore"):
                fp[i, 0] = mix(values).sum(dtype=np.uint64).astype(np.int64)
                fp[i, 1] = mix(values ^ np.uint64(0x5BF0363546A9B1D7)).sum(dtype=np.uint64).astype(np.int64)
            full = signature(values, s.hashes, s.seed)
            key = np.arange(s.bands, dtype=np.uint64) + np.uint64(1)
            for column in full.reshape(s.bands, s.rows).T:
                key = mix(key ^ column)
            sig.append((full >> np.uint32(24)).astype(np.uint8).tobytes())
            keys.append(key.astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), pa.array(size), pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            names=["row", "doc_id", "n_shingles", "fp1", "fp2", "sig", "bands"],
        )


_SIGNED = "row long, doc_id long, n_shingles long, fp1 long, fp2 long, sig binary, bands array<long>"


def _survivors(sig: np.ndarray, left: np.ndarray, right: np.ndarray, floors: tuple[int, ...], batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs that no batch pruned, and their match counts."""
    live, count = np.arange(len(left)), np.zeros(len(left), np.int64)
    for i, floor in enumerate(floors):
        part = slice(i * batch, (i + 1) * batch)
        count = count + (sig[left[live], part] == sig[right[live], part]).sum(axis=1)
        stay = count >= floor
        live, count = live[stay], count[stay]
    return live, count


def _first_meeting(keys: np.ndarray, left: np.ndarray, right: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Whether the pairs share no band before ``band``."""
    same = keys[left] == keys[right]
    return same.argmax(axis=1) == band


def _signatures(rows: pa.Table) -> np.ndarray:
    column = rows.column("sig").to_pylist()
    return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)


def _bands(rows: pa.Table, s: Settings) -> np.ndarray:
    return rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, s.bands)


def _pairs(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Surviving pairs of buckets of at most ``SMALL`` nodes; rows arrive sorted by key."""
    floors = s.floors()
    for rows in whole_runs(batches, ["key"]):
        key, band, node = (rows.column(c).to_numpy() for c in ("key", "band", "node"))
        sig, keys = _signatures(rows), _bands(rows, s)
        size = np.diff(np.r_[np.flatnonzero(np.r_[True, key[1:] != key[:-1]]), len(key)])
        for lag in range(1, int(size.max())):
            left = np.flatnonzero((key[:-lag] == key[lag:]) & (node[:-lag] != node[lag:]))
            left = left[_first_meeting(keys, left, left + lag, band[left])]
            live, _ = _survivors(sig, left, left + lag, floors, s.batch)
            if len(live):
                a, b = node[left[live]], node[left[live] + lag]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Intersection sizes of pairs of sorted sets."""
    size = np.array([len(x) for x in sets])
    _, rank = np.unique(np.concatenate(sets), return_inverse=True)
    wide = np.int64(rank.max() + 1)
    at = np.concatenate([[0], np.cumsum(size)])
    held = np.repeat(np.arange(len(sets)), size) * wide + rank  # ascending, for the sets are sorted
    out = np.zeros(len(left), np.int64)
    step = max(1, (1 << 20) // int(size.max()))
    for k in range(0, len(left), step):
        x, y = left[k : k + step], right[k : k + step]
        n = size[x]
        cut = np.cumsum(n) - n
        want = rank[np.repeat(at[x], n) + np.arange(n.sum()) - np.repeat(cut, n)] + np.repeat(y, n) * wide
        found = held[np.minimum(np.searchsorted(held, want), len(held) - 1)] == want
        out[k : k + step] = np.add.reduceat(found, cut)
    return out


def _stars(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Verified links of large buckets: each node of a group's component and its smallest
    node. Rows arrive sorted by (key, i, j)."""
    floors = s.floors()
    for rows in whole_runs(batches, ["key", "i", "j"]):
        key, i, j, side, band, node = (rows.column(c).to_numpy() for c in ("key", "i", "j", "side", "band", "node"))
        start = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        for a, b in zip(start, np.r_[start[1:], len(key)], strict=True):
            part = rows.slice(a, b - a)
            sig, keys = _signatures(part), _bands(part, s)
            first = np.flatnonzero(side[a:b] == 0)
            second = first if i[a] == j[a] else np.flatnonzero(side[a:b] == 1)
            if not len(first) or not len(second):  # a block without a node holds no pair
                continue
            got = []
            for k in range(0, len(first), 16):
                left, right = np.repeat(first[k : k + 16], len(second)), np.tile(second, len(first[k : k + 16]))
                fit = (left < right) if i[a] == j[a] else np.ones(len(left), bool)
                left, right = left[fit], right[fit]
                live, _ = _survivors(sig, left, right, floors, s.batch)
                left, right = left[live], right[live]
                fresh = _first_meeting(keys, left, right, np.full(len(left), band[a]))
                got.append((left[fresh], right[fresh]))
            left, right = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in zip(*got, strict=True))
            if not len(left):
                continue
            sets = [np.frombuffer(x, np.uint64) for x in part.column("set").to_pylist()]
            size = np.array([len(x) for x in sets])
            fit = 100 * np.minimum(size[left], size[right]) >= s.percent * np.maximum(size[left], size[right])
            left, right = left[fit], right[fit]
            common = _common(sets, left, right) if len(left) else np.zeros(0, np.int64)
            linked = 100 * common >= s.percent * (size[left] + size[right] - common)
            left, right = left[linked], right[linked]
            label = node[a:b].copy()
            while len(left):  # the smallest node among linked ones, until nothing changes
                low = label.copy()
                np.minimum.at(low, left, label[right])
                np.minimum.at(low, right, label[left])
                if (low == label).all():
                    break
                label = low
            moved = label != node[a:b]
            yield pa.RecordBatch.from_arrays([pa.array(node[a:b][moved]), pa.array(label[moved])], names=["a", "b"])


def _dealt(members: DataFrame, s: Settings) -> DataFrame:
    """A row for each block pair (i, j) of its bucket that a member belongs to."""
    own = F.pmod(F.xxhash64("node", F.lit(s.seed)), F.col("blocks"))
    out = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    out = out.select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"), "band", "node", "sig", "bands", "set",
    )
    return out.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [x.tobytes() for x in shingle_sets(batch.column("text"), k)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.large_binary()).cast(pa.binary())], names=["node", "set"])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = np.zeros(batch.num_rows, bool)
        for r, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                common = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                ok[r] = 100 * common >= percent * (len(x) + len(y) - common)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(ok)), batch.column("b").filter(pa.array(ok))], names=["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame, s: Settings) -> DataFrame:
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(tidy(partial(_confirm, percent=s.percent)), "a long, b long")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, settings: Settings | None = None, keyed: bool = False) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for each row of ``docs``.

    Only ``doc_id`` and ``text`` are read; other columns never matter. A null, empty or
    blank text has an empty set and links with nothing. A row without an id takes no part
    and returns with a null component, kept. Rows that repeat an id are grouped each by its own
    text. An empty table gives an empty result. ``keyed`` says that ``docs`` is a written table
    whose ids are all different and not null, which then need not be written again.
    """
    s = settings or Settings()
    prepare(spark)
    # nodes are named by a row of theirs: ids may repeat under different texts
    row = F.col("doc_id").cast("long") if keyed else F.monotonically_increasing_id()
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not keyed:
        rows = materialize(spark, rows, "minhash-rows")
    signed = materialize(spark, rows.mapInArrow(tidy(partial(_sign, s=s)), _SIGNED), "minhash-signed")
    linkable = signed.where("n_shingles > 0 and doc_id is not null")
    nodes = materialize(spark, linkable.groupBy("fp1", "fp2", "n_shingles").agg(F.min("row").alias("node"), F.min("doc_id").alias("id")), "minhash-nodes")
    first = nodes.select("node").join(linkable.withColumnRenamed("row", "node"), "node")
    first = materialize(spark, first.select("node", "n_shingles", "sig", "bands"), "minhash-first")
    in_band = first.select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    size = in_band.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"), F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi")
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("weight") / BLOCK_SHINGLES)).cast("long")
    members = materialize(spark, in_band.join(size.select("key", "n", blocks.alias("blocks")), "key").drop("n_shingles"), "minhash-members")
    signatures = first.select("node", "sig", "bands")  # travels only for members of shared buckets
    small = members.where(F.col("n") <= SMALL).join(signatures, "node").select("key", "band", "node", "sig", "bands").repartition("key").sortWithinPartitions("key")
    pairs = materialize(spark, small.mapInArrow(tidy(partial(_pairs, s=s)), "a long, b long").distinct(), "minhash-pairs")
    large = members.where(F.col("n") > SMALL)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(large.select("node")).distinct()
    texts = rows.withColumnRenamed("row", "node").join(wanted, "node", "left_semi").select("node", "text")
    sets = materialize(spark, texts.mapInArrow(tidy(partial(_sets, k=s.shingle)), "node long, set binary").where("length(set) > 0"), "minhash-sets")
    stars = _dealt(large.join(signatures, "node").join(sets, "node"), s).mapInArrow(tidy(partial(_stars, s=s)), "a long, b long")
    links = materialize(spark, _verified(pairs, sets, s).unionByName(stars), "minhash-links")
    comps = materialize(spark, connected_components(spark, links), "minhash-components")

    found = nodes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = found.groupBy("component").agg(F.min("id").alias("least"))
    named = found.join(least, "component").select("fp1", "fp2", F.col("n_shingles").alias("size"), F.col("least").alias("component"))
    signed_rows = signed.where("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "fp1", "fp2")
    joined = signed_rows.join(named, (signed_rows.fp1 == named.fp1) & (signed_rows.fp2 == named.fp2) & (signed_rows.n_shingles == named["size"]))
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    out = joined.select("doc_id", "n_shingles", "component").unionByName(alone)
    return out.select("doc_id", "n_shingles", F.col("component").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"))
