"""Benchmark decontamination with a positional inverted index sharded by document.

**Index.** Each training document becomes one row: its distinct terms (64-bit word hashes,
ascending), and for each the ascending list of its word positions. Only terms of the
benchmark are stored; they are told by a bitmap of fixed size (2**24 bits), so what is
broadcast never grows, and a false positive only stores a term that no query asks for.

**Search.** Benchmark windows are taken in blocks of about ``BLOCK`` at a time, so their
broadcast is bounded too. The terms of a window are ordered by their count in the whole
index, rarest first. In each shard the rarest term's positions, less its offset in the
window, are the candidate starts; these are intersected with the offset-adjusted lists of
the next terms in turn. What is left are exact occurrences of the phrase. With
``slop`` set, places where every term of a window has a posting within ``slop`` words of
the window's span around the rarest term are returned too, as ``proximity``.

Nothing is dealt by term, so frequent terms and passages that many documents share make
no hot partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.llm.arrow import prepare, tidy
from obsflow.llm.textops import ALNUM, LOWER, span_hash, text_slices, words
from obsflow.session import materialize

BLOCK = 200_000
_BITS = 24


def _word_hashes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, _, data, off in text_slices(column):
        low = LOWER[data]
        start, end, word_off = words(low, off, ALNUM)
        yield span_hash(low, start, end), word_off


def _windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        item, terms = [], []
        ids, at = batch.column("item_id").to_pylist(), 0
        for hashes, off in _word_hashes(batch.column("text")):
            hashes = hashes.astype(np.int64)
            for a, b in zip(off[:-1], off[1:], strict=True):
                for k in range(a, max(a + (b > a), b - size + 1)):
                    item.append(ids[at])
                    terms.append(hashes[k : min(k + size, b)])
                at += 1
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(terms, pa.list_(pa.int64()))], names=["item_id", "terms"])


def item_windows(benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``(item_id, terms)``: every run of ``size`` words of each item, or all words of a
    shorter one. Items without id or words give none; repeated windows are given once."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null")
    return items.mapInArrow(tidy(partial(_windows, size=size)), "item_id long, terms array<long>").distinct()


def _bitmap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << _BITS, bool)
    for batch in batches:
        for terms in batch.column("terms"):
            bits[(np.asarray(terms.values).astype(np.uint64) >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    at = np.unique(np.flatnonzero(bits))
    yield pa.RecordBatch.from_arrays([pa.array(at)], names=["bit"])


def _index(batches: Iterator[pa.RecordBatch], bitmap) -> Iterator[pa.RecordBatch]:
    bits = np.unpackbits(np.frombuffer(bitmap.value, np.uint8)).astype(bool)
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        n_words, terms, ends, places = [], [], [], []
        for hashes, off in _word_hashes(batch.column("text")):
            stored = bits[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)]
            for a, b in zip(off[:-1], off[1:], strict=True):
                at = np.flatnonzero(stored[a:b]).astype(np.int32)
                own = hashes[a:b][at]
                order = np.argsort(own, kind="stable")
                own = own[order]
                last = np.flatnonzero(np.r_[own[1:] != own[:-1], True]) if len(own) else np.zeros(0, np.int64)
                n_words.append(b - a)
                terms.append(own[last].tobytes())
                ends.append((last + 1).astype(np.int32).tobytes())
                places.append(at[order].tobytes())
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(row + np.arange(n)), batch.column("doc_id"), pa.array(n_words, pa.int64()), *(pa.array(x, pa.binary()) for x in (terms, ends, places))],
            names=["row", "doc_id", "n_words", "terms", "ends", "places"],
        )
        row += n


_INDEXED = "row long, doc_id long, n_words long, terms binary, ends binary, places binary"


def build_index(spark: SparkSession, docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Write the positional index of ``docs(doc_id, text)`` for the terms of ``windows`` to
    the shared scratch folder and return it, one row for each row of ``docs``."""
    prepare(spark)
    found = windows.select("terms").mapInArrow(tidy(_bitmap), "bit long").distinct().toArrow().column("bit").to_numpy()  # at most 2**24
    bits = np.zeros(1 << _BITS, bool)
    bits[found] = True
    bitmap = spark.sparkContext.broadcast(np.packbits(bits).tobytes())
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(spark, texts.mapInArrow(tidy(partial(_index, bitmap=bitmap)), _INDEXED), "postings")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int64)
        ends = [np.frombuffer(x, np.int32) for x in batch.column("ends").to_pylist()]
        counts = np.concatenate([np.diff(x, prepend=0) for x in ends]) if ends else np.zeros(0, np.int32)
        term, back = np.unique(terms, return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.bincount(back, counts, len(term)).astype(np.int64))], names=["term", "n"])


def _intersect(batches: Iterator[pa.RecordBatch], shared, slop: int | None) -> Iterator[pa.RecordBatch]:
    items, terms, sizes, order = shared.value
    width = terms.shape[1]
    for batch in batches:
        if not batch.num_rows:
            continue
        n_words = batch.column("n_words").to_numpy()
        base = np.concatenate([[0], np.cumsum(n_words + 2 * width + (slop or 0))])
        own = [np.frombuffer(x, np.int64) for x in batch.column("terms").to_pylist()]
        ends = [np.frombuffer(x, np.int32) for x in batch.column("ends").to_pylist()]
        places = [np.frombuffer(x, np.int32) for x in batch.column("places").to_pylist()]
        times = np.concatenate([np.diff(x, prepend=0) for x in ends])
        held, at = np.unique(np.concatenate(own), return_inverse=True)
        term = np.repeat(at, times)
        place = np.concatenate(places) + np.repeat(base[:-1], [len(x) for x in places])
        posting = np.sort((term.astype(np.int64) << 40) | place)  # the lists of all terms, one after the other
        if not len(held):
            continue
        # windows all of whose terms have a list in this shard
        slot = np.minimum(np.searchsorted(held, terms), len(held) - 1)
        real = np.arange(width)[None, :] < sizes[:, None]
        window = np.flatnonzero(((held[slot] == terms) | ~real).all(axis=1))
        if not len(window):
            continue
        rank, slot, size = order[window], slot[window].astype(np.int64), sizes[window]

        def bounds(tid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return np.searchsorted(posting, tid << 40), np.searchsorted(posting, (tid + 1) << 40)

        rarest = rank[:, 0]
        low, high = bounds(slot[np.arange(len(window)), rarest])
        count = high - low
        w = np.repeat(np.arange(len(window)), count)
        anchor = posting[np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)] & ((1 << 40) - 1)
        phrase_w, start = w, anchor - rarest[w]
        for k in range(1, width):
            if not len(phrase_w):
                break
            offset = rank[phrase_w, k]
            need = k < size[phrase_w]
            want = (slot[phrase_w, offset] << 40) | np.maximum(start + offset, 0)
            hit = posting[np.minimum(np.searchsorted(posting, want), len(posting) - 1)] == want
            stay = (hit | ~need) & (start >= 0)
            phrase_w, start = phrase_w[stay], start[stay]
        parts = [(phrase_w, start, np.zeros(len(start), bool))]
        if slop is not None and len(w):
            near = np.ones(len(w), bool)
            reach = size[w] - 1 + slop
            for k in range(1, width):
                tid = slot[w, rank[w, k]]
                lo = np.searchsorted(posting, (tid << 40) | np.maximum(anchor - reach, 0))
                hi = np.searchsorted(posting, (tid << 40) | (anchor + reach), "right")
                near &= (hi > lo) | (k >= size[w])
            exact = {(int(a), int(b)) for a, b in zip(phrase_w, start, strict=True)}
            for i in np.flatnonzero(near):
                if (int(w[i]), int(anchor[i] - rarest[w[i]])) in exact:
                    near[i] = False
            parts.append((w[near], anchor[near], np.ones(int(near.sum()), bool)))
        for pw, begin, loose in parts:
            if not len(pw):
                continue
            doc = np.searchsorted(base, begin, "right") - 1
            begin = begin - base[doc]
            end = begin + np.where(loose, 1, size[pw])
            ok = (begin >= 0) & (end <= n_words[doc])
            doc, begin, end, item = doc[ok], begin[ok], end[ok], items[window[pw[ok]]]
            # overlapping occurrences of one item in one document become one run
            by = np.lexsort((begin, item, doc))
            doc, begin, end, item = doc[by], begin[by], end[by], item[by]
            if not len(doc):
                continue
            new = np.r_[True, (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (begin[1:] > end[:-1])]
            head = np.flatnonzero(new)
            stop = np.maximum.reduceat(end, head)
            rows = batch.column("row").to_numpy()[doc[head]]
            kind = pa.array(["proximity" if loose[0] else "phrase"] * len(head))
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(item[head]), pa.array(begin[head]), pa.array(stop), kind], names=["row", "item_id", "start", "end", "kind"])


def search(spark: SparkSession, index: DataFrame, windows: DataFrame, slop: int | None = None) -> DataFrame:
    """``(row, item_id, start, end, kind)``: the runs of word positions of each index row that
    occurrences of an item's windows cover (``phrase``), and with ``slop`` the places of the
    rarest term of a loose occurrence (``proximity``)."""
    windows = materialize(spark, windows, "windows")
    blocks = max(1, -(-windows.count() // BLOCK))
    counts = materialize(spark, index.select("terms", "ends").mapInArrow(tidy(_frequencies), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")), "term-counts")
    parts = []
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == b)
        rows = part.orderBy("item_id", "terms").toArrow()  # a block
        asked = part.select(F.explode("terms").alias("term")).distinct()
        known = counts.join(asked, "term", "left_semi").toArrow()
        term, n = known.column("term").to_numpy(), known.column("n").to_numpy()
        by = np.argsort(term)
        term, n = term[by], n[by]
        lists = [np.asarray(x.values) for x in rows.column("terms").combine_chunks()] if rows.num_rows else []
        sizes = np.array([len(x) for x in lists], np.int64)
        matrix = np.zeros((len(lists), int(sizes.max(initial=1))), np.int64)
        real = np.arange(matrix.shape[1])[None, :] < sizes[:, None]
        if len(lists):
            matrix[real] = np.concatenate(lists)
        at = np.minimum(np.searchsorted(term, matrix), max(len(term) - 1, 0))
        share = np.where(term[at] == matrix, n[at], 0) if len(term) else np.zeros_like(matrix)
        order = np.argsort(np.where(real, share, np.iinfo(np.int64).max), axis=1, kind="stable")
        shared = spark.sparkContext.broadcast((rows.column("item_id").to_numpy(), matrix, sizes, order))
        parts.append(index.mapInArrow(tidy(partial(_intersect, shared=shared, slop=slop)), "row long, item_id long, start long, end long, kind string"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, contaminated)``, one row for each row of
    ``docs``; ``items`` are the ids of items with occurring windows, sorted as strings.

    Only ``doc_id`` and ``text`` of ``docs`` and ``item_id`` and ``text`` of ``benchmark``
    are read. Null and empty texts have no words; ids of documents may be null or repeat;
    repeated items count once; an empty benchmark hits nothing; no documents, no rows.
    """
    prepare(spark)
    windows = materialize(spark, item_windows(benchmark, size), "windows")
    index = build_index(spark, docs, windows)
    runs = materialize(spark, search(spark, index, windows), "hits").where("kind = 'phrase'")
    before = F.max("end").over(Window.partitionBy("row").orderBy("start", "end", "item_id").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    per_row = runs.select("row", "item_id", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"), F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    joined = index.select("row", "doc_id", "n_words").join(per_row, "row", "left")
    hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        "doc_id", "n_words", hit.cast("long").alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), (hit > 0).alias("contaminated"),
    )
