"""Mixing sources to target weights. DataFrame functions only.

Every document's words lie in its source's stream, in an order drawn from the document ids;
a stream is cut into blocks of ``block`` words. A source's target becomes a number of draws,
each worth a block of its own. An output shard has ``shard`` slots, and the counts of the
sources in a shard are a multinomial draw on condition that all shards together meet every
source's number of draws: all draws are put in order and a pseudorandom permutation deals
them to the slots. (Independent draws would miss the targets of small sources and could
exceed the repeat limit.) The j-th draw of a source of n blocks takes the block that the
source's permutation of pass ``j / n`` gives for ``j % n``, so within a pass no block is
taken twice, and no pass is begun beyond the limit. Slots and blocks are then joined by
(source, block index).

A permutation of 0..n-1 is a Feistel network over an a x b grid with a * b >= n; places
outside 0..n-1, fewer than 2 * a, are walked until inside. ``WALK`` steps are always enough
up to n = 256, and beyond it they fail with a chance below 2^-96.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.order import ordered, running_totals
from obsflow.operators.joins import bounded_broadcast
from obsflow.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WALK = 32
_CHUNK = 1 << 14
_TASK, _TASKS = 1 << 18, 20_000  # draws made in a task, tasks at most
_ROUNDS = 4


@dataclass(frozen=True)
class Settings:
    block: int = 32
    shard: int = 4096
    #: Weights of the sources by rank, repeating; no word is taken more than ``repeats`` times.
    weights: tuple[int, ...] = (1, 2, 3)
    repeats: int = 3
    seed: int = 1313


class Mix(NamedTuple):
    #: rank, source, size, weight, target, n_blocks, draws; a row a source
    sources: DataFrame
    #: shard, slot, rank, pass, block; a row a slot
    slots: DataFrame
    #: key, rank, block, begin, length: where and how many words of row ``key`` lie in a block
    pieces: DataFrame
    #: key, doc_id, rank, size (and text, if asked for); a row for each row of the documents
    rows: DataFrame


def permuted(x: Column, n: Column, *seed: Column) -> Column:
    """The place of ``x`` in a pseudorandom permutation of 0..n-1 named by ``seed``."""
    a = F.greatest(F.ceil(F.sqrt(n.cast("double"))), F.lit(1)).cast("long")
    b = F.ceil(n / a).cast("long") + 1  # one to spare for the roundings above

    def once(at: Column) -> Column:
        left, right = F.floor(at / b).cast("long"), F.pmod(at, b)
        for i in range(0, _ROUNDS, 2):
            left = F.pmod(left + F.pmod(F.xxhash64(F.lit(i), *seed, right), a), a)
            right = F.pmod(right + F.pmod(F.xxhash64(F.lit(i + 1), *seed, left), b), b)
        return left * b + right

    first = once(x)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first, lambda at, _: F.when(at < n, at).otherwise(once(at)))
    return F.when(first < n, first).otherwise(walked)


def _sources(spark: SparkSession, rows: DataFrame, s: Settings) -> DataFrame:
    """A row a source: rank, the words before its stream, weight, target, blocks and draws."""
    by = rows.groupBy("source").agg(F.sum("size").alias("size")).withColumn("one", F.lit(1).cast("long"))
    placed = ordered(spark, by, [F.col("source").isNull(), F.col("source")], "sources")
    weight = F.element_at(F.array(*map(F.lit, s.weights)), (F.col("rank") % len(s.weights) + 1).cast("int")).cast("long")
    ranked = running_totals(spark, placed, {"one": "rank", "size": "before"}).withColumn("weight", weight)
    ranked = ranked.select("source", "size", "rank", "before", "weight", (s.repeats * F.col("size")).alias("most"))

    # every source gets `level` words a unit of weight, but no more than its most; going up
    # by most / weight, the sources that stop are those below the level of what is left
    line = ordered(spark, ranked.withColumn("ratio", F.col("most") / F.col("weight")), [F.col("ratio"), F.col("rank")], "levels")
    total, weights = line.agg(F.sum("size"), F.sum("weight")).first()
    line = running_totals(spark, line, {"most": "stopped", "weight": "stopped_weight"})
    level = (F.lit(total or 0) - F.col("stopped")) / (F.lit(weights or 0) - F.col("stopped_weight"))
    (level,) = line.select("pos", "ratio", level.alias("level")).where("level <= ratio").agg(F.min_by("level", "pos")).first()
    share = F.lit(level if level is not None else float("inf")) * F.col("weight")
    target = F.least(share, F.col("most").cast("double")).alias("target")
    n_blocks = F.ceil(F.col("size") / s.block).cast("long").alias("n_blocks")
    planned = line.select("source", "size", "rank", "before", "weight", target, n_blocks)
    # a draw is worth size / n_blocks words, as the last block of a stream may be short
    draws = F.coalesce(F.round(F.try_divide(F.col("target") * F.col("n_blocks"), F.col("size"))), F.lit(0.0)).cast("long")
    planned = planned.withColumn("draws", F.least(draws, s.repeats * F.col("n_blocks")))
    placed = ordered(spark, planned, [F.col("rank")], "targets")
    return materialize(spark, running_totals(spark, placed, {"draws": "first_draw"}).drop("pos"), "plan")


def _slots(sources: DataFrame, s: Settings) -> DataFrame:
    n_draws = sources.agg(F.coalesce(F.sum("draws"), F.lit(0))).first()[0]
    some = sources.where("draws > 0").select("rank", "n_blocks", "draws", "first_draw")
    chunks = some.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(draws - 1) div {_CHUNK}"))))
    # a source of any size is spread over tasks; the number is given, as the chunks' rows are few and small
    chunks = chunks.repartition(min(ceil(n_draws / _TASK) + 1, _TASKS), "rank", "chunk")
    j = F.explode(F.sequence(F.col("chunk") * _CHUNK, F.least("draws", (F.col("chunk") + 1) * _CHUNK) - 1))
    drawn = chunks.select("rank", "n_blocks", "first_draw", j.alias("j")).withColumn("pass", F.expr("j div n_blocks"))
    place = permuted(F.col("first_draw") + F.col("j"), F.lit(n_draws).cast("long"), F.lit(s.seed))
    block = permuted(F.pmod("j", "n_blocks"), F.col("n_blocks"), F.lit(s.seed), F.col("rank"), F.col("pass"))
    dealt = drawn.select("rank", "pass", block.alias("block"), place.alias("place"))
    return dealt.select(F.expr(f"place div {s.shard}").alias("shard"), F.pmod("place", F.lit(s.shard)).alias("slot"), "rank", "pass", "block")


def mix(spark: SparkSession, docs: DataFrame, settings: Settings | None = None, texts: bool = False) -> Mix:
    """The plan of a mixture of ``docs(doc_id, source, text)``.

    Together the sources give as many words as they hold. Ranked by code point (null last) they
    weigh ``weights`` in turn; no target exceeds ``repeats`` times the source's words, and
    what is left over goes to the others by weight. A null or empty text has no words and takes
    no part in a block. Rows that repeat an id are rows of their own; ids decide only the
    order of a stream, so a rerun mixes alike however the table is split. Documents of any
    length run over as many blocks as they need. Other columns are not read; an empty table, or
    one without words, gives no slots.
    """
    s = settings or Settings()
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    rows = materialize(spark, rows.select("key", "doc_id", "source", size, *(["text"] if texts else [])), "sized")
    sources = _sources(spark, rows, s)
    known = sources.select(F.col("source").alias("of"), "rank", "before")
    rows = rows.join(bounded_broadcast(known), F.col("source").eqNullSafe(F.col("of"))).drop("of", "source")
    stream = [F.col("rank"), F.xxhash64(F.lit(s.seed), "doc_id"), F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("key")]
    placed = ordered(spark, rows.select("key", "doc_id", "rank", "before", "size"), stream, "streams")
    begun = running_totals(spark, placed, {"size": "begin"}).where("size > 0").select("key", "rank", "size", (F.col("begin") - F.col("before")).alias("start"))
    ends = begun.withColumn("end", F.col("start") + F.col("size"))
    cut = ends.withColumn("block", F.explode(F.sequence(F.expr(f"start div {s.block}"), F.expr(f"(end - 1) div {s.block}"))))
    left, right = F.greatest("start", F.col("block") * s.block), F.least("end", (F.col("block") + 1) * s.block)
    pieces = cut.select("key", "rank", "block", (left - F.col("block") * s.block).alias("begin"), (right - left).alias("length"))
    return Mix(sources.drop("before", "first_draw"), _slots(sources, s), pieces, rows.drop("before"))


def taken(mixed: Mix) -> DataFrame:
    """``(key, taken)``: the words that the mixture takes of each row, repeats counted; rows
    that it leaves out are not listed."""
    uses = mixed.slots.groupBy("rank", "block").agg(F.count(F.lit(1)).alias("uses"))
    # both sides are far larger than the tables they are made from, so Spark's guess of their size would broadcast them
    met = mixed.pieces.hint("merge").join(uses, ["rank", "block"])
    return met.groupBy("key").agg(F.sum(F.col("length") * F.col("uses")).alias("taken"))


def shard_counts(mixed: Mix) -> DataFrame:
    """``(shard, rank, n)``: the number of slots that each source holds in each shard."""
    return mixed.slots.groupBy("shard", "rank").agg(F.count(F.lit(1)).alias("n"))


def mixed_blocks(spark: SparkSession, docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``(shard, slot, source, block, pass, text)``: the mixture itself, a row a slot, the words of
    its block in stream order, joined by spaces."""
    s = settings or Settings()
    mixed = mix(spark, docs, s, texts=True)
    spans = mixed.pieces.groupBy("key", "rank").agg(F.min("block").alias("first"), F.min(F.struct("block", "begin"))["begin"].alias("begin"))
    words = mixed.rows.select("key", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    # the first piece fills its block from `begin` on, every later one from the block's start
    head = s.block - F.col("begin")
    parts = F.transform(
        F.sequence(F.lit(0), F.ceil(F.greatest(F.size("words") - head, F.lit(0)) / s.block).cast("int")),
        lambda i: F.struct(
            (F.col("first") + i).alias("block"), F.when(i == 0, F.col("begin")).otherwise(0).alias("begin"),
            F.when(i == 0, F.slice("words", 1, head.cast("int"))).otherwise(F.slice("words", (head + (i - 1) * s.block + 1).cast("int"), s.block)).alias("words"),
        ),
    )
    cut = spans.hint("merge").join(words, "key").select("rank", F.inline(parts))
    blocks = cut.groupBy("rank", "block").agg(F.array_sort(F.collect_list(F.struct("begin", "words"))).alias("parts"))  # at most `block` words
    blocks = blocks.select("rank", "block", F.array_join(F.flatten("parts.words"), " ").alias("text"))
    named = mixed.slots.join(bounded_broadcast(mixed.sources.select("rank", "source")), "rank")
    return named.hint("merge").join(blocks, ["rank", "block"]).select("shard", "slot", "source", "block", "pass", "text")
