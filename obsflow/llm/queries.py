"""The registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm import chat, conversation_repair, dac, decontam, hard_negatives, language, lattice, license_scan, lm_scoring, mixing, near_dedup, packing, toxicity
from obsflow.operators.joins import bounded_broadcast
from obsflow.session import materialize, scratch_dir

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int, key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def learnable(n: int, held: int) -> Column:
    """Rows that may be learned from; a row without an id may not."""
    return F.coalesce(remainder(n) != held, F.lit(False))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicate_groups(spark, table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(spark, docs, labels.where(learnable(5, 0)))
    scored = toxicity.score(spark, docs, model)
    return scored.select("doc_id", (~learnable(5, 0)).alias("held_out"), "score", "predicted")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(spark, docs.where(learnable(5, 0)))
    found = language.predict(spark, docs, model)
    return found.select("doc_id", (~learnable(5, 0)).alias("held_out"), "lang_pred", "score")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(spark, table(spark, sf_dir, "documents"), license_scan.template_table(spark))
    return found.select("doc_id", "license_id", "n_shared", "n_template", "containment")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicate_vectors(spark, table(spark, sf_dir, "embeddings"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm_scoring.score_texts(spark, docs, docs.where(learnable(7, 2)))
    return scored.select("doc_id", (~learnable(7, 2)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-store")
    dac.write_store(spark, table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return dac.read_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    formatted = materialize(spark, chat.format_conversations(spark, turns.unionByName(extra)), "chat")
    return chat.digest(spark, formatted)


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults dealt by a checksum of conversation and turn."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fate = F.crc32(name.cast("binary")) % 20
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).where("fate <> 0")
    hurt = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.explode(F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), hurt.alias("text"), times.alias("time")).drop("time")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(spark, damaged(turns))
    hashes = conversation_repair.digests(spark, repaired.rows).withColumnRenamed("conv_id", "h")
    told = repaired.conversations.withColumnRenamed("conv_id", "t")
    every = turns.select("conv_id").distinct()
    every = every.join(told, F.col("conv_id").eqNullSafe(F.col("t")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("h")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(spark, rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(spark, table(spark, sf_dir, "documents"))
    sources = mixed.sources.select("rank", F.col("size").alias("source_size"), "target")
    rows = mixed.rows.join(bounded_broadcast(sources), "rank").hint("merge").join(mixing.taken(mixed), "key", "left")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash_near_dedup,
        op2_toxicity,
        op3_language_id,
        op4_license_scan,
        op5_packing,
        op6_embedding_near_dedup,
        op7_lm_scoring,
        op8_benchmark_decontamination,
        op9_token_ids,
        op10_chat_format,
        op11_conversation_repair,
        op12_hard_negatives,
        op13_source_mixing,
        pipeline,
    )
}
