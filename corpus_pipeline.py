"""A training corpus from raw documents, in five stages.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)`` and returns
what the next one gets as ``docs``. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm import decontam, language, near_dedup, packing, toxicity
from obsflow.llm.queries import TOKENIZER, learnable, table
from obsflow.session import materialize

#: Five-word shingles at a similarity of 0.8; 36 bands of 7 miss a pair there with probability 2e-4.
NEAR = near_dedup.Settings(shingle=5, percent=80, bands=36, rows=7)


ROW = "_row_key"


def _keyed(spark: SparkSession, docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a key of its own for each row, written, so that the keys stay as they are."""
    return materialize(spark, docs.withColumn(ROW, F.monotonically_increasing_id()), f"keyed-{name}")


def _texts(keyed: DataFrame) -> DataFrame:
    """The texts under their row keys: ids may be null or repeat, keys may not."""
    return keyed.select(F.col(ROW).alias("doc_id"), "text")


def _without(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key is not among ``keys(doc_id)``, without the key."""
    return keyed.join(keys.withColumnRenamed("doc_id", ROW), ROW, "left_anti").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine rejects go."""
    model = toxicity.fit(spark, docs, table(spark, sf_dir, "labels").where(learnable(5, 0)))
    return toxicity.clean(spark, docs, model)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no learned language go (and null texts and texts without a letter): those near
    no language by their margins and explained less than learnable texts of their length.
    Ids may be null or repeat, rows are decided one by one; an empty table stays empty."""
    learn = docs.where(learnable(5, 0))
    model = language.fit(spark, learn)
    return language.known(spark, docs, model, language.calibrate(spark, learn, model))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, one of the smallest id (null last)."""
    keyed = _keyed(spark, docs, "near-duplicates")
    groups = near_dedup.near_duplicate_groups(spark, _texts(keyed), NEAR, keyed=True).select("doc_id", "component_id")
    groups = materialize(spark, groups.join(keyed.select(F.col(ROW).alias("doc_id"), F.col("doc_id").alias("id")), "doc_id"), "groups")
    first = F.min(F.struct(F.col("id").isNull(), "id", "doc_id")).getField("doc_id").alias("first")
    kept = groups.groupBy("component_id").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
    rest = groups.select("doc_id", "component_id").join(kept, "component_id").where("doc_id <> first")
    return _without(keyed, rest.select("doc_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a ten-word window of a benchmark item go."""
    keyed = _keyed(spark, docs, "contamination")
    found = decontam.contamination(spark, _texts(keyed), table(spark, sf_dir, "benchmark"))
    return _without(keyed, found.where("contaminated").select("doc_id"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048 ids, a row for each piece of a document."""
    pieces = packing.pack(spark, docs, public_tokenizers.path(TOKENIZER))
    return pieces.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", F.crc32("ids").alias("ids_crc32"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL can express neither the fitted models nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
