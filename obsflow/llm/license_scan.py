"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle
containment verifies them. DataFrame functions only.

Words are runs of digits, a-z (after lowering A-Z) and non-ASCII characters; shingles are
five words, compared as 64-bit hashes. A template of m shingles is looked for in windows
of m shingles that start at every max(1, m / 4)th shingle, so a copy is covered by a
window to seven eighths at least. Windows and templates have ``bands * rows`` MinHashes.
With 24 bands of 2, a window holding four fifths of a template at the worst alignment
(similarity 0.54) shares a band with it with probability 0.9997.

A window can only share a band with a template if it holds the shingles that give the
template its minima. So texts without any of these are left out by one set lookup a
shingle, and windows are formed only around such shingles; this drops no match.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_TEMPLATES = 10_000

#: Notices that works carry to name their license.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "bsd-clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    bands: int = 24
    rows: int = 2
    containment: float = 0.8


def template_table(spark: SparkSession, templates: dict[str, str] | None = None) -> DataFrame:
    rows = sorted((TEMPLATES if templates is None else templates).items())
    return spark.createDataFrame(rows, "license_id string, text string")


def _shingles(text: Column, k: int) -> Column:
    """The shingle hashes in text order; of fewer words, but not none, one."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")

    def hashes(w: Column) -> Column:
        n = F.size(w)
        return F.slice(F.transform(w, lambda _, i: F.xxhash64(F.slice(w, i + 1, k))), 1, F.greatest(n - (k - 1), F.least(n, F.lit(1))))

    return F.transform(F.array(words), hashes)[0]  # a lambda's argument is computed once


def _minima(values: Column, s: Settings) -> Column:
    """The shingle that is smallest under each hash function."""

    def smallest(i: Column) -> Column:
        return F.array_min(F.transform(values, lambda x: F.struct(F.xxhash64(x, i).alias("h"), x.alias("x"))))["x"]

    return F.transform(F.sequence(F.lit(0), F.lit(s.bands * s.rows - 1)), smallest)


def _bands(values: Column, s: Settings) -> Column:
    """The band keys of a set of shingles."""

    def keys(minima: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(s.bands - 1)), lambda b: F.xxhash64(b, F.slice(minima, b * s.rows + 1, s.rows)))

    return F.transform(F.array(_minima(values, s)), keys)[0]


def scan(spark: SparkSession, docs: DataFrame, templates: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``(doc_id, license_id, n_shared, n_template, containment, first_word)``: a row for each
    document id and template whose distinct shingles the whole text holds to the share
    ``containment`` or more; ``first_word`` is the earliest retrieving window's position.

    Only ``doc_id`` and ``text`` are read. Null and empty texts hold nothing; rows that
    repeat an id are reported once, by their best row; null ids are one id; templates
    without an id or words match nothing; either table may be empty.
    """
    s = settings or Settings()
    marks = templates.where("license_id is not null").select(F.col("license_id").cast("string").alias("license_id"), _shingles(F.col("text").cast("string"), s.shingle).alias("sh"))
    marks = marks.where("size(sh) > 0").select("license_id", F.array_distinct("sh").alias("target"))
    marks = marks.select("license_id", "target", F.size("target").alias("m"), F.array_distinct(_minima(F.col("target"), s)).alias("minima"), _bands(F.col("target"), s).alias("bands"))
    held = marks.limit(MAX_TEMPLATES + 1).collect()
    if len(held) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    kind = spark.createDataFrame([(r["license_id"], list(r["target"]), r["m"], list(r["bands"])) for r in held], "license_id string, target array<long>, m int, bands array<long>")
    sizes = sorted({(x, r["m"]) for r in held for x in r["minima"]})
    telling = sorted({x for x, _ in sizes})
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if not telling:
        return texts.where("false").select("doc_id", F.lit("").alias("license_id"), F.lit(0).cast("long").alias("n_shared"), F.lit(0).cast("long").alias("n_template"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("first_word"))
    found = texts.select("doc_id", _shingles(F.col("text"), s.shingle).alias("sh"))
    # around each telling shingle, the windows of the templates' lengths; the outer form
    # keeps Spark from evaluating the shingles a second time as an inferred filter
    place = F.explode_outer(F.filter(F.transform("sh", lambda x, i: F.struct(x.alias("x"), i.alias("p"))), lambda v: v["x"].isin(telling)))
    lengths = spark.createDataFrame(sizes, "x long, m int")
    hits = found.select("doc_id", "sh", place.alias("hit")).where("hit is not null").select("doc_id", "sh", F.col("hit.x").alias("x"), F.col("hit.p").alias("p")).join(F.broadcast(lengths), "x")
    step = F.greatest(F.lit(1), F.floor(F.col("m") / 4).cast("int"))
    last = F.floor(F.col("p") / step).cast("int")
    lowest = F.greatest(F.lit(0), F.ceil((F.col("p") - F.col("m") + 1) / step).cast("int"))
    windows = hits.select("doc_id", "sh", "m", F.explode(F.sequence(lowest, F.greatest(last, lowest))).alias("turn"), step.alias("step"))
    windows = windows.select("doc_id", "sh", "m", (F.col("turn") * F.col("step")).alias("first_word"))
    window = F.slice("sh", F.col("first_word") + 1, F.col("m"))
    keyed = windows.select("doc_id", "sh", "m", "first_word", F.explode_outer(_bands(window, s)).alias("band"))
    banded = kind.select("license_id", "target", "m", F.explode(F.array_distinct("bands")).alias("band"))
    near = keyed.join(F.broadcast(banded), ["band", "m"])  # at most bands * MAX_TEMPLATES rows
    n_shared, n_template = F.size(F.array_intersect("sh", "target")).cast("long"), F.size("target").cast("long")
    matches = near.select("doc_id", "license_id", "first_word", n_shared.alias("n_shared"), n_template.alias("n_template"))
    matches = matches.where(F.col("n_shared") >= s.containment * F.col("n_template"))
    best = matches.groupBy("doc_id", "license_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_template").alias("n_template"), F.min("first_word").cast("long").alias("first_word"))
    return best.select("doc_id", "license_id", "n_shared", "n_template", (F.col("n_shared") / F.col("n_template")).alias("containment"), "first_word")
