"""License scan: MinHash bands over overlapping windows retrieve templates,
exact shingle containment verifies them. DataFrame functions only.

Texts and templates are lower-cased, everything but letters and digits is white
space, and five words in a row are a shingle (its hash stands for it). A
template of ``m`` different shingles looks at windows of ``2 m`` shingles, one
every ``m``, so every place a template can stand is inside a window. A window
that holds a share ``c`` of the template has Jaccard ``c / (3 - c)`` at least
with it, and ``bands`` one-value bands are as many as let such a window collide
with probability ``recall``.

A window's band value can equal a template's only if the window holds the very
shingle that gives the template its minimum. So the scan first looks for those
few shingles, and computes signatures for the windows around them alone: the
collisions found are the same as those of all windows. A window that collides in
a band is verified: the share of the template's shingles that it holds, exactly,
must reach ``containment``.

Templates are a parameter, at most ``MAX_TEMPLATES`` of them; their signatures
are what is broadcast. Nothing but the matches found is shuffled.

Cases: null and empty texts, and those under five words, match nothing.
Rows equal in id are one document, null ids too. A template needs five words;
null or shorter ones raise. A text that holds a template several times names it once, with
its best containment and first place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

CONTAINMENT = 0.8
RECALL = 0.9999
MAX_TEMPLATES = 2000
SHINGLE = 5

# Notices as authors put them into their files, by license id.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "you may not use this file except in compliance with the License. You may obtain a copy of the License at"],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.",
                "under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def template_table(spark: SparkSession, templates: dict[str, list[str]] | None = None) -> DataFrame:
    rows = [(name, n, text) for name, texts in sorted((templates or TEMPLATES).items()) for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "license string, variant int, text string")


def bands_needed(containment: float, recall: float) -> int:
    """One-value bands for windows of twice the template's shingles."""
    return math.ceil(math.log(1 - recall) / math.log(1 - containment / (3 - containment)))


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is evaluated once a row. Filters on it would
    otherwise be pushed below and its expression repeated inside the lambdas
    that use it, once an element."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _words(text: Column) -> Column:
    """Words in order; split leaves an empty one where a text starts or ends with a mark."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingles(words: Column) -> Column:
    """Hashes of the shingles in order; empty below five words."""
    n = F.size(words) - SHINGLE + 1
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))


def _band(shingles: Column, band: int) -> Column:
    """The shingle that is smallest in the order of one band."""
    least = F.array_min(F.transform(shingles, lambda s: F.struct(F.xxhash64(s, F.lit(band)).alias("r"), s.alias("s"))))
    return least["s"]


def scan(docs: DataFrame, templates: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text",
         containment: float = CONTAINMENT, recall: float = RECALL) -> DataFrame:
    """One row a document and license found: ``_id, license, containment,
    shingle`` (where its window starts, in words)."""
    spark = docs.sparkSession
    bands = bands_needed(containment, recall)
    known = (templates if templates is not None else template_table(spark))
    known = known.select("license", "variant", F.array_distinct(_shingles(_words(F.col("text")))).alias("t"))
    known = known.withColumn("sig", F.array(*[_band(F.col("t"), b) for b in range(bands)])).limit(MAX_TEMPLATES + 1)
    rows = known.collect()  # the parameter itself, with signatures
    if len(rows) > MAX_TEMPLATES or any(not r["t"] for r in rows):
        raise ValueError(f"a license scan takes up to {MAX_TEMPLATES} templates of {SHINGLE} words or more")
    table = spark.createDataFrame([(r["license"], r["variant"], r["t"], r["sig"], len(r["t"])) for r in rows],
                                  "license string, variant int, t array<long>, sig array<long>, m int")
    wanted = sorted({s for r in rows for s in r["sig"]})
    reach = 2 * max((len(r["t"]) for r in rows), default=1)
    text = _once(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")), "w", _words(F.col("_t"))).drop("_t")
    text = _once(text, "s", _shingles(F.col("w"))).drop("w")
    # places whose shingle is one of the signatures
    places = F.transform("s", lambda h, i: F.when(h.isin(wanted), i).otherwise(F.lit(-1)))
    near = _once(text, "hits", F.array_remove(places, -1)).where(F.size("hits") > 0)
    # around a hit, no more of the text than windows can take
    cut = near.select("_id", F.explode(F.transform("hits", lambda i: F.struct(
        F.get("s", i).alias("h"), i.alias("i"), F.greatest(i - reach, F.lit(0)).alias("from"),
        F.slice("s", F.greatest(i - reach, F.lit(0)) + 1, F.lit(2 * reach + 1)).alias("part")))).alias("x")).select("_id", "x.*")
    by_shingle = table.select("*", F.explode(F.array_distinct("sig")).alias("h"))
    pairs = cut.join(F.broadcast(by_shingle), "h")  # one row a signature value of the templates
    start = F.explode(F.array(F.floor(F.col("i") / F.col("m")) * F.col("m"), (F.floor(F.col("i") / F.col("m")) - 1) * F.col("m")))
    window = (pairs.withColumn("start", start).withColumn("start", F.col("start").cast("int")).where("start >= 0")
              .where(F.col("start") >= F.col("from")))
    window = _once(window, "win", F.slice("part", F.col("start") - F.col("from") + 1, F.col("m") * 2))
    collides = F.lit(False)
    for b in range(bands):
        collides = collides | ((F.get("sig", F.lit(b)) == F.col("h")) & (_band(F.col("win"), b) == F.col("h")))
    share = F.size(F.array_intersect("t", "win")) / F.col("m")
    found = window.where(collides).withColumn("containment", share).where(F.col("containment") >= containment)
    return (found.groupBy("_id", "license").agg(F.max("containment").alias("containment"), F.min("start").alias("shingle")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir)).withColumnRenamed("_id", "doc_id")
