"""Mixing sources to target weights by the cube method.

A source's target is its share of all words by weight, at most ``cap`` times
what it has; what is cut off is shared again by weight among the others
(``targets``). With ratio ``r = target / words``, every document is taken
``floor(r)`` times, and once more with inclusion probability ``r - floor(r)``.
Those fractional probabilities are rounded by the cube method, so that the
number of documents and the number of words of a source stay what they are in
expectation, not only on average:

* *Flight*: three undecided documents at a time, their probabilities move along
  the null space of the two constraints (count, words), by a seeded random
  step, until one of them is 0 or 1. The constraints hold exactly all the way.
  Documents are dealt to chunks by hash, chunks fly in parallel, and the at most
  two undecided ones of each chunk (chunks fly from long to short documents)
  fly again together with those of other chunks, until one chunk a
  source is left.
* *Landing*: the last undecided documents of a source (a dozen kept out of the
  last flight, and the two it leaves) are rounded to the combination closest to
  its words.

Equal documents (same id, source and text) are one unit ``n`` times as large,
so a third of all rows being copies is a row here. A source of any size is as
many chunks as it needs. Random steps are seeded by source and chunk, chunks by
content hash: reruns agree whatever the partitioning.

Cases: a null or empty text has 0 words and no influence on targets; such
documents follow their source's ratio too. A null source is a source of its
own, after all others. A null id is an id like others, and ids of any size are kept as they are. Without any words all targets
are 0 and nothing is taken. An empty table gives an empty result.
"""

from __future__ import annotations

import random
from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_name, n_words, saved, ship, small

CHUNK = 512
EPS = 1e-9
LANDING = 12
COUNT_OFF = 2.5


def targets(per_source: DataFrame, cap: float = 3.0) -> DataFrame:
    """``source, words, weight`` -> with ``target``: ``least(cap * words,
    level * weight)`` with the level at which the targets add up to all words.
    Each round raises the level for the sources below their cap; only two sums
    reach the driver."""
    total = float(per_source.agg(F.sum("words")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        full = F.col("words") * cap <= F.col("weight") * F.lit(level)
        held, weight, n = per_source.agg(
            F.sum(F.when(full, F.col("words") * cap).otherwise(0.0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.sum(full.cast("long"))).first()
        if not weight or n == capped:
            break
        level, capped = (total - float(held)) / float(weight), n
    return per_source.withColumn("target", F.least(F.col("words") * F.lit(float(cap)), F.col("weight") * F.lit(level)))


def weights_in_order(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``source`` with its ``weight``: the cycle repeated over the sources by
    code point, null last. Ranks come from a sort in value ranges, each range
    numbered on its own, so any number of sources will do."""
    ordered = sources.orderBy(F.col("source").asc_nulls_last())
    ranked = ordered.rdd.map(lambda r: r["source"]).zipWithIndex()
    spark = sources.sparkSession
    pairs = spark.createDataFrame(ranked, "source string, pos long")
    at = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.col("pos") % len(cycle) + 1).cast("int"))
    return pairs.select("source", at.cast("long").alias("weight"))


def fly(p: list[float], size: list[float], rng: random.Random) -> list[float]:
    """Flight phase over units sorted from long to short; keeps the sum of
    ``p`` and of ``p * size``. The three units in the air are the two longest
    and the shortest still undecided, so that long documents are decided while
    there are many short ones to make up for them. At most two units stay
    between 0 and 1."""
    p = [0.0 if x <= EPS else 1.0 if x >= 1 - EPS else x for x in p]
    waiting = deque(k for k, x in enumerate(p) if 0.0 < x < 1.0)
    long_: list[int] = []
    short: list[int] = []
    while True:
        while len(long_) < 2 and waiting:
            long_.append(waiting.popleft())
        if not short and waiting:
            short.append(waiting.pop())
        air = long_ + short
        same = next(((i, j) for n, i in enumerate(air) for j in air[n + 1:] if size[i] == size[j]), None)
        if same:
            units, move = same, (1.0, -1.0)
        elif len(air) == 3:
            units = tuple(air)
            a, b, c = (size[i] for i in units)
            move = (c - b, a - c, b - a)
        else:
            return p
        up = min((1 - p[i]) / u if u > 0 else -p[i] / u for i, u in zip(units, move))
        down = min(p[i] / u if u > 0 else (p[i] - 1) / u for i, u in zip(units, move))
        step = up if rng.random() * (up + down) < down else -down
        for i, u in zip(units, move):
            p[i] += step * u
            p[i] = 0.0 if p[i] <= EPS else 1.0 if p[i] >= 1 - EPS else p[i]
        if all(0.0 < p[i] < 1.0 for i in units):  # rounding kept it just off a face
            i = min(units, key=lambda j: min(p[j], 1 - p[j]))
            p[i] = float(round(p[i]))
        long_ = [i for i in long_ if 0.0 < p[i] < 1.0]
        short = [i for i in short if 0.0 < p[i] < 1.0]


def land(p: list[float], size: list[float]) -> list[float]:
    """Round the few units left: of all combinations whose count is off by
    ``COUNT_OFF`` at most, the one closest in words."""
    p = list(p)
    left = [k for k, x in enumerate(p) if 0.0 < x < 1.0]
    if not left:
        return p
    choice = ((np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1).astype(float)
    off = choice - np.array([p[k] for k in left])
    words = np.abs(off @ np.array([size[k] for k in left]))
    count = np.abs(off.sum(axis=1))
    best = np.lexsort([count, np.round(words, 6), count > COUNT_OFF])[0]
    for k, c in zip(left, choice[best]):
        p[k] = float(c)
    return p


def fly_and_land(p: list[float], size: list[float], rng: random.Random, landing: int = LANDING) -> list[float]:
    """The last chunk of a source: ``landing`` undecided units, spread over the
    sizes, stay out of the flight, so that the landing problem has enough
    combinations to come within a few words."""
    open_ = [k for k, x in enumerate(p) if EPS < x < 1 - EPS]
    aside = set(rng.sample(open_, min(landing, len(open_))))
    fliers = [k for k in range(len(p)) if k not in aside]
    out = list(p)
    for k, x in zip(fliers, fly([p[k] for k in fliers], [size[k] for k in fliers], rng)):
        out[k] = x
    return land(out, size)


# no column of these is null but the source: pandas turns integers with nulls into doubles, which lose large ids
_UNIT = "source string, place long, chunk long, chunks long, ratio double, size long, n long, _id long, _none boolean, key long, p double"


def _fly_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["size", "key", "_none", "_id"], ascending=[False, True, True, True], kind="stable")
    first = pdf.iloc[0]
    seed = (int(first["place"]) * 1_000_003 + int(first["chunk"])) * 1_000_003 + int(first["chunks"])
    size = pdf["size"].astype(float).tolist()
    move = fly_and_land if first["chunks"] == 1 else fly
    return pdf.assign(p=move(pdf["p"].tolist(), size, random.Random(seed)))


def _take(units: DataFrame, chunk: int, max_rounds: int = 60) -> DataFrame:
    """``units`` (source, place, ratio, size, n, _id, key) with ``taken``, the
    number of times that its ``n`` equal rows are taken together."""
    exact = F.col("n") * F.col("ratio")
    whole = F.floor(exact + F.lit(EPS))
    units = units.withColumn("whole", whole).withColumn("p", F.greatest(exact - whole, F.lit(0.0)))
    units = units.withColumn("_none", F.col("_id").isNull()).withColumn("_id", F.coalesce("_id", F.lit(0).cast("long")))
    settled = [units.where(F.col("p") <= EPS).drop("p").withColumn("extra", F.lit(0).cast("long"))]
    open_ = units.where(F.col("p") > EPS)
    sizes = open_.groupBy("place").agg(F.count(F.lit(1)).alias("m"))
    for _ in range(max_rounds):
        chunks = sizes.select("place", F.greatest(F.ceil(F.col("m") / chunk), F.lit(1)).cast("long").alias("chunks"))
        dealt = (open_.drop("chunks", "chunk").join(small(chunks, 48), "place")
                 .withColumn("chunk", F.pmod(F.xxhash64("key", "_id", "chunks"), F.col("chunks"))))
        cols = ["source", "place", "chunk", "chunks", "ratio", "size", "n", "_id", "_none", "key", "p", "whole"]
        flown = saved(dealt.select(cols).groupBy("place", "chunk").applyInPandas(_fly_chunk, _UNIT + ", whole long"), "mix")
        settled.append(flown.where((F.col("p") == 0) | (F.col("p") == 1))
                       .withColumn("extra", F.col("p").cast("long")).drop("p", "chunk", "chunks"))
        open_ = flown.where((F.col("p") > 0) & (F.col("p") < 1))
        sizes = open_.groupBy("place").agg(F.count(F.lit(1)).alias("m"))
        if open_.isEmpty():
            break
    else:
        raise RuntimeError("the flight phase did not end")
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    return out.select("source", "size", "n", F.when(~F.col("_none"), F.col("_id")).alias("_id"), "key", (F.col("whole") + F.col("extra")).alias("taken"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        cycle: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Two tables: units (``source, size, n, _id, key, taken``: ``n`` equal
    rows, taken together ``taken`` times) and sources (``source, words, weight,
    target``). ``key`` is the text's hash, ``size`` its words."""
    ship(docs.sparkSession)
    units = saved(docs.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).cast("long").alias("_id"),
                              n_words(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("key"))
                  .groupBy("source", "_id", "size", "key").agg(F.count(F.lit(1)).alias("n")), "units")
    per = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    order = weights_in_order(per.select("source"), cycle).withColumnRenamed("source", "_s")
    per = saved(per.join(order, F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "sources")
    goal = saved(targets(per, cap).withColumn("place", F.xxhash64("source")), "targets")
    ratio = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(F.lit(0.0))
    rated = units.join(small(goal.select(F.col("source").alias("_s"), "place", ratio.alias("ratio")), 96),
                       F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return _take(rated, chunk), goal


def _copies(taken: Column, n: Column, nth: Column) -> Column:
    """How often the ``nth`` (from 0) of ``n`` equal rows is taken."""
    return F.floor(taken / n) + (nth < taken % n).cast("long")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents as the mix takes them: repeated or left out, all columns
    kept. Rows equal in id, source and text share their unit's copies evenly;
    a remainder goes to one of them."""
    id_col, text_col, source_col = (how.get(k, d) for k, d in
                                    (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source")))
    units, _ = mix(docs, **how)
    row = docs.select(F.struct("*").alias("_row"), F.col(source_col).cast("string").alias("_source"),
                      F.col(id_col).cast("long").alias("_i"), F.xxhash64(F.col(text_col)).alias("_key"))
    u = units.where("taken > 0").select(F.col("source").alias("_us"), F.col("_id").alias("_ui"), F.col("key").alias("_uk"), "n", "taken")
    same = (F.col("_key") == F.col("_uk")) & F.col("_i").eqNullSafe(F.col("_ui")) & F.col("_source").eqNullSafe(F.col("_us"))
    hit = row.join(u, same)
    each = hit.where("n = 1").select("_row", F.col("taken").alias("_c"))
    many = hit.where("n > 1")
    share = many.select("_row", F.floor(F.col("taken") / F.col("n")).alias("_c"))
    rest = (many.where("taken % n > 0").groupBy("_key", "_i", "_source")
            .agg(F.first("_row").alias("_row"), F.first(F.col("taken") % F.col("n")).alias("_c")).select("_row", "_c"))
    out = each.unionByName(share).unionByName(rest).where("_c > 0")
    return out.select("_row", F.explode(F.sequence(F.lit(1), F.col("_c").cast("int")))).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    units, goal = mix(documents(spark, sf_dir))
    goal = goal.select(F.col("source").alias("_s"), F.col("words").alias("source_size"), "target")
    rows = (units.select("*", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("nth"))
            .withColumn("times", _copies(F.col("taken"), F.col("n"), F.col("nth"))))
    return (rows.join(small(goal, 96), F.col("source").eqNullSafe(F.col("_s")))
            .select(F.col("_id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("times") * F.col("size")).alias("taken"), "source", F.col("times").alias("copies")))
