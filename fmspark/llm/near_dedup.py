"""Near-duplicate documents by DartMinHash over weighted shingles.

A document is the bag of its five-word shingles, a shingle's count its weight;
similarity is weighted Jaccard, sum of minima over sum of maxima of the counts.

Signature: the element (shingle, c-th occurrence) is a unit of the weight axis,
and darts are thrown into it by hashing: their ranks are the arrival times of a
Poisson process seeded by the element alone, so two documents that share the
element see the same darts. A document looks at the darts of rank up to
``(k ln k + 2 k) / weight``, about ``k ln k + 2 k`` of them whatever its
length. Each dart falls on one of ``k`` coordinates, and a coordinate keeps its
earliest dart. Coordinates agree with probability equal to the weighted
Jaccard. Should a coordinate stay empty, ranks are doubled for that document.

``rows`` coordinates make a band; the number of bands follows from the recall
wanted at the threshold. Candidates are verified on whole texts and joined to
classes (``similar``).

Cases: null, empty and blank texts have no shingles: each such row is a class of
its own. A text of one to four words is one shingle. Exact copies are one
text throughout. Rows with equal or null ids are told apart by their texts. A
class is named by its key, the smallest content key of its texts (null for texts
without words), and by its smallest document id, null if it has none: classes of
different texts under one id share that id, never the key.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, saved, ship, small, text_key
from .similar import bands_for, least_matches, similar_classes, sketches, unit_lists
from .textvec import GOLDEN, U64, Words, each_slice, in_text, mix, occurrence, stream

THRESHOLD = 0.8
RECALL = 0.9999
ROWS = 4
EMPTY = U64(0xFFFFFFFFFFFFFFFF)


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((h >> U64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def dart_signatures(element: np.ndarray, text: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """``k`` signature values a text. ``element``: hashes of unit elements,
    ``text``: the text of each, ``weight``: elements a text has."""
    n = len(weight)
    sig = np.full(n * k, EMPTY, U64)
    reach = (k * math.log(k) + 2 * k) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        live = np.flatnonzero(todo[text])
        seed, owner = element[live], text[live]
        rank, count = np.zeros(len(live)), 0
        while len(seed):
            # few elements left with many darts to come: more darts a pass
            width = int(max(1, min(512, 200_000 // len(seed))))
            with np.errstate(over="ignore"):
                nth = (np.arange(count, count + width, dtype=U64) + U64(1)) * GOLDEN
                h = mix(seed[:, None] + nth[None, :])
            at = rank[:, None] + np.cumsum(-np.log(_unit(h)), axis=1)
            hit = at <= reach[owner][:, None]
            r, c = np.nonzero(hit)
            if len(r):
                dart = mix(h[r, c] ^ GOLDEN)
                slot = (dart >> U64(32)) % U64(k)
                # smaller rank, smaller value; the low half tells darts apart
                value = (at[r, c].astype(np.float32).view(np.uint32).astype(U64) << U64(32)) | (dart & U64(0xFFFFFFFF))
                np.minimum.at(sig, owner[r] * k + slot.astype(np.int64), value)
            more = hit[:, -1]
            seed, owner, rank = seed[more], owner[more], at[more, -1]
            count += width
        todo &= (sig.reshape(n, k) == EMPTY).any(axis=1)
        reach = np.where(todo, reach * 2, reach)
    return sig.reshape(n, k)


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    """A hash of every ``rows`` coordinates, different in each band."""
    n, k = sig.shape
    bands = k // rows
    out = np.broadcast_to(stream(bands, 11), (n, bands)).copy()
    with np.errstate(over="ignore"):
        for r in range(rows):
            out = mix(out * GOLDEN + sig[:, r:bands * rows:rows])
    return out.view(np.int64)


def unit_elements(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the (shingle, occurrence) pairs of each text, and the text of each."""
    shingle, text = w.shingles()
    nth = occurrence(in_text(shingle, text))
    with np.errstate(over="ignore"):
        return mix(shingle + nth.astype(U64) * U64(0xA24BAED4963EE407)), text


def text_bands(texts: pa.Array, bands: int, rows: int) -> pa.Array:
    """``weight`` (shingles, repeats counted), ``bands`` and ``sketch`` of each text."""
    weights, hashes, sigs = [np.zeros(0, np.int64)], [np.zeros((0, bands), np.int64)], [np.zeros((0, bands * rows), U64)]
    for _, _, w in each_slice(texts):
        element, text = unit_elements(w)
        weights.append(np.bincount(text, minlength=w.docs).astype(np.int64))
        sigs.append(dart_signatures(element, text, weights[-1], bands * rows))
        hashes.append(band_hashes(sigs[-1], rows))
    flat = np.concatenate(hashes)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * bands), pa.array(flat.ravel()))
    return pa.StructArray.from_arrays([pa.array(np.concatenate(weights)), lists, sketches(np.concatenate(sigs))],
                                      names=["weight", "bands", "sketch"])


def near_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                 recall: float = RECALL, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Two written tables: every row's ``_id, key, weight`` and the classes
    ``key, root`` of the texts that are near another."""
    ship(docs.sparkSession)
    bands = bands_for(threshold, recall, rows)

    @F.arrow_udf("struct<weight:bigint,bands:array<bigint>,sketch:binary>")
    def signature(texts: pa.Array) -> pa.Array:
        return text_bands(texts, bands, rows)

    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows_ = saved(source.select("_id", text_key(F.col("text")).alias("key"), signature("text").alias("s"))
                  .select("_id", "key", "s.weight", "s.bands", "s.sketch"), "signatures")
    items = saved(rows_.where("weight > 0").dropDuplicates(["key"]).select("key", "weight", "bands", "sketch"), "items")

    def units_of(keys: DataFrame) -> DataFrame:
        return (source.select(text_key(F.col("text")).alias("key"), "text").join(small(keys, 64), "key")
                .dropDuplicates(["key"]).select("key", unit_lists("text", unit_elements).alias("units")))

    classes = similar_classes(items, units_of, threshold, least_matches(threshold, bands * rows))
    return rows_.select("_id", "key", "weight"), classes


def labelled(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``_id, key, weight`` with ``root``: the class's key, the text's own where it is alone, null
    for texts without words."""
    joined = rows.join(small(classes, 96), "key", "left")
    return joined.withColumn("root", F.when(F.col("weight") > 0, F.coalesce("root", "key")))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The documents without near-duplicates: of each class the row with the
    smallest id (any one of rows equal in id and text). Columns untouched."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    rows, classes = near_classes(docs, **how)
    each = labelled(rows, classes).where("root is not null").groupBy("root", "_id", "key").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("_id").isNull(), "_id", "key")
    one = saved(each.groupBy("root").agg(F.min_by(F.struct("_id", "key", "n"), order).alias("k")).select("k.*"), "kept")
    row = docs.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_i"),
                      text_key(F.coalesce(F.col(text_col), F.lit(""))).alias("_k"),
                      F.coalesce(F.regexp_like(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False)).alias("_w"))
    hit = row.join(small(one, 96), (F.col("_k") == F.col("key")) & F.col("_i").eqNullSafe(F.col("_id")), "left")
    out = hit.where("not _w or n = 1").select("_row")
    if not one.where("n > 1").isEmpty():  # the kept row stands in the table several times
        out = out.unionByName(hit.where("n > 1").groupBy("_k", "_i").agg(F.first("_row").alias("_row")).select("_row"))
    return out.select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, classes = near_classes(documents(spark, sf_dir))
    named = saved(labelled(rows, classes), "labelled")
    per = saved(named.where("root is not null").groupBy("root").agg(F.min("_id").alias("class_id"), F.count(F.lit(1)).alias("n_class")), "named")
    return (named.join(small(per, 96), "root", "left")
            .select(F.col("_id").alias("doc_id"), F.when(F.col("root").isNull(), F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_class", F.lit(1).cast("long")).alias("n_class"), F.lower(F.hex("root")).alias("class_key")))
