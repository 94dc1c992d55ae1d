"""Substring dedup by paragraph: MinHash banding over content-cut paragraphs.

A text is one run of words, whatever its lines. A paragraph ends where the
content says so: before a word whose pair (the word and the next one) has the
smallest hash of all pairs up to ``RADIUS`` words to either side. Equal passages
are therefore cut alike wherever they stand, in a longer line, over several
lines or across page breaks, but for ``RADIUS`` words at their ends; paragraphs
have ``RADIUS + 1`` words or more, about ``2 * RADIUS + 1`` on average, and a
passage of 50 words holds a whole one 95 times in 100, one of 60 words 99 times.

A paragraph's set of five-word shingles gets a MinHash signature; ``bands_for``
picks as many bands of ``ROWS`` values as the wanted recall takes at the
threshold. Colliding paragraphs are verified by exact Jaccard, classes are the
connected components (``similar``), and of each class the first paragraph
(smallest document id, then text, then position) stays, all others are removed.
Paragraphs in a row that are repeated form a run; runs of fewer than
``MIN_WORDS`` words are left alone.

Cases: null and empty texts have no paragraphs. A text too short to be cut is
one paragraph. A paragraph repeated within one document counts like one in
another. A document is told by its id and its text, so an id that stands for
several texts, or a null id, names several documents; rows equal in both are
one. Documents without an id come after all others. Text without any change (one
word for ever) is one paragraph of any length. White space does not count in
comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, free_name, saved, ship, small, text_key
from .near_dedup import band_hashes
from .similar import bands_for, similar_classes
from .textvec import GOLDEN, U64, Words, each_slice, in_text, mix, stream
from .wordids import word_keys

RADIUS = 8
MIN_WORDS = 12
THRESHOLD = 0.8
# of pairs at the threshold; equal paragraphs always meet, pairs at 0.9 998 times in 1000
RECALL = 0.95
ROWS = 4


def minhash(shingle: np.ndarray, text: np.ndarray, n: int, k: int) -> np.ndarray:
    """``k`` minima over each text's shingles (sorted by text)."""
    sig = np.zeros((n, k), U64)
    has, at = np.unique(text, return_index=True)
    if not len(has):
        return sig
    flip, factor = stream(k, 21), stream(k, 22) | U64(1)
    with np.errstate(over="ignore"):
        for j in range(k):
            sig[has, j] = np.minimum.reduceat((shingle ^ flip[j]) * factor[j], at)
    return sig


def running_min(x: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every ``n`` values in a row."""
    out, have = x, 1
    while have < n:
        step = min(have, n - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Cut(Words):
    """The words of a slice with its paragraphs in the place of texts: ``text``
    is the text of each, ``nth`` its number there."""

    def __init__(self, w: Words, radius: int):
        self.__dict__.update(w.__dict__)
        self.keys = word_keys(w)
        h, n = self.keys[0], len(w.starts)
        heads = w.first[:-1][w.count > 0]
        begins = np.zeros(n, bool)
        begins[heads] = True
        if n > 2 * radius + 1:
            with np.errstate(over="ignore"):
                pair = mix(h[:-1] * GOLDEN + h[1:])
            run = running_min(pair, radius)
            mid = pair[radius:-radius]
            least = np.flatnonzero((mid < run[:len(mid)]) & (mid <= run[radius + 1:])) + radius
            left = least - np.repeat(w.first[:-1], w.count)[least]
            right = np.repeat(w.first[1:], w.count)[least] - least
            begins[least[(left > radius) & (right > radius + 1)]] = True
        at = np.flatnonzero(begins)
        self.text = np.searchsorted(w.first, at, side="right") - 1
        self.nth = np.arange(len(at)) - np.searchsorted(at, w.first)[self.text]
        self.first = np.append(at, n)
        self.count, self.docs = np.diff(self.first), len(at)
        # a paragraph reaches to the next one, the first from the text's first byte, the last to its last
        begin = np.where(self.nth == 0, 0, w.starts[at] - w.offs[self.text]) if len(at) else at
        last = np.append(self.text[1:] != self.text[:-1], True) if len(at) else begins
        size = np.diff(w.offs)[self.text]
        self.begin, self.end = begin, np.where(last, size, np.append(begin[1:], 0)) if len(at) else begin

    @property
    def hashes(self) -> np.ndarray:
        return self.keys[0]

    def content_keys(self) -> pa.Array:
        """16 bytes a paragraph: two sums over its words and their places."""
        out = np.zeros((self.docs, 2), "<u8")
        if self.docs:
            place = np.arange(len(self.starts)) - np.repeat(self.first[:-1], self.count)
            with np.errstate(over="ignore"):
                for k in (0, 1):
                    each = mix(self.keys[k] + mix(place.astype(U64) + U64(1 + (k << 32))))
                    out[:, k] = mix(np.add.reduceat(each, self.first[:-1]) + self.count.astype(U64) * GOLDEN)
        flat = pa.py_buffer(out.tobytes())
        return pa.Array.from_buffers(pa.binary(16), self.docs, [None, flat]).cast(pa.binary())

    def units(self) -> tuple[np.ndarray, np.ndarray]:
        """Different shingles of each paragraph, sorted by paragraph."""
        shingle, of = self.shingles()
        tagged = in_text(shingle, of)
        _, one = np.unique(tagged, return_index=True)
        one.sort()
        return shingle[one], of[one]


def cut_texts(texts: pa.Array, radius: int) -> Iterator[tuple[int, Cut]]:
    """The paragraphs of an array of texts, a slice at a time, with the number
    of the slice's first text."""
    for i, _, w in each_slice(texts):
        yield i, Cut(w, radius)


def _lists(values: np.ndarray, of: np.ndarray, n: int) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))


def paragraphs(docs: DataFrame, bands: int, *, id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS,
               radius: int = RADIUS) -> DataFrame:
    """One row a paragraph: ``_id, doc`` (the text's key) ``, para, words, begin,
    end`` (bytes of the text, which the paragraphs of a text fill) ``, key,
    weight`` (different shingles) ``, bands``."""
    schema = pa.schema([("_id", pa.int64()), ("doc", pa.binary()), ("para", pa.int32()), ("words", pa.int32()), ("begin", pa.int64()),
                        ("end", pa.int64()), ("key", pa.binary()), ("weight", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, c in cut_texts(b.column(2), radius):
                at = pa.array(c.text + i)
                shingle, of = c.units()
                sig = minhash(shingle, of, c.docs, bands * rows)
                hashes = band_hashes(sig, rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(at), b.column(1).take(at), pa.array(c.nth, pa.int32()), pa.array(c.count, pa.int32()), pa.array(c.begin, pa.int64()),
                     pa.array(c.end, pa.int64()), c.content_keys(), pa.array(np.bincount(of, minlength=c.docs)),
                     _lists(hashes.ravel(), np.repeat(np.arange(c.docs), bands), c.docs)], schema=schema)

    return _texts(docs, id_col, text_col).mapInArrow(
        cut, "_id long, doc binary, para int, words int, begin long, end long, key binary, weight long, bands array<bigint>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("_id"), text_key(text).alias("doc"), text.alias("text"))


def _units(docs: DataFrame, id_col: str, text_col: str, radius: int) -> DataFrame:
    """(key, units) of every paragraph of every text."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, c in cut_texts(b.column(0), radius):
                yield pa.RecordBatch.from_arrays([c.content_keys(), _lists(*c.units(), c.docs)], names=["key", "units"])

    return _texts(docs, id_col, text_col).select("text").mapInArrow(cut, "key binary, units array<bigint>")


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, threshold: float = THRESHOLD,
            recall: float = RECALL, rows: int = ROWS, radius: int = RADIUS) -> DataFrame:
    """One row a paragraph of a repeated run: ``_id, doc, para, words, begin,
    end, class_id, class_doc, class_para`` (its class's first paragraph) and
    ``removed``."""
    ship(docs.sparkSession)
    bands = bands_for(threshold, recall, rows)
    placed = saved(paragraphs(docs, bands, id_col=id_col, text_col=text_col, rows=rows, radius=radius), "paragraphs")

    def units_of(keys: DataFrame) -> DataFrame:
        return _units(docs, id_col, text_col, radius).join(small(keys, 48), "key").dropDuplicates(["key"])

    # a candidate's few shingles are verified as fast as a sketch would be
    classes = similar_classes(placed.select("key", "weight", "bands"), units_of, threshold, None)
    place, short = F.xxhash64("_id", "doc", "para"), F.xxhash64("key").alias("short")
    # most paragraphs stand in one place and are near no other: bare hashes tell which do not
    equal = placed.groupBy(short).agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("short")
    near = classes.select(F.explode(F.array("key", "root")).alias("key")).select(short)
    some = saved(equal.unionByName(near).distinct(), "some")
    at = placed.select("_id", "doc", "para", "words", "begin", "end", "key", short).join(small(some, 16), "short", "left_semi").drop("short")
    at = saved(at.distinct(), "placed")  # equal rows are one document
    at = at.join(small(classes, 96), "key", "left").withColumn("root", F.coalesce("root", "key")).drop("key")
    order = F.struct(F.col("_id").isNull().alias("x"), F.col("_id").alias("i"), F.col("doc").alias("d"), F.col("para").alias("p"))
    at = saved(at, "rooted")
    several = saved(at.groupBy("root").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("root"), "several")
    again = saved(at.join(small(several, 48), "root"), "repeated")
    again = again.join(small(saved(again.groupBy("root").agg(F.min(order).alias("f")), "classes"), 160), "root")
    # runs: paragraphs in a row of one document
    nth = F.row_number().over(Window.partitionBy("_id", "doc").orderBy("para"))
    run = F.sum("words").over(Window.partitionBy("_id", "doc", "run"))
    kept = again.withColumn("run", F.col("para") - nth).withColumn("run_words", run).where(F.col("run_words") >= min_words)
    same = F.col("_id").eqNullSafe(F.col("f.i")) & (F.col("doc") == F.col("f.d")) & (F.col("para") == F.col("f.p"))
    return kept.select("_id", "doc", "para", "words", "begin", "end", F.col("f.i").alias("class_id"), F.col("f.d").alias("class_doc"),
                       F.col("f.p").alias("class_para"), (~same).alias("removed"))


def without_repeats(docs: DataFrame, **how) -> DataFrame:
    """The documents with their removed paragraphs cut out of the text."""
    id_col, text_col = how.get("id_col", "doc_id"), how.get("text_col", "text")
    i, key, cuts = (free_name(docs, n) for n in ("_i", "_doc", "_cuts"))
    gone = (repeats(docs, **how).where("removed").groupBy(F.col("_id").alias(f"{i}_"), F.col("doc").alias(f"{key}_"))
            .agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias(cuts)))  # of one text

    @F.arrow_udf("string")
    def rest(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(texts, spans):
            if not s.is_valid:
                out.append(t.as_py())
                continue
            raw, keep, last = t.as_py().encode(), [], 0
            for x in s.as_py():
                keep.append(raw[last:x["begin"]])
                last = x["end"]
            out.append(b"".join([*keep, raw[last:]]).decode())
        return pa.array(out, pa.string())

    text = F.col(f"`{text_col}`")
    out = docs.withColumn(i, F.col(f"`{id_col}`").cast("long")).withColumn(key, text_key(F.coalesce(text, F.lit(""))))
    gone = small(saved(gone, "gone"), 512)
    out = out.join(gone, F.col(i).eqNullSafe(F.col(f"{i}_")) & (F.col(key) == F.col(f"{key}_")), "left")
    return out.withColumn(text_col, F.when(F.col(cuts).isNull(), text).otherwise(rest(text, F.col(cuts)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (repeats(documents(spark, sf_dir))
            .select(F.col("_id").alias("doc_id"), F.lower(F.hex("doc")).alias("text_md5"), "para", "words", "begin", "end",
                    F.col("class_id").alias("class_doc_id"), F.lower(F.hex("class_doc")).alias("class_text_md5"), "class_para", "removed"))
