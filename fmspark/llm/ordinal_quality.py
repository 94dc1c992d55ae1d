"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A grade runs from 0 to ``G - 1``; ``P(grade <= j) = sigmoid(cut_j - score)``
with ordered cuts and one shared score, the sum of hashed-text weights: one for
every different word (lower case, letters and digits, hashed to ``2 ** BITS``
slots) and a dense part for the relative frequency of pairs of byte classes and
of words that repeat the word before. The model gives the expected grade and
the tail probability ``P(grade >= G - 1)`` that selects documents.

Grades from ``labels``: 0 low quality, 1 good but toxic, 2 good. The model is
fitted by gradient steps on at most ``max_labelled`` labelled documents (by smallest hash
of the id), one row an id; words in fewer than ``min_docs`` of them, or whose documents' mean grade is within
``min_z`` standard errors of all documents', get no weight. Every
document is scored on its whole text; the weights broadcast have a fixed size.

Cases: null and empty texts have no features and get the score of the average
text. Null labels are not used; a document labelled twice gets its lower grade,
and one whose id stands for several rows is fitted once, on its smallest text.
Labels of one grade give every document that grade, no labels grade 0. Repeated rows and null ids are scored row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_name, ship
from .textvec import U64, Words, slices, utf8

BITS = 21
MAX_LABELLED = 12_000
SELECT_AT = 0.5

# byte classes: lower, upper, digit, space, line end, beyond ASCII, and some marks by themselves
_CLASS = np.full(256, 15, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 5
for _k, _chars in ((3, b" \t"), (4, b"\n\r"), (6, b"#*$%&"), (7, b"|<>"), (8, b"!"), (9, b"."), (10, b","), (11, b"@"),
                   (12, b"\"'()[]{}"), (13, b":;?"), (14, b"-_/=+")):
    _CLASS[list(_chars)] = _k
DENSE = 16 * 16 + 1
# letters lower-cased, digits and bytes beyond ASCII kept, all else a space
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[128:] = np.arange(128, 256)


def features(texts: pa.Array):
    """Per slice: (first text, slots of words, text of each word, dense rows)."""
    buf, offs = utf8(texts)
    for i, j in slices(offs):
        raw, at = buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        w = Words(_FOLD[raw], at)
        h = w.hashes
        owner = w.text_of_word()
        dense = np.zeros((j - i, DENSE))
        if len(raw) > 1:
            c = _CLASS[raw]
            text = np.repeat(np.arange(j - i), np.diff(at))
            inside = text[1:] == text[:-1]
            pair = (text[1:] * 256 + c[:-1] * 16 + c[1:])[inside]
            dense[:, :256] = np.bincount(pair, minlength=(j - i) * 256).reshape(j - i, 256)
            dense[:, :256] /= np.maximum(dense[:, :256].sum(axis=1, keepdims=True), 1)
            if len(h) > 1:
                again = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
                dense[:, 256] = np.bincount(owner[1:][again], minlength=j - i) / np.maximum(w.count, 1)
        yield i, (h >> U64(64 - BITS)).astype(np.int64), owner, dense


def _different(slot: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each slot once a text."""
    both = np.unique((owner << BITS) | slot)
    return both & ((1 << BITS) - 1), both >> BITS


@dataclass
class Model:
    words: np.ndarray   # float32, 2 ** BITS
    dense: np.ndarray   # weights of the scaled dense part
    mean: np.ndarray
    scale: np.ndarray
    cuts: np.ndarray    # ascending

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = []
        for _, slot, owner, dense in features(texts):
            weighty = self.words[slot] != 0
            s, o = _different(slot[weighty], owner[weighty])
            score = np.bincount(o, weights=self.words[s], minlength=len(dense)).astype(float)  # whole numbers if there is no word
            empty = dense.sum(axis=1) == 0
            score += np.where(empty, 0.0, ((dense - self.mean) / self.scale) @ self.dense)
            out.append(score)
        return np.concatenate(out) if out else np.zeros(0)

    def grades(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the highest grade."""
        above = _sigmoid(score[:, None] - self.cuts[None, :])
        return above.sum(axis=1), above[:, -1]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_model(slot: np.ndarray, owner: np.ndarray, dense: np.ndarray, grade: np.ndarray, *, steps: int = 200,
              rate: float = 0.1, l2: float = 2e-4, min_docs: int = 4, min_z: float = 4.0) -> Model:
    """Adam steps on the mean negative log-likelihood with an L2 penalty.
    ``slot``/``owner``: different words of each document."""
    n, top = len(grade), int(grade.max()) if len(grade) else 0
    if len(np.unique(grade)) < 2:  # nothing to learn: every document has the one grade (none: grade 0)
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(DENSE), np.zeros(DENSE), np.ones(DENSE),
                     np.where(np.arange(max(top, 1)) < top, -40.0, 40.0))
    used, at, times = np.unique(slot, return_inverse=True, return_counts=True)
    # words that say something about the grade: their documents' mean grade is off by min_z errors
    off = np.bincount(at, weights=(grade - grade.mean())[owner], minlength=len(used)) / (np.sqrt(times) * grade.std())
    often = (times >= min_docs) & (np.abs(off) >= min_z)
    column = np.where(often, np.cumsum(often) - 1, -1)[at]
    owner, column, used = owner[column >= 0], column[column >= 0], used[often]
    mean, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-3
    x = (dense - mean) / scale
    k = len(used)
    # parameters: words, dense, first cut, log gaps between cuts
    theta = np.zeros(k + DENSE + top)
    share = np.array([(grade <= j).mean() for j in range(top)]).clip(1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    theta[k + DENSE] = first[0]
    theta[k + DENSE + 1:] = np.log(np.maximum(np.diff(first), 1e-2))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(n)
    for step in range(1, steps + 1):
        gaps = np.exp(theta[k + DENSE + 1:])
        cuts = theta[k + DENSE] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(owner, weights=theta[column], minlength=n) + x @ theta[k:k + DENSE]
        edge = np.concatenate([np.full((n, 1), -np.inf), cuts[None, :] - score[:, None], np.full((n, 1), np.inf)], axis=1)
        upper, lower = _sigmoid(edge[rows, grade + 1]), _sigmoid(edge[rows, grade])
        upper[grade == top], lower[grade == 0] = 1.0, 0.0
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p  # of log p by upper and lower edge
        g_score = (du - dl) / n  # of the loss
        g_cut = np.zeros(top)
        np.add.at(g_cut, grade[grade < top], -du[grade < top] / n)
        np.add.at(g_cut, grade[grade > 0] - 1, dl[grade > 0] / n)
        tails = np.cumsum(g_cut[::-1])[::-1]
        grad = np.concatenate([np.bincount(column, weights=g_score[owner], minlength=k) + l2 * theta[:k] / 10,
                               x.T @ g_score + l2 * theta[k:k + DENSE], [tails[0]], tails[1:] * gaps])
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad ** 2
        theta -= rate * (1 - step / (steps + 1)) * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-6)
    words = np.zeros(1 << BITS, np.float32)
    words[used] = theta[:k]
    gaps = np.exp(theta[k + DENSE + 1:])
    return Model(words, theta[k:k + DENSE], mean, scale, theta[k + DENSE] + np.concatenate([[0.0], np.cumsum(gaps)]))


def fit(docs: DataFrame, grades: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        max_labelled: int = MAX_LABELLED, seed: int = 9, **how) -> Model:
    """``grades``: (id, grade from 0). The bounded sample is broadcast to the
    scan; its documents' features are what the driver gets."""
    ship(docs.sparkSession)
    i, g = (F.col(f"`{c}`") for c in grades.columns)
    picked = (grades.select(i.alias("_id"), g.cast("int").alias("_grade")).where("_id is not null and _grade is not null")
              .groupBy("_id").agg(F.min("_grade").alias("_grade"))
              .orderBy(F.xxhash64("_id", F.lit(seed)), "_id").limit(max_labelled))

    @F.arrow_udf("struct<slots:array<int>,dense:array<float>>")
    def extract(texts: pa.Array) -> pa.Array:
        slots, sizes, rows = [], [], []
        for _, slot, owner, dense in features(texts):
            s, o = _different(slot, owner)
            slots.append(s)
            sizes.append(np.bincount(o, minlength=len(dense)))
            rows.append(dense)
        n = sum(map(len, rows))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if n else np.zeros(1)
        return pa.StructArray.from_arrays([
            pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(slots).astype(np.int32) if n else [], pa.int32())),
            pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * DENSE),
                                     pa.array(np.concatenate(rows).ravel().astype(np.float32) if n else [], pa.float32()))],
            names=["slots", "dense"])

    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).join(F.broadcast(picked), "_id")
            .groupBy("_id").agg(F.min("_grade").alias("_grade"), F.min("_t").alias("_t"))  # max_labelled rows, however often an id stands in docs
            .select("_id", "_grade", extract("_t").alias("f")).select("_id", "_grade", "f.slots", "f.dense")).toArrow()
    rows = rows.sort_by([("_id", "ascending")])
    slots = rows["slots"].combine_chunks()
    owner = np.repeat(np.arange(len(rows)), slots.value_lengths().to_numpy(zero_copy_only=False)) if len(rows) else np.zeros(0, np.int64)
    dense = rows["dense"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), DENSE).astype(float)
    return fit_model(slots.flatten().to_numpy(zero_copy_only=False).astype(np.int64), owner, dense,
                     rows["_grade"].to_numpy().astype(np.int64), **how)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of ``grade`` (expected) and ``tail``; its name."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = free_name(docs, "_grade")

    @F.arrow_udf("struct<grade:double,tail:double>")
    def rate(texts: pa.Array) -> pa.Array:
        grade, tail = shared.value.grades(shared.value.scores(texts))
        return pa.StructArray.from_arrays([pa.array(grade), pa.array(tail)], names=["grade", "tail"])

    return docs.withColumn(name, rate(F.col(text_col))), name


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    out, name = score(docs, fit(docs, labels.select("doc_id", grade.alias("grade"))))
    g = F.col(name)
    return out.select("doc_id", g["grade"].alias("expected_grade"), g["tail"].alias("tail_probability"),
                      (g["tail"] >= SELECT_AT).alias("kept"))
