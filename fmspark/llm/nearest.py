"""Nearest neighbours by a block matrix join.

Vectors are packed into blocks (one binary row a block). Every block of queries
meets every super-block of candidates once, as a matrix product of int8 codes.
A product of codes is off the true inner product by at most

    |e_q| * |c'| + |q| * |e_c|        (c' the decoded candidate)

where ``e`` is what quantisation took from a vector; both norms are known for
each vector, so a tile gives every pair an interval. A candidate survives if the
top of its interval reaches the k-th largest bottom of its query; survivors are
computed again from the original floats in double precision, dimension by
dimension, and a heap per query keeps the ``k`` best of a super-block; a ranking
over the super-blocks' heaps ends it. No neighbour is lost: the result is exact.
Bounds that overflow or underflow rule nothing out.

Rows of a block pair grow with the block sizes only. Queries x candidates / block
sizes tiles are the stated work of a query set against all rows.

Cases: vectors that are null, zero, or hold a null or non-finite component take
no part, neither do rows without an id. Vectors of other dimensions than the
query's are no candidates of it. Rows with the query's own id, repeated or not, are its own row and
no candidates; repeated queries give one result. Ties go to the smaller id;
equal rows of one candidate id count once. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship

# Bytes of a block of queries and of one of candidates, as doubles. Every block
# of candidates is sent once to each block of queries, so these are large.
QUERY_BYTES = 8 << 20
BASE_BYTES = 32 << 20
# vectors packed into one row, queries and candidates in one tile
PACK, TILE = 4096, 512
TINY = 1e-300
# products of int8 codes add up exactly in float32 for so many dimensions
EXACT_DIMS = 1024


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, norms of the decoded vectors, norms of the errors."""
    x = x.astype(np.float64)
    scale = np.abs(x).max(axis=1) / 127.0
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        code = np.where(scale[:, None] > 0, np.clip(np.rint(x / scale[:, None]), -127, 127), 0).astype(np.int8)
        back = code * scale[:, None]
        return code, scale, np.linalg.norm(back, axis=1), np.linalg.norm(x - back, axis=1)


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, as doubles."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], EXACT_DIMS):
        out += a[:, k:k + EXACT_DIMS].astype(np.float32) @ b[:, k:k + EXACT_DIMS].astype(np.float32).T
    return out


def dot(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows with ``q``, summed in the order of dimensions."""
    out = np.zeros(len(x))
    with np.errstate(over="ignore", invalid="ignore"):
        for j in range(x.shape[1]):
            out += x[:, j].astype(np.float64) * float(q[j])
    return out


class Heap:
    """The ``k`` best (score, id) of one query: larger score, then smaller id. A
    score that overflows on both sides (NaN) is below all others."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.zeros(0), np.zeros(0, np.int64)

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort([ids, -score])
        ids, score = ids[order], score[order]
        first = np.sort(np.unique(ids, return_index=True)[1])[:self.k]
        self.score, self.id = score[first], ids[first]


def search_block(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int,
                 rows: int = 4096) -> list[Heap]:
    """The ``k`` best candidates of each query of a block, a tile at a time."""
    heaps = [Heap(k) for _ in qid]
    qc, qs, _, qe = encode(q)
    with np.errstate(over="ignore"):
        qn = np.linalg.norm(q.astype(np.float64), axis=1)
    for at in range(0, len(cid), rows):
        part, ids = c[at:at + rows], cid[at:at + rows]
        cc, cs, cn, ce = encode(part)
        with np.errstate(over="ignore", invalid="ignore"):
            guess = code_products(qc, cc) * qs[:, None] * cs[None, :]
            # the factor covers the rounding of these doubles themselves, the term the underflow of a product
            slack = (qe[:, None] * cn[None, :] + qn[:, None] * ce[None, :]) * (1 + 1e-9) + 1e-12 * qn[:, None] * (cn + ce)[None, :] + TINY
            low, high = guess - slack, guess + slack
        # a bound that is no number rules nothing out
        low[~np.isfinite(low)] = -np.inf
        high[np.isnan(high)] = np.inf
        own = qid[:, None] == ids[None, :]
        low[own] = -np.inf
        high[own] = -np.inf
        # the k-th bound counts candidates, so it needs each id once
        distinct = len(np.unique(ids)) == len(ids)
        for i, heap in enumerate(heaps):
            floor = np.partition(low[i], -k - 1)[-k - 1] if distinct and len(ids) > k else -np.inf
            if len(heap.score) == k and not np.isnan(heap.score[-1]):
                floor = max(floor, heap.score[-1])
            live = np.flatnonzero((high[i] >= floor) & ~own[i])
            if len(live):
                heap.offer(dot(part[live], q[i]), ids[live])
    return heaps


def usable(v: Column) -> Column:
    """Not null, not zero, all components finite."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(v, number) & F.exists(v, lambda x: x != 0), F.lit(False))


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows of one task as blocks of equal dimension: ids and components as
    bytes. No shuffle; a block has at most ``size`` vectors."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth = 0
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            arr = b.column(1)
            dims = np.diff(arr.offsets.to_numpy())
            flat = arr.values.to_numpy(zero_copy_only=False)
            begin = arr.offsets.to_numpy()[:-1]
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                for j in range(0, len(at), size):
                    sel = at[j:j + size]
                    mat = flat[begin[sel][:, None] + np.arange(d)]
                    nth += 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(d)], pa.int32()), pa.array([int(ids[sel[0]]) * 31 + nth], pa.int64()),
                         pa.array([ids[sel].astype("<i8").tobytes()], pa.binary()),
                         pa.array([mat.astype("<f8").tobytes()], pa.binary())], names=["dim", "nth", "ids", "vecs"])

    return rows.mapInArrow(pack, "dim int, nth long, ids binary, vecs binary")


def _unpack(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    ids = np.concatenate([np.frombuffer(x, "<i8") for x in pdf["ids"]])
    d = int(pdf["dim"].iloc[0])
    return ids, np.concatenate([np.frombuffer(x, "<f8").reshape(-1, d) for x in pdf["vecs"]])


def nearest(queries: DataFrame, base: DataFrame, k: int = 20, *, query_bytes: int = QUERY_BYTES,
            base_bytes: int = BASE_BYTES) -> DataFrame:
    """``queries`` and ``base``: (id long, vector array). One row a neighbour:
    ``query_id, rank, vec_id, score``."""
    ship(base.sparkSession)

    def clean(df: DataFrame) -> DataFrame:
        i, v = (F.col(f"`{c}`") for c in df.columns)
        return (df.select(i.cast("long").alias("id"), v.cast("array<double>").alias("vec"))
                .where(F.col("id").isNotNull() & usable(F.col("vec"))))

    def blocks(df: DataFrame, size: int) -> int:
        return max(1, -(-int(df.agg(F.sum(F.size("vec"))).first()[0] or 0) * 8 // size))

    queries, base = clean(queries), clean(base)
    n_query, n_base = blocks(queries, query_bytes), blocks(base, base_bytes)
    q = (_packed(queries, TILE).withColumn("qb", F.pmod(F.xxhash64("nth"), F.lit(n_query)).cast("int"))
         .withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(n_base - 1)))))
    c = (_packed(base, PACK).withColumn("bb", F.pmod(F.xxhash64("nth"), F.lit(n_base)).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1)))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if not len(left) or not len(right):
            return empty
        qid, qv = _unpack(left)
        qid, first = np.unique(qid, return_index=True)
        cid, cv = _unpack(right)
        qv = qv[first]
        heaps = [h for at in range(0, len(qid), TILE) for h in search_block(qid[at:at + TILE], qv[at:at + TILE], cid, cv, k)]
        return pd.DataFrame({"query_id": np.repeat(qid, [len(h.id) for h in heaps]),
                             "vec_id": np.concatenate([h.id for h in heaps]),
                             "score": np.concatenate([h.score for h in heaps])})

    found = (q.groupBy("dim", "qb", "bb").cogroup(c.groupBy("dim", "qb", "bb"))
             .applyInPandas(meet, "query_id long, vec_id long, score double"))

    # at most ``k`` rows a query and block of candidates
    best = F.max(F.when(~F.isnan("score"), F.col("score")))
    each = found.groupBy("query_id", "vec_id").agg(best.alias("s"))
    order = Window.partitionBy("query_id").orderBy(F.col("s").desc_nulls_last(), "vec_id")
    return (each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.coalesce("s", F.lit(float("nan"))).alias("score")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(rows.where("vec_id % 20 = 0"), rows)


ORACLE = """
with v as (select distinct vec_id, cast(embedding as double[]) as e from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
             and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (select q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e) as score
      from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e) where q.vec_id % 20 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 20
"""
