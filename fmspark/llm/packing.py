"""Best-fit packing of tokenized documents into sequences of fixed capacity.

Only the *lengths* matter for a packing, and there are at most ``capacity`` of
them, so the packing is planned on counts per length: a histogram of at most
``capacity`` rows is all that the driver sees, whatever the corpus. The plan is
a list of patterns (the lengths in one sequence) with how often each is used.

Planning (``plan``), by exact complements: a pattern opens with the longest
length still available; an index of the available lengths tells whether one, a
pair or a triple of them adds up to exactly the gap. If so the pattern is
consumed as often as the counts allow. If not, the longest length that fits
joins the pattern and the smaller gap is tried again. Once nothing fits
exactly, the rest is best-fit: the fullest open sequences take the longest
lengths first.

Documents then get their places without meeting each other: a document's rank
among those of its length is its number within a small hash group plus the
group's offset, and a binary search over the plan's rank ranges gives sequence
and offset. A hot length (every full piece has the same one) is as many groups
as it needs.

Cases: a null or empty text is one token, the end mark. A longer document is
cut at the capacity, its last piece may be shorter; nothing else is cut. Null
and repeated ids are packed row by row. An empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, saved, ship
from .textvec import slices, utf8
from .wordids import encoder, vocabulary_path

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"
ENCODE_BYTES = 2 << 20


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row a piece: ``doc_id, piece, start, length, ids_crc32`` and, on
    demand, ``ids`` (32-bit little-endian). Every document ends with the id 1.
    ``tokenizer`` is the vocabulary file, at the same place on every machine."""
    ship(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])
    end = np.array([END_ID], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer or vocabulary_path(VOCABULARY))
        for b in batches:
            if not b.num_rows:
                continue
            buf, offs = utf8(b.column(1))
            doc_ids = b.column(0).to_pylist()
            cols: list[list] = [[] for _ in fields]
            for i, j in slices(offs, ENCODE_BYTES):
                flat, first = enc.encode(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                raw, first = flat.astype("<u4").tobytes(), (4 * first).tolist()
                for k, d in enumerate(doc_ids[i:j]):
                    ids = raw[first[k]:first[k + 1]] + end
                    for n, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        for c, v in zip(cols, (d, n, at // 4, len(part) // 4, zlib.crc32(part), part)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], names=[f for f, _ in fields])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).alias("_t")).mapInArrow(cut, schema)


class _Index:
    """Counts per length with look-ups of exact sums among the lengths that
    are available."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    def longest(self, limit: int, used: dict[int, int]) -> int:
        """The longest length up to ``limit`` with an item left; 0: none."""
        has = np.flatnonzero(self.counts[:limit + 1])
        for length in has[::-1]:
            if self.counts[length] > used.get(int(length), 0):
                return int(length)
        return 0

    def _free(self, used: dict[int, int]) -> np.ndarray:
        free = self.counts.copy()
        for length, n in used.items():
            free[length] -= n
        return free

    @staticmethod
    def _pair(free: np.ndarray, gap: int) -> tuple[int, int] | None:
        half = gap // 2
        a = np.arange(1, half + 1)
        ok = (free[a] > 0) & (free[gap - a] > 0)
        if gap % 2 == 0 and half and free[half] < 2:
            ok[half - 1] = False
        at = np.flatnonzero(ok)
        return (int(gap - a[at[0]]), int(a[at[0]])) if len(at) else None

    def exact(self, gap: int, used: dict[int, int]) -> tuple[int, ...] | None:
        """One, two or three available lengths that sum to ``gap``."""
        if gap <= 0:
            return () if gap == 0 else None
        free = self._free(used)
        if free[gap] > 0:
            return (gap,)
        two = self._pair(free, gap)
        if two:
            return two
        for a in np.flatnonzero(free[:gap])[::-1]:
            if 3 * a < gap:  # the largest of three is a third at least
                break
            free[a] -= 1
            two = self._pair(free, int(gap - a))
            free[a] += 1
            if two:
                return (int(a), *two)
        return None


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; every item is in one of them.
    ``counts[length]`` is the number of items of that length."""
    counts = np.asarray(counts, np.int64).copy()
    index = _Index(counts)
    out: list[tuple[tuple[int, ...], int]] = []
    if counts[capacity]:
        out.append(((capacity,), int(counts[capacity])))
        counts[capacity] = 0
    rest: list[int] = []  # lengths whose items go to best-fit
    rest_counts = np.zeros_like(counts)
    while True:
        first = index.longest(capacity, {})
        if not first:
            break
        pattern, gap, used = [first], capacity - first, {first: 1}
        while True:
            fill = index.exact(gap, used)
            if fill is not None:
                pattern += fill
                break
            nxt = index.longest(gap, used)
            if not nxt:
                pattern = []
                break
            pattern.append(nxt)
            used[nxt] = used.get(nxt, 0) + 1
            gap -= nxt
        if not pattern:  # no exact fill goes with this length any more
            rest_counts[first] += counts[first]
            rest.append(first)
            counts[first] = 0
            continue
        lengths, times = np.unique(pattern, return_counts=True)
        n = int((counts[lengths] // times).min())
        counts[lengths] -= n * times
        out.append((tuple(pattern), n))
    return out + _best_fit(rest_counts, capacity)


def _best_fit(counts: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: open patterns by gap, the longest
    lengths first, each into the smallest gap that holds it."""
    open_: dict[int, list[list]] = {}  # gap -> [pattern, how many]
    for length in np.flatnonzero(counts)[::-1]:
        length, n = int(length), int(counts[length])
        while n:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                room = capacity // length
                for per, many in ((room, n // room), (n % room, 1)):
                    if per and many:
                        open_.setdefault(capacity - per * length, []).append([(length,) * per, many])
                break
            pattern, have = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            take = min(n, have)
            if have > take:
                open_.setdefault(gap, []).append([pattern, have - take])
            open_.setdefault(gap - length, []).append([pattern + (length,), take])
            n -= take
    return [(tuple(p), n) for v in open_.values() for p, n in v if n]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """The plan as rank ranges: items of ``length`` with ranks from ``start``
    on go to sequences ``sequence, sequence + 1, ...`` at ``offset``. Sorted by
    ``length`` and ``start``."""
    rows, taken, sequence = [], {}, 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + n
            offset += length
        sequence += n
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return a[:, 0], a[:, 1], a[:, 2], a[:, 3]


def _ranked(items: DataFrame, counts: dict[int, int], parts: int) -> DataFrame:
    """``items`` with their 0-based ``rank`` among those of equal length. A
    length's items are dealt to groups of about a quarter of a partition."""
    from pyspark.sql import Window
    spark = items.sparkSession
    room = max(1, sum(counts.values()) // (4 * parts))
    groups = spark.createDataFrame([(k, -(-v // room)) for k, v in counts.items()], "length long, groups long")
    dealt = (items.join(F.broadcast(groups), "length")
             .withColumn("grp", F.pmod(F.xxhash64("_row"), F.col("groups"))).drop("groups"))
    before = (dealt.groupBy("length", "grp").agg(F.count(F.lit(1)).alias("c"))
              .withColumn("before", F.sum("c").over(Window.partitionBy("length").orderBy("grp")) - F.col("c")).drop("c"))
    within = Window.partitionBy("length", "grp").orderBy("doc_id", "piece", "_row")
    return (dealt.withColumn("nth", F.row_number().over(within) - 1).join(before, ["length", "grp"])
            .withColumn("rank", F.col("before") + F.col("nth")).drop("before", "nth", "grp"))


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (a written table with ``doc_id, piece, length``) with their
    ``sequence_id`` and ``offset``."""
    spark = items.sparkSession
    ship(spark)
    # numbered once, in the written table, so that ranks are the same in every job
    items = saved(items.withColumn("_row", F.monotonically_increasing_id()), "items")
    counts = {int(r["length"]): int(r["n"]) for r in
              items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    schema = T.StructType([f for f in items.schema.fields if f.name != "_row"]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    if not counts:
        return spark.createDataFrame([], schema)
    histogram = np.zeros(capacity + 1, np.int64)
    for k, v in counts.items():
        histogram[k] = v
    length, start, sequence, offset = slots(plan(histogram, capacity))
    # at most a few thousand patterns of at most `capacity` lengths
    table = spark.sparkContext.broadcast((length * (1 << 40) + start, start, sequence, offset))

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        key, start, sequence, offset = table.value
        ln, rk = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        at = np.searchsorted(key, ln * (1 << 40) + rk, side="right") - 1
        return pa.StructArray.from_arrays([pa.array(sequence[at] + rk - start[at]), pa.array(offset[at])],
                                          names=["sequence_id", "offset"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = _ranked(items, counts, parts).withColumn("_at", place("length", "rank"))
    return out.select(*[c for c in items.columns if c != "_row"], "_at.sequence_id", "_at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces made ``with_ids``: one row
    a sequence with its ids, in order. A sequence has at most ``capacity``
    tokens, so a group is bounded."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (pack(pieces(documents(spark, sf_dir)))
            .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
