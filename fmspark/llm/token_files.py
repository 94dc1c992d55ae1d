"""Token ids on disk with direct access: directly addressable codes.

An id is cut into chunks of ``BITS`` bits. Level 0 holds the lowest chunk of
every id and a bitmap that tells which ids go on; level 1 the next chunk of those
that do, with its own bitmap, and so on. Where id ``i`` goes on, its next chunk
is number ``rank(i)`` of the level above, the count of set bits before ``i``; a
directory keeps that count at every 512th bit, so ``rank`` reads one directory
entry and at most 64 bytes, and any id is read without decoding its neighbours.

A segment (bytes, little-endian):

    magic  "DAC1"        4 bytes
    bits, levels         2 x uint32
    counts               uint64 a level: chunks of the level
    per level: chunks    count x uint8 (uint16 where bits > 8)
    per level but the last:
        bitmap           ceil(count / 512) x 64 bytes, lowest bit first
        directory        ceil(count / 512) x uint32: set bits before the block

``write_tokens`` sorts documents by id into ranges, encodes each range in order
and writes whole documents into segments that close at ``SEGMENT`` ids, so a
segment is bounded by that and one document. The folder holds two Parquet
tables, written by Spark's own commit protocol:

    segments  part, seg, first (ids of the part before it), n_tokens,
              doc_ids, doc_tokens (documents in order), data (the bytes above)
    parts     part, offset (ids of all parts before it), n_tokens, n_docs

``read_documents`` reads them back; ``tokens_at`` looks up any positions.

Cases: a null or empty text is the end id alone. Documents without an id come
last. Rows of equal id are ordered by their texts; equal rows stand one after
the other, each with its own place. An empty table gives two empty tables.
Other columns are not read. A document is never cut; its ids are held by one
segment, as its text was by one row.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fmspark.session import ensure_checkpoint_dir

from .common import documents, ship, small
from .textvec import slices, utf8
from .wordids import encoder, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
BITS = 8
SEGMENT = 1 << 18
ENCODE_BYTES = 2 << 20
MAGIC = b"DAC1"
BLOCK = 512  # bits of a bitmap for one directory entry
U32, U64 = np.uint32, np.uint64


def encode_segment(ids: np.ndarray, bits: int = BITS) -> bytes:
    """Non-negative ids as one segment."""
    if not 1 <= bits <= 16:
        raise ValueError("bits of a chunk: 1 to 16")
    rest, chunks, goes_on = np.asarray(ids, U64), [], []
    while True:
        chunks.append((rest & U64((1 << bits) - 1)).astype("<u1" if bits <= 8 else "<u2"))
        rest = rest >> U64(bits)
        more = rest > 0
        if not more.any():
            break
        goes_on.append(more)
        rest = rest[more]
    out = [MAGIC, np.array([bits, len(chunks)], "<u4").tobytes(), np.array([len(c) for c in chunks], "<u8").tobytes()]
    out += [c.tobytes() for c in chunks]
    for more in goes_on:
        blocks = -(-len(more) // BLOCK)
        padded = np.zeros(blocks * BLOCK, bool)
        padded[:len(more)] = more
        before = np.cumsum(padded.reshape(blocks, BLOCK).sum(axis=1))
        out += [np.packbits(padded, bitorder="little").tobytes(), np.concatenate([[0], before[:-1]]).astype("<u4").tobytes()]
    return b"".join(out)


class Segment:
    """Read access to the bytes of a segment; nothing is decoded up front."""

    def __init__(self, data: bytes):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a segment of token ids")
        self.bits, levels = (int(x) for x in np.frombuffer(data, "<u4", 2, 4))
        counts = np.frombuffer(data, "<u8", levels, 12).astype(np.int64).tolist()
        at, kind = 12 + 8 * levels, np.dtype("<u1" if self.bits <= 8 else "<u2")
        self.chunks, self.bitmaps, self.before = [], [], []
        for n in counts:
            self.chunks.append(np.frombuffer(data, kind, n, at))
            at += n * kind.itemsize
        for n in counts[:-1]:
            blocks = -(-n // BLOCK)
            self.bitmaps.append(np.frombuffer(data, "<u8", blocks * (BLOCK // 64), at))
            at += blocks * BLOCK // 8
            self.before.append(np.frombuffer(data, "<u4", blocks, at))
            at += blocks * 4

    def __len__(self) -> int:
        return len(self.chunks[0])

    def rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Set bits of a level's bitmap before each position."""
        at = np.asarray(at, np.int64)
        end = at == len(self.chunks[level])  # past the last bit: all that the next level has
        at = np.where(end, 0, at)
        block = at // BLOCK
        words = self.bitmaps[level].reshape(-1, BLOCK // 64)[block]
        left = np.clip((at - block * BLOCK)[:, None] - 64 * np.arange(BLOCK // 64), 0, 64)
        keep = np.where(left >= 64, U64(0xFFFFFFFFFFFFFFFF), (U64(1) << np.minimum(left, 63).astype(U64)) - U64(1))
        n = self.before[level][block].astype(np.int64) + np.bitwise_count(words & keep).sum(axis=1, dtype=np.int64)
        return np.where(end, len(self.chunks[level + 1]), n)

    def at(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions."""
        positions = np.asarray(positions, np.int64)
        if len(positions) and not (0 <= positions.min() and positions.max() < len(self)):
            raise IndexError("position outside the segment")
        out = np.zeros(len(positions), U64)
        who, at = np.arange(len(positions)), positions
        for level, chunks in enumerate(self.chunks):
            out[who] |= chunks[at].astype(U64) << U64(level * self.bits)
            if level + 1 == len(self.chunks) or not len(who):
                break
            more = (self.bitmaps[level][at // 64] >> (at % 64).astype(U64)) & U64(1) == 1
            who = who[more]
            at = self.rank(level, at[more])
        return out

    def slice(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on; two ranks a level."""
        spans, lo, hi = [], start, start + n
        if not 0 <= lo <= hi <= len(self):
            raise IndexError("slice outside the segment")
        for level in range(len(self.chunks)):
            spans.append((lo, hi))
            if level + 1 < len(self.chunks):
                lo, hi = self.rank(level, np.array([lo, hi])).tolist()
        out = None
        for level in range(len(self.chunks) - 1, -1, -1):
            lo, hi = spans[level]
            ids = self.chunks[level][lo:hi].astype(U64)
            if out is not None:
                first = lo // 64
                bits = np.unpackbits(self.bitmaps[level][first:-(-hi // 64)].view(np.uint8), bitorder="little")
                ids[bits[lo - 64 * first:hi - 64 * first].astype(bool)] += out << U64(self.bits)
            out = ids
        return out


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents sorted by id over range partitions. The text's hash orders
    rows of equal id, the row's number in the input splits equal rows."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.select("i", "t", F.xxhash64("t").alias("h"), F.monotonically_increasing_id().alias("r"))
    order = [F.col("i").asc_nulls_last(), F.col("h"), F.col("r")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("i", "t")


def write_tokens(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                 tokenizer: str | None = None, bits: int = BITS, segment: int = SEGMENT) -> None:
    """Encode whole texts, ``end_id`` after each, and write them to ``path`` in
    ascending order of ids. ``tokenizer`` is the vocabulary file, at the same
    place on every machine."""
    spark = docs.sparkSession
    ship(spark)
    schema = pa.schema([("part", pa.int32()), ("seg", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())), ("data", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer or vocabulary_path(VOCABULARY))
        part, seg, first = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        names: list[int | None] = []

        def close() -> pa.RecordBatch:
            nonlocal seg, first
            ids = np.concatenate(held)
            row = [part, seg, first, len(ids), list(names), [len(x) for x in held], encode_segment(ids, bits)]
            seg, first = seg + 1, first + len(ids)
            held.clear()
            names.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, schema.types)], schema=schema)

        size = 0
        for b in batches:
            buf, offs = utf8(b.column(1))
            doc_ids = b.column(0).to_pylist()
            for i, j in slices(offs, ENCODE_BYTES):
                ids, at = enc.encode(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                ids = np.insert(ids, at[1:], end_id)
                at = (at + np.arange(len(at))).tolist()
                for k, d in enumerate(doc_ids[i:j]):
                    names.append(d)
                    held.append(ids[at[k]:at[k + 1]])
                    size += at[k + 1] - at[k]
                    if size >= segment:
                        yield close()
                        size = 0
        if held:
            yield close()

    out = _in_order(docs, id_col, text_col).mapInArrow(
        encode, "part int, seg int, first long, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>, data binary")
    out.write.mode("overwrite").parquet(f"{path}/segments")
    # one row a range partition
    sums = (spark.read.parquet(f"{path}/segments").groupBy("part")
            .agg(F.sum("n_tokens").alias("n"), F.sum(F.size("doc_ids")).alias("d")).orderBy("part").collect())
    offsets = np.concatenate([[0], np.cumsum([r.n for r in sums])]).astype(np.int64).tolist()
    parts = spark.createDataFrame([(r.part, o, r.n, r.d) for r, o in zip(sums, offsets)],
                                  "part int, offset long, n_tokens long, n_docs long")
    parts.coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")


def _tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/segments"), spark.read.parquet(f"{path}/parts")


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, on demand, ``ids`` (32-bit
    little-endian), read from the files."""
    ship(spark)
    segments, parts = _tables(spark, path)
    fields = [("part", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()),
              ("ids_crc32", pa.int64())] + ([("ids", pa.binary())] if with_ids else [])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                part, first, doc_ids, sizes, data = (b.column(c)[row] for c in range(5))
                seg, at, first = Segment(data.as_buffer()), 0, first.as_py()
                cols: list[list] = [[] for _ in fields]
                for d, n in zip(doc_ids.as_py(), sizes.as_py()):
                    raw = seg.slice(at, n).astype("<u4").tobytes()
                    for c, v in zip(cols, (part.as_py(), d, first + at, n, zlib.crc32(raw), raw)):
                        c.append(v)
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], names=[f for f, _ in fields])

    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    rows = segments.select("part", "first", "doc_ids", "doc_tokens", "data").mapInArrow(decode, schema)
    return (rows.join(small(parts.select("part", "offset"), 32), "part")
            .select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])))


def tokens_at(positions: DataFrame, path: str, *, col: str = "position", segment: int = SEGMENT) -> DataFrame:
    """``position, token_id`` of each different position (the id's number among
    all ids of the files) that exists. Positions meet the segments that cover
    them over shared stretches of ``segment`` positions; each segment then reads
    its own, at most as many as it has ids."""
    spark = positions.sparkSession
    ship(spark)
    segments, parts = _tables(spark, path)
    where = (segments.join(small(parts.select("part", "offset"), 32), "part")
             .select("part", "seg", (F.col("offset") + F.col("first")).alias("lo"), "n_tokens")
             .withColumn("stretch", F.explode(F.sequence(F.expr(f"lo div {segment}"), F.expr(f"(lo + n_tokens - 1) div {segment}")))))
    wanted = positions.select(F.col(col).cast("long").alias("p")).where("p >= 0").distinct().withColumn("stretch", F.expr(f"p div {segment}"))
    hits = (wanted.join(where, "stretch").where("p >= lo and p < lo + n_tokens")
            .groupBy("part", "seg", "lo").agg(F.collect_list("p").alias("p")))

    @F.arrow_udf("array<bigint>")
    def read(data: pa.Array, lo: pa.Array, p: pa.Array) -> pa.Array:
        return pa.array([Segment(d.as_buffer()).at(np.array(x.as_py(), np.int64) - f.as_py()).astype(np.int64).tolist()
                         for d, f, x in zip(data, lo, p)], pa.list_(pa.int64()))

    found = hits.join(segments.select("part", "seg", "data"), ["part", "seg"]).select("p", read("data", "lo", "p").alias("t"))
    return found.select(F.explode(F.arrays_zip("p", "t")).alias("z")).select(F.col("z.p").alias("position"), F.col("z.t").alias("token_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(documents(spark, sf_dir), path)
    return read_documents(spark, path)
