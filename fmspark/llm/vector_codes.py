"""Vector code compression: a few bits a part of a vector, nearest code-book
entries found by equal-average search.

Vectors become integers, ``floor(scale * x)``, and are cut into ``parts`` equal
pieces. Each part position has a code book of ``entries`` integer pieces, which
starts as that piece of the first vectors (by id) and is refined in ``rounds``
passes: every piece goes to its nearest entry, every entry becomes the floor of
its pieces' mean. A code is the nearest entries' numbers.

Nearest entry (``nearest_entries``): entries are sorted by the sum of their
components. For pieces of ``d`` components, the squared difference of two sums
is at most ``d`` times the squared distance, so the search starts where the
piece's own sum stands among the entries' and goes outward, the smaller gap of
both sides first, until the squared gap strictly exceeds ``d`` times the best
distance. The entries left are then farther, and equally near ones with a lower
number have been seen. A batch of pieces searches at once; those that are done
leave it.

A pass is one job over the written vectors. A task adds up its pieces by entry;
what leaves it is one row a component and 30-bit digit of each sum, so sums are
exact at any size and Spark adds them up in parallel. The driver holds the code
books only, ``entries`` vectors.

Cases: null vectors and those with null or non-finite components are left out.
Vectors that differ in length, or whose length ``parts`` does not divide, count
as filled up with zeros behind to the next multiple that holds the longest. Rows
of equal or null id are rows of their own; null ids come last, equal ones by
their vectors. Fewer vectors than ``entries`` give fewer entries. Numbers too
large for 64-bit products are worked on as Python integers; an error that a long
does not hold is null, and so are sums over it. An empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, ship, small

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DIGIT = 30  # bits of a digit of a sum
LONG = 1 << 63
ROWS = 4096  # vectors that search together


@dataclass(frozen=True)
class Codebooks:
    """``books[part][entry]`` is a list of integers."""

    books: list[list[list[int]]]
    scale: int

    @property
    def width(self) -> int:
        """Components of a part."""
        return len(self.books[0][0]) if self.books and self.books[0] else 0

    def text(self) -> str:
        """All components by part, entry and position, comma-joined."""
        return ",".join(str(x) for book in self.books for entry in book for x in entry)

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, exactly; Python integers where 64 bits may not do."""
    if not x.size or np.abs(x).max() * scale < 2 ** 52:
        return np.floor(x * scale).astype(np.int64)
    flat = [int(v) * scale if abs(v) >= 2 ** 53 else _floor(v, scale) for v in x.ravel().tolist()]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(x.shape)


def _floor(v: float, scale: int) -> int:
    top, bottom = v.as_integer_ratio()
    return top * scale // bottom


def _reach(x: np.ndarray) -> int:
    return int(abs(x).max()) if x.size else 0


def nearest_entries(pieces: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry (ties: the lower number) and squared distance of each
    piece, and how many distances were computed."""
    n, d = pieces.shape
    # products of sums must fit 64 bits
    if pieces.dtype != object and book.dtype != object and 2 * d * max(_reach(pieces), _reach(book)) >= 2 ** 31:
        pieces = pieces.astype(object)
    if pieces.dtype == object or book.dtype == object:
        pieces, book = pieces.astype(object), book.astype(object)
    m = len(book)
    sums = book.sum(axis=1) if d else np.zeros(m, np.int64)
    order = np.argsort(sums, kind="stable")
    sums = sums[order]
    own = pieces.sum(axis=1) if d else np.zeros(n, np.int64)
    up = np.searchsorted(sums, own).astype(np.int64)
    down = up - 1
    best, entry = np.full(n, -1, pieces.dtype), np.full(n, m, np.int64)
    who, looked = np.arange(n), 0
    while len(who):
        u, v, s = up[who], down[who], own[who]
        above, below = sums[np.minimum(u, m - 1)] - s, s - sums[np.maximum(v, 0)]
        go_down = (v >= 0) & ((u >= m) | (below <= above))
        gap = np.where(go_down, below, above)
        live = (v >= 0) | (u < m)
        live &= (best[who] < 0) | ~(gap * gap > d * best[who]).astype(bool)
        who, go_down = who[live], go_down[live]
        if not len(who):
            break
        at = np.where(go_down, down[who], up[who])
        e = order[at]
        gaps = pieces[who] - book[e]
        dist = (gaps * gaps).sum(axis=1) if d else np.zeros(len(who), np.int64)
        looked += len(who)
        better = (best[who] < 0) | (dist < best[who]) | ((dist == best[who]) & (e < entry[who]))
        better = better.astype(bool)
        best[who[better]], entry[who[better]] = dist[better], e[better]
        down[who[go_down]] -= 1
        up[who[~go_down]] += 1
    return entry, best, looked


def _usable(v: Column) -> Column:
    inf = F.lit(float("inf"))
    return v.isNotNull() & F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < inf), F.lit(False)))


def vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label") -> DataFrame:
    """The rows that take part, written: ``id, label, vec`` (doubles)."""
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    return saved(rows.where(_usable(F.col("vec"))), "vectors")


def _pieces(col: pa.Array, parts: int, width: int, scale: int) -> np.ndarray:
    """(rows, parts, width) integers of a list column."""
    offs = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False)
    size = np.diff(offs)
    full = np.zeros((len(col), parts * width))
    full[np.arange(parts * width)[None, :] < size[:, None]] = flat[offs[0]:offs[-1]]
    return integers(full, scale).reshape(len(col), parts, width)


def _book_arrays(books: list[list[list[int]]]) -> list[np.ndarray]:
    out = []
    for book in books:
        wide = any(abs(x) >= 2 ** 52 for entry in book for x in entry)
        a = np.empty((len(book), len(book[0]) if book else 0), object if wide else np.int64)
        for i, entry in enumerate(book):
            a[i] = entry
        out.append(a)
    return out


def _digits(value: int) -> list[tuple[int, int]]:
    """(place, digit) with ``value = sum(digit << (DIGIT * place))``."""
    sign, value, out, place = (-1 if value < 0 else 1), abs(value), [], 0
    while value:
        low = value & ((1 << DIGIT) - 1)
        if low:
            out.append((place, sign * low))
        value >>= DIGIT
        place += 1
    return out


def _refined(rows: DataFrame, books: Codebooks, parts: int) -> Codebooks:
    """One pass: entries become the floors of their pieces' means."""
    m, width, scale = len(books.books[0]), books.width, books.scale
    lists = books.books

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _book_arrays(lists)
        sums, count = np.zeros((parts, m, width), object), np.zeros((parts, m), np.int64)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                x = _pieces(b.column(0).slice(k, ROWS), parts, width, scale)
                for p in range(parts):
                    entry, _, _ = nearest_entries(x[:, p], arrays[p])
                    count[p] += np.bincount(entry, minlength=m)
                    for e in np.unique(entry):
                        sums[p, e] += x[entry == e, p].sum(axis=0)
        out = [(-1 - i, 0, int(c)) for i, c in enumerate(count.ravel().tolist()) if c]
        out += [(i, place, digit) for i, v in enumerate(sums.ravel().tolist()) for place, digit in _digits(int(v))]
        slot, place, value = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(place, pa.int32()), pa.array(value, pa.int64())],
                                         names=["slot", "place", "value"])

    # as many rows as the code books have components, times the digits of a sum
    got = (rows.select("vec").mapInArrow(add, "slot int, place int, value long")
           .groupBy("slot", "place").agg(F.sum("value").alias("value")).collect())
    total: dict[int, int] = {}
    for r in got:
        total[r.slot] = total.get(r.slot, 0) + (r.value << (DIGIT * r.place))
    new = []
    for p in range(parts):
        book = []
        for e in range(m):
            n, at = total.get(-1 - (p * m + e), 0), (p * m + e) * width
            book.append([total.get(at + j, 0) // n for j in range(width)] if n else lists[p][e])
        new.append(book)
    return Codebooks(new, scale)


def fit(rows: DataFrame, *, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Code books of ``vectors``; with no vectors, books without entries."""
    ship(rows.sparkSession)
    longest = rows.agg(F.max(F.size("vec")).alias("n")).first().n
    if longest is None:
        return Codebooks([[] for _ in range(parts)], scale)
    width = -(-longest // parts)
    first = rows.select("vec", F.col("id").isNull().alias("x"), "id").orderBy("x", "id", "vec").limit(entries).collect()
    col = pa.array([r.vec for r in first], pa.list_(pa.float64()))
    start = _pieces(col, parts, width, scale)
    books = Codebooks([[[int(v) for v in row] for row in start[:, p]] for p in range(parts)], scale)
    for _ in range(rounds):
        books = _refined(rows, books, parts)
    return books


def compress(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``id, label, code`` (a byte a part) ``, error`` (squared distances summed
    over parts) of ``vectors``; written."""
    ship(rows.sparkSession)
    lists, scale, width, parts = books.books, books.scale, books.width, len(books.books)
    if parts and len(lists[0]) > 256:
        raise ValueError("a code has a byte a part: at most 256 entries")
    kind = rows.schema["label"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _book_arrays(lists)
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                part = b.slice(k, ROWS)
                x = _pieces(part.column(2), parts, width, scale)
                code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), object)
                for p in range(parts):
                    entry, dist, _ = nearest_entries(x[:, p], arrays[p])
                    code[:, p] = entry
                    error = error + dist.astype(object)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([c.tobytes() for c in code], pa.binary()),
                     pa.array([int(e) if e < LONG else None for e in error.tolist()], pa.int64())], names=["id", "label", "code", "error"])

    out = rows.select("id", "label", "vec").mapInArrow(encode, f"id long, label {kind}, code binary, error long")
    return saved(out, "codes")


def decompress(codes: DataFrame, books: Codebooks, code_col: str = "code", out_col: str = "vec") -> DataFrame:
    """``codes`` with the vector that each code stands for (padding included)."""
    tables = [F.array(*[F.array(*[F.lit(x / books.scale) for x in entry]) for entry in book]) for book in books.books]
    byte = lambda p: F.conv(F.hex(F.substring(code_col, p + 1, 1)), 16, 10).cast("int")
    return codes.withColumn(out_col, F.flatten(F.array(*[F.get(t, byte(p)) for p, t in enumerate(tables)])))


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over equal labels, null
    labels together. A label may have any share of the rows: sums are partial."""
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    per = codes.groupBy(F.col("label").alias("_l")).agg(
        F.when((F.count("error") == F.count(F.lit(1))) & (total <= F.lit(LONG - 1)), total).cast("long").alias("label_error"))
    per = saved(per, "label_errors")
    return codes.join(small(per, 64), F.col("label").eqNullSafe(F.col("_l"))).drop("_l")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    books = fit(rows)
    out = label_errors(compress(rows, books))
    return out.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                      F.lit(books.sha256()).alias("codebooks_sha256"))


def _oracle() -> str:
    """DuckDB SQL of the query, for vectors of one length that ``PARTS`` divides."""
    apart = "list_sum(list_transform(list_zip(a.w, b.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    out = [f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
a AS MATERIALIZED (
  SELECT vec_id, label, part, list_slice(v, part * (len(v) // {PARTS}) + 1, (part + 1) * (len(v) // {PARTS})) AS w
  FROM kept, range({PARTS}) r(part)),
first AS (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, w
  FROM a WHERE vec_id IN (SELECT vec_id FROM first))"""]
    for k in range(ROUNDS + 1):
        out.append(f"""s{k} AS MATERIALIZED (
  SELECT a.vec_id, a.label, a.part, a.w, arg_min(b.entry, {apart} * {ENTRIES} + b.entry) AS entry, min({apart}) AS dist
  FROM a JOIN b{k} b USING (part) GROUP BY a.vec_id, a.label, a.part, a.w)""")
        if k < ROUNDS:
            out.append(f"""m{k} AS (
  SELECT part, entry, pos, CAST(floor(CAST(sum(w[pos]) AS DOUBLE) / count(*)) AS BIGINT) AS x
  FROM s{k}, (SELECT unnest(range(1, (SELECT max(len(w)) FROM a) + 1)) AS pos) GROUP BY part, entry, pos),
n{k} AS (SELECT part, entry, list(x ORDER BY pos) AS w FROM m{k} GROUP BY part, entry),
b{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(n.w, b.w) AS w FROM b{k} b LEFT JOIN n{k} n ON b.part = n.part AND b.entry = n.entry)""")
    return ",\n".join(out) + f""",
f AS (
  SELECT vec_id, label, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error
  FROM s{ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos))
   FROM (SELECT part, entry, unnest(w) AS x, generate_subscripts(w, 1) AS pos FROM b{ROUNDS})) AS codebooks_sha256
FROM f"""


ORACLE = _oracle()
