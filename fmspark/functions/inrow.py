"""Work on whole rows in Arrow batches, with tables a feature space in size.

A row's feature list is laid flat with numpy (row number, index, value), so that
looking indices up, scoring and adding up cost a few array operations a batch.
Exploding the pairs and grouping them again would sort or shuffle every pair; a
one-row table of arrays joined to every row would copy the arrays a row.

Tables come to the driver as Arrow, after their size is proven to fit the
broadcast budget, and go to the tasks with the function that reads them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fmspark.session import materialize, ship


# ---------------------------------------------------------------- inside a batch
def flat(column) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Lengths of the lists of a column (null: 0), the row number of each item,
    and the items."""
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return n, np.repeat(np.arange(len(n)), n), pc.list_flatten(column)


def field(items: pa.Array, name: str, null: int | float) -> np.ndarray:
    """A field of structs as whole numbers or doubles, as ``null`` is, which stands
    for null fields and structs."""
    kind = pa.int64() if isinstance(null, int) else pa.float64()
    return pc.fill_null(pc.struct_field(items, name).cast(kind), null).to_numpy(zero_copy_only=False)


def lists(n: np.ndarray, items: pa.Array, null: pa.Array | None = None) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), items, mask=null)


def first_of_runs(column: pa.Array) -> np.ndarray:
    """Where a value differs from the one before (null is a value); 0 is one of them."""
    a, b = column.slice(1), column.slice(0, max(0, len(column) - 1))
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return np.concatenate([[0], np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1])


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """An array cut before each of ``ends``, its pieces as binary values."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.array(np.concatenate([[0], ends]) * values.itemsize, pa.int32()).buffers()[1], pa.py_buffer(values)])


def unpacked(column, kind) -> np.ndarray:
    """The pieces of ``packed`` in one array."""
    wide = pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(data, np.uint8)[at[0]:at[1]].view(kind) if data is not None else np.zeros(0, kind)


def totals(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=n)


def distinct(idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different indices, ascending, and each item's place among them."""
    if not len(idx):
        return idx, idx
    low, high = int(idx.min()), int(idx.max())
    if high - low >= 4 * len(idx):  # far apart: sorted
        found, at = np.unique(idx, return_inverse=True)
        return found, at.reshape(-1)
    there = np.bincount(idx - low) > 0
    return np.flatnonzero(there) + low, (np.cumsum(there) - 1)[idx - low]


def vectors(column, k: int) -> tuple[np.ndarray, np.ndarray]:
    """A column of arrays as a matrix of ``k`` columns, and which rows are whole;
    what is null or missing is 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n, row, items = flat(column)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    out, keep = np.zeros((len(n), k)), place < k
    out[row[keep], place[keep]] = pc.fill_null(items, 0.0).to_numpy(zero_copy_only=False).astype(np.float64)[keep]
    return out, totals(row, pc.is_null(items).to_numpy(zero_copy_only=False).astype(float), len(n)) == 0


def find(known: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each index among ``known`` (ascending), and whether it is there."""
    if not len(known):
        return np.zeros(len(idx), np.int64), np.zeros(len(idx), bool)
    at = np.minimum(np.searchsorted(known, idx), len(known) - 1)
    return at, known[at] == idx


# ---------------------------------------------------------------- around the batches
def by_batch(df: DataFrame, schema, fn: Callable[[pa.RecordBatch], dict], at_once: int = 1 << 30) -> DataFrame:
    """``fn`` (a batch to columns by name) over all batches, of ``at_once`` rows at
    most, nothing kept between."""
    s = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches):
        with np.errstate(all="ignore"):
            for b in batches:
                for i in range(0, b.num_rows, at_once):
                    yield _batch(fn(b.slice(i, at_once)), s.names)

    ship(df.sparkSession)
    return df.mapInArrow(run, s)


def _batch(out: dict, names: Sequence[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([out[c] if isinstance(out[c], pa.Array) else pa.array(out[c]) for c in names], names=names)


def by_key(df: DataFrame, schema: T.StructType, key: str, fn: Callable[[pa.RecordBatch, np.ndarray], dict]) -> DataFrame:
    """``fn`` over batches of rows sorted by ``key`` in their partition, cut so that
    the rows of a key come together, with the places where a key's rows begin. Only
    the rows of a batch's last key are kept for the next."""
    def joined(parts):
        b = parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        return _batch(fn(b, first_of_runs(b.column(key))), schema.names)

    def run(batches):
        held = []
        for b in batches:
            if not b.num_rows:
                continue
            cut = int(first_of_runs(b.column(key))[-1])
            if cut:
                yield joined([*held, b.slice(0, cut)])
                held = [b.slice(cut)]
            elif held and held[-1].column(key)[-1].as_py() != b.column(key)[0].as_py():
                yield joined(held)
                held = [b]
            else:
                held.append(b)
        if held:
            yield joined(held)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys that several rows of a written table share (null is a key); None
    where every row has its own."""
    several = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select(*keys), "repeated-keys")
    return several if several.limit(1).count() else None


def one_row_a_key(done: DataFrame, keys: Sequence[str], rows: DataFrame, merged: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``done``, made of ``rows`` row by row, written, with the rows that share a key
    (mostly none do) replaced by what ``merged`` makes of them."""
    done = materialize(done, name)
    several = repeated(done, keys)
    if several is None:
        return done
    several, same = _matched(several, keys)
    return done.join(several, same, "left_anti").unionByName(merged(rows.join(several, same, "left_semi")))


def one_row_a_key_read(done: Callable[[DataFrame], DataFrame], keys: Sequence[str], rows: DataFrame, merged: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """As ``one_row_a_key`` of ``done(rows)``, not written: for a result that is read
    once. The keys of ``rows`` are read beforehand, without the other columns."""
    several = repeated(rows.select(*keys), keys)
    if several is None:
        return done(rows)
    several, same = _matched(several, keys)
    return done(rows.join(several, same, "left_anti")).unionByName(merged(rows.join(several, same, "left_semi")))


def _matched(several: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The keys renamed, and the condition that a row has one of them."""
    several = several.select(*[F.col(c).alias(f"_r{i}") for i, c in enumerate(keys)])
    return several, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(keys)])


def by_index(df: DataFrame, idx: str) -> pa.Table | None:
    """A table proven small enough, sorted by index, rows without one left out;
    None where an index has several rows."""
    t = df.where(F.col(idx).isNotNull()).toArrow().combine_chunks()
    t = t.take(pc.sort_indices(t, sort_keys=[(idx, "ascending")]))
    return t if pc.count_distinct(t[idx]).as_py() == t.num_rows else None
