"""A3-A5, A10: sparse text readers.

Lines look like ``label idx:val idx:val ...`` (train) or
``order_id idx:val ...`` (prd). Spark's own ``libsvm`` source needs one-based
ascending indices, drops explicit zeros and parses the first token as a
number, so this reader is ``spark.read.text`` plus built-in expressions:
indices are kept as written (zero-based allowed), zeros are kept, and the
first token can stay a string. Plain and gzip parts in one folder are read
in place (A5).

A file read gives every row a ``row_id`` that is the line's own: the md5 of its
text and, for a line that occurs several times, its number among the equal ones.
It does not change with the files' splits, their names or their order, so a
hash split by it (D2) is the same on every read. ``parse_lines`` on a DataFrame
of lines (a stream's batch) numbers them as they come.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fmspark.functions import inrow as B
from fmspark.functions import sparse as S
from fmspark.functions.ordered import numbered
from fmspark.session import materialize, maybe_broadcast

# a head and pairs that every reader of numbers takes for the same ones
WELL_FORMED = r"^[^\s:]+(\s+\d{1,9}:-?\d{1,17}(\.\d{1,20})?([eE]-?\d{1,2})?)*$"
MADE_AT_ONCE = 10_000


def _lines(spark: SparkSession, path) -> DataFrame:
    df = spark.read.text(path)
    return df.where(F.length(F.trim("value")) > 0)


def with_row_ids(lines: DataFrame, value: str = "value", out: str = "row_id") -> DataFrame:
    """``lines`` with ids made of their content. Only lines that occur more than
    once are grouped: equal lines are as good as each other, so each different one
    and its number of occurrences make them all again, numbered. A line of any
    frequency is counted and made in parallel."""
    keyed = lines.withColumn(out, F.md5(value))
    several = materialize(keyed.groupBy(out).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1"), "repeated-lines")
    found = several.agg(F.count(F.lit(1)).alias("n"), F.max("_c").alias("top")).first()
    if not found.n:
        return keyed
    some, _ = maybe_broadcast(several.select(out), row_bytes=96, known_rows=found.n)
    same = keyed.join(some, out, "left_semi")
    if lines.columns == [value]:
        again = same.groupBy(value, out).agg(F.count(F.lit(1)).alias("_c"))
        again = again.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1, F.lit(MADE_AT_ONCE).cast("long"))))
        if found.top > MADE_AT_ONCE:
            again = again.repartition(out, "_from")
        again = again.withColumn("_nth", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + MADE_AT_ONCE, F.col("_c")) - 1)))
    else:  # other columns tell equal lines apart
        again = numbered(same.withColumn("_at", F.monotonically_increasing_id()), [F.col("_at")], by=[out], out_col="_nth")
    again = again.withColumn(out, F.when(F.col("_nth") == 0, F.col(out)).otherwise(F.concat_ws("-", out, F.col("_nth").cast("string"))))
    return keyed.join(some, out, "left_anti").select(*keyed.columns).unionByName(again.select(*keyed.columns))


def _parsed(batch: pa.RecordBatch) -> dict:
    """The pairs of well-formed lines (``WELL_FORMED``), and other lines' text."""
    line = batch.column("_line")
    well = pc.fill_null(pc.match_substring_regex(line, WELL_FORMED), False)
    parts = pc.ascii_split_whitespace(pc.replace_substring(pc.if_else(well, line, "0"), ":", " "))
    n, items = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64), pc.list_flatten(parts)
    first = np.cumsum(n) - n
    rest = np.ones(len(items), bool)
    rest[first] = False
    x = items.filter(pa.array(rest)).cast(pa.float64()).to_numpy(zero_copy_only=False)
    pairs = pa.StructArray.from_arrays([pa.array(x[::2].astype(np.int32)), pa.array(x[1::2])], names=["idx", "val"])
    none = pc.is_null(line)
    return {"row_id": batch.column("row_id"), "_head": pc.if_else(none, pa.scalar(None, pa.string()), items.take(pa.array(first))), "_pairs": B.lists(n // 2, pairs, none),
            "_other": pc.if_else(well, pa.scalar(None, pa.string()), line)}


def parse_lines(lines: DataFrame, *, is_prd: bool = False, value: str = "value", bad: str = "error") -> DataFrame:
    """Text lines -> ``row_id, label | order_id, features``. ``row_id`` is taken
    from the lines where they have one. Malformed numbers raise
    (``bad='error'``) or become null (``bad='null'``).

    Well-formed lines are parsed in Arrow batches, others by expressions (whose
    lambda a pair is interpreted)."""
    row_id = F.col("row_id") if "row_id" in lines.columns else F.monotonically_increasing_id().alias("row_id")
    rows = lines.select(row_id, F.trim(value).alias("_line"))
    schema = T.StructType([rows.schema["row_id"], T.StructField("_head", T.StringType()), T.StructField("_pairs", S.PAIRS), T.StructField("_other", T.StringType())])
    r = B.by_batch(rows, schema, _parsed)
    t = S.tokens("_other")
    other = F.col("_other").isNotNull()
    head = F.when(other, t[0]).otherwise(F.col("_head"))
    feats = F.when(other, S.parse_pairs(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), bad)).otherwise(F.col("_pairs")).alias("features")
    if is_prd:
        return r.select("row_id", head.alias("order_id"), feats)
    return r.select("row_id", S.num(head, "double", bad).alias("label"), feats)


def read_libsvm(spark: SparkSession, path, *, is_prd: bool = False, bad: str = "error") -> DataFrame:
    """A3 (train form) / A4 (prd form, ``is_prd=True``)."""
    return parse_lines(with_row_ids(_lines(spark, path)), is_prd=is_prd, bad=bad)


def read_labels(spark: SparkSession, path) -> DataFrame:
    """A10: ``row_id, label`` as ``int(float(token0))``."""
    t = with_row_ids(_lines(spark, path)).select("row_id", S.tokens("value")[0].alias("_l"))
    return t.select("row_id", F.col("_l").cast("double").cast("int").alias("label"))
