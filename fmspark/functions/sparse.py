"""Column expressions over sparse rows.

A sparse row holds ``features: array<struct<idx:int, val:double>>`` in the
order of the source line. Everything here is a built-in Spark expression, so
it stays inside whole-stage codegen (the lambda bodies of higher-order
functions are evaluated per element, still in the JVM and in one pass).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIR = T.StructType([T.StructField("idx", T.IntegerType()), T.StructField("val", T.DoubleType())])
PAIRS = T.ArrayType(PAIR)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(line) -> Column:
    """Split a text line on runs of blanks, after trimming.

    Writers of this format emit double and trailing blanks, so repeated
    separators must not produce empty tokens."""
    return F.split(F.trim(_c(line)), r"\s+")


def num(c, to: str, bad: str = "error") -> Column:
    """Cast text to a number: malformed text raises (``bad='error'``, as the
    reference's parser does) or becomes null (``bad='null'``)."""
    c = _c(c)
    return c.try_cast(to) if bad == "null" else c.cast(to)


def parse_pairs(toks, bad: str = "error") -> Column:
    """``array<string>`` of ``idx:val`` tokens -> ``array<struct<idx,val>>``."""
    return F.transform(_c(toks), lambda t: F.struct(
        num(F.substring_index(t, ":", 1), "int", bad).alias("idx"),
        num(F.substring_index(t, ":", -1), "double", bad).alias("val")))


def pair(idx, val) -> Column:
    return F.struct(_c(idx).cast("int").alias("idx"), _c(val).cast("double").alias("val"))


def fmt_num(x) -> Column:
    """Number text: integral values print without a fraction (``1``, ``0``),
    others with Spark's shortest round-trip double text. 0 and 1, which most of
    one-hot values are, are told first."""
    x = _c(x)
    return F.when(x == F.lit(0.0), "0").when(x == F.lit(1.0), "1").when((x == F.floor(x)) & (F.abs(x) < F.lit(1e15)), x.cast("bigint").cast("string")) \
        .otherwise(x.cast("string"))


def format_pairs(arr) -> Column:
    """``array<struct<idx,val>>`` -> ``'idx:val idx:val ...'``."""
    return F.array_join(F.transform(_c(arr), lambda p: F.concat(
        p["idx"].cast("string"), F.lit(":"), fmt_num(p["val"]))), " ")


def format_values(arr) -> Column:
    """``array<double>`` -> ``'v v v'``."""
    return F.array_join(F.transform(_c(arr), lambda v: fmt_num(v)), " ")


def drop_zero(arr) -> Column:
    """B2: keep pairs whose value is not zero (numeric test, so ``3:0.5`` stays)."""
    return F.filter(_c(arr), lambda p: p["val"] != F.lit(0.0))


def continuous(arr, threshold: int) -> Column:
    """Pairs with ``idx <= threshold`` (kept raw)."""
    return F.filter(_c(arr), lambda p: p["idx"] <= F.lit(threshold))


def active(arr, threshold: int) -> Column:
    """B9 + B10: one-hot candidates (``idx > threshold``) that are on (``val == 1``).
    Candidates with any other value are neither raw nor embedded."""
    return F.filter(_c(arr), lambda p: (p["idx"] > F.lit(threshold)) & (p["val"] == F.lit(1.0)))


def relabel_pm1(label) -> Column:
    """B1: {1,0} -> {1,-1} as ``int(2*label - 1)`` (cast truncates toward zero)."""
    return (F.lit(2.0) * _c(label).cast("double") - F.lit(1.0)).cast("int")


def relabel_zero_only(label) -> Column:
    """Only a label equal to 0 becomes -1; other labels are kept."""
    lab = _c(label).cast("double")
    return F.when(lab == F.lit(0.0), F.lit(-1.0)).otherwise(lab)


def relabel_linear(label) -> Column:
    """``2*label - 1`` without truncation."""
    return F.lit(2.0) * _c(label).cast("double") - F.lit(1.0)


def values(arr) -> Column:
    """Positional values, index discarded."""
    return _c(arr)["val"]


def renumber(arr, start) -> Column:
    """Give the pairs consecutive indices ``start, start+1, ...``."""
    return F.transform(_c(arr), lambda p, i: F.struct(
        (i + F.lit(start)).cast("int").alias("idx"), p["val"].alias("val")))


def numbered(vals, start) -> Column:
    """``array<double>`` -> pairs numbered from ``start``."""
    return F.transform(_c(vals), lambda v, i: F.struct(
        (i + F.lit(start)).cast("int").alias("idx"), v.cast("double").alias("val")))


def field_of(field, idx, other: int | None = None) -> Column:
    """The field looked up for a feature (null ``idx``: no feature). One that
    the field map does not hold, or holds as null, is in field ``other``;
    without ``other`` it raises."""
    none = F.raise_error(F.concat(F.lit("feature without a field in the field map: "), _c(idx).cast("string"))) \
        if other is None else F.lit(other)
    return F.when(_c(idx).isNull() | _c(field).isNotNull(), _c(field)).otherwise(none.cast("int"))


def line_head(col: str) -> Column:
    """The label at the head of a text line. A null one raises: the line's
    first feature would be read in its place."""
    x = F.col(col).cast("double")
    return F.when(x.isNull(), F.raise_error(F.lit(f"null {col} at the head of a line"))).otherwise(fmt_num(x))
