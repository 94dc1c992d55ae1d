"""Declarative per-column feature transforms on ``pyspark.ml``.

``parse_transform`` reads the ``{field: 'op;op'}`` spec (configuration, on
the driver). ``transform_pipeline`` turns it into one ``Pipeline`` whose
stages are grouped by kind and chain depth, using the multi-column forms of
the estimators (``inputCols``), so a spec over hundreds of columns costs a
handful of fits and a single projection, not one fit/rename per column.

The single-operator helpers (``binarizer`` ... ``chisq_selector``) keep the
reference's call shapes: ``(df, in, out, ..., drop)``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import feature as MF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fmspark import defaults as DF
from fmspark.functions.ordered import exact_quantiles
from fmspark.operators.rows import cast_fill

INF = float("inf")


class Op(NamedTuple):
    kind: str          # bucketizer | discretizer | onehot | standard_scaler | untransform | delete
    field: str
    arg: object = None


_BUCKET = re.compile(r"^bucket\((.*)\)$", re.I)
_DISC = re.compile(r"^discretize\((\d+)\)$", re.I)
_ONEHOT = re.compile(r"^onehot(\(\))?$", re.I)


def _split_value(tok: str) -> float:
    t = tok.strip().lower()
    if t == "min":
        return -INF
    if t == "max":
        return INF
    return float(t)


def parse_transform(spec: dict) -> list[list[Op]]:
    """``{field: spec}`` -> one chain of ``Op`` per field.

    ``discretize(n)``, ``bucket(a,b,...)`` (``min`` -> -inf, ``max`` -> inf),
    ``onehot`` / ``onehot()``, ``standardnormalize``, ``untransform`` (any
    case), ``None`` -> delete; ``;`` chains steps. Anything else raises."""
    chains = []
    for field, s in spec.items():
        if s is None:
            chains.append([Op("delete", field)])
            continue
        chain = []
        for step in (x.strip() for x in str(s).split(";") if x.strip()):
            m = _BUCKET.match(step)
            if m:
                chain.append(Op("bucketizer", field, [_split_value(t) for t in m.group(1).split(",")]))
                continue
            m = _DISC.match(step)
            if m:
                chain.append(Op("discretizer", field, int(m.group(1))))
                continue
            if _ONEHOT.match(step):
                chain.append(Op("onehot", field))
            elif step.lower() == "standardnormalize":
                chain.append(Op("standard_scaler", field))
            elif step.lower() == "untransform":
                chain.append(Op("untransform", field))
            else:
                raise ValueError(f"unknown transform {step!r} for field {field!r}")
        chains.append(chain)
    return chains


def count_kinds(chains: list[list[Op]]) -> dict:
    """Number of steps per kind (the reference's log line)."""
    return dict(Counter(op.kind for ch in chains for op in ch))


def transform_pipeline(df: DataFrame, spec: dict, *, relative_error: float = DF.QUANTILE_RELATIVE_ERROR,
                       handle_invalid: str = "error") -> tuple[DataFrame, PipelineModel | None]:
    """C2 (+ B12, C20): apply a spec; each transform replaces the column of
    the same name. Returns ``(transformed, fitted PipelineModel)``."""
    fitted = _fitted(df, spec, relative_error, handle_invalid)
    return fitted.transform(df), fitted.model


def _fitted(df: DataFrame, spec: dict, relative_error: float, handle_invalid: str) -> FittedSpec:
    """Fit a spec.

    Columns whose chain starts with a numeric transform are cast to double
    with null/NaN -> 0 first (one ``select``). One-hot steps on string
    columns are not cast. Stages run depth by depth; at each depth one
    multi-column estimator per kind. ``handle_invalid='keep'`` gives unseen
    categories (a prediction set) their own last one-hot slot. Quantiles are
    sketches of ``relative_error``, or exact where it is 0 (ranks over counted
    values in sorted ranges)."""
    chains = parse_transform(spec)
    drop = [ch[0].field for ch in chains if ch and ch[0].kind == "delete"]
    chains = [ch for ch in chains if ch and ch[0].kind != "delete"]
    numeric_first = [ch[0].field for ch in chains if ch[0].kind != "onehot"]
    data = df.drop(*drop)
    if numeric_first:
        data = cast_fill(data, numeric_first)
    cur = {ch[0].field: ch[0].field for ch in chains}
    stages, std_cols = [], []
    depth = max((len(ch) for ch in chains), default=0)
    for d in range(depth):
        level = [ch[d] for ch in chains if len(ch) > d]
        by = {}
        for op in level:
            by.setdefault(op.kind, []).append(op)
        for kind, ops in by.items():
            ins = [cur[o.field] for o in ops]
            outs = [f"__{o.field}__{d}" for o in ops]
            if kind == "bucketizer":
                stages.append(MF.Bucketizer(splitsArray=[o.arg for o in ops], inputCols=ins, outputCols=outs,
                                            handleInvalid="error"))
            elif kind == "discretizer" and relative_error == 0:
                seen = Pipeline(stages=stages).fit(data).transform(data) if stages else data
                cuts = exact_quantiles(seen, ins, [o.arg for o in ops])
                stages.append(MF.Bucketizer(splitsArray=[_splits(c) for c in cuts], inputCols=ins, outputCols=outs, handleInvalid="error"))
            elif kind == "discretizer":
                stages.append(MF.QuantileDiscretizer(numBucketsArray=[o.arg for o in ops], inputCols=ins,
                                                     outputCols=outs, relativeError=relative_error,
                                                     handleInvalid="error"))
            elif kind == "onehot":
                mids = [f"__{o.field}__{d}_i" for o in ops]
                stages.append(MF.StringIndexer(inputCols=ins, outputCols=mids, stringOrderType="frequencyDesc",
                                               handleInvalid=handle_invalid))
                # an unseen category (indexer 'keep') gets the extra last index,
                # which the encoder treats as one more known category
                stages.append(MF.OneHotEncoder(inputCols=mids, outputCols=outs, dropLast=False,
                                               handleInvalid="error"))
            elif kind == "standard_scaler":
                if d != 0 or std_cols:
                    raise ValueError("standardnormalize must be the only step of its field")
                std_cols = [o.field for o in ops]
                stages.append(MF.VectorAssembler(inputCols=ins, outputCol="__std_in", handleInvalid="keep"))
                stages.append(MF.StandardScaler(inputCol="__std_in", outputCol="__std_out",
                                                withMean=True, withStd=True))
                outs = ins
            elif kind == "untransform":
                outs = ins
            for o, out in zip(ops, outs):
                cur[o.field] = out
    model = Pipeline(stages=stages).fit(data) if stages else None
    return FittedSpec(model, drop, numeric_first, cur, std_cols)


def _splits(cuts: list[float]) -> list[float]:
    """Bucket limits of quantiles; equal ones collapse."""
    return [-math.inf, *sorted(set(cuts)), math.inf]


class FittedSpec:
    """A fitted spec: applies the same casts, stages and renames to another
    set (for example a prediction set scored with the training fit; use
    ``handle_invalid='keep'`` for categories unseen in training)."""

    def __init__(self, model: PipelineModel | None, drop, numeric_first, cur, std_cols):
        self.model, self.drop, self.numeric_first = model, list(drop), list(numeric_first)
        self.cur, self.std_cols = dict(cur), list(std_cols)

    def transform(self, df: DataFrame) -> DataFrame:
        data = df.drop(*self.drop)
        if self.numeric_first:
            data = cast_fill(data, self.numeric_first)
        if self.model is None:
            return data
        res = self.model.transform(data)
        std_arr = vector_to_array("__std_out") if self.std_cols else None
        sel = []
        for c in data.columns:
            if c in self.std_cols:
                sel.append(F.element_at(std_arr, self.std_cols.index(c) + 1).alias(c))
            elif c in self.cur and self.cur[c] != c:
                sel.append(F.col(self.cur[c]).alias(c))
            else:
                sel.append(F.col(c))
        return res.select(*sel)


def fit_spec(df: DataFrame, spec: dict, **kw) -> FittedSpec | None:
    """Fit a spec once (on a training set) for reuse on other sets."""
    chains = parse_transform(spec)
    if not any(ch[0].kind != "delete" for ch in chains if ch):
        return None
    return _fitted(df, spec, kw.pop("relative_error", DF.QUANTILE_RELATIVE_ERROR), kw.pop("handle_invalid", "error"), **kw)


# ---------------------------------------------------------------- single operators
def _finish(df: DataFrame, in_col: str, out_col: str, drop: bool) -> DataFrame:
    return df.drop(in_col) if drop and in_col != out_col else df


def apply_columns(df: DataFrame, op, ins, outs, **kw) -> DataFrame:
    """Apply a single-column operator to one column, or pairwise to lists
    of input and output columns (lengths must match)."""
    if isinstance(ins, str):
        return op(df, ins, outs, **kw)
    if len(ins) != len(outs):
        raise ValueError("input and output column lists differ in length")
    for i, o in zip(ins, outs):
        df = op(df, i, o, **kw)
    return df


def binarizer(df, in_col, out_col, threshold: float = DF.BINARIZER_THRESHOLD, drop: bool = False):
    """``x > threshold`` -> 1.0 else 0.0."""
    return _finish(MF.Binarizer(threshold=threshold, inputCol=in_col, outputCol=out_col).transform(df),
                   in_col, out_col, drop)


def string_indexer(df, in_col, out_col, handle_invalid: str = "error", order: str = "frequencyDesc"):
    """Index strings by descending frequency (ties alphabetical). Returns
    ``(df, model)``; reuse the model on other sets."""
    m = MF.StringIndexer(inputCol=in_col, outputCol=out_col, handleInvalid=handle_invalid,
                         stringOrderType=order).fit(df)
    return m.transform(df), m


def index_to_string(df, in_col, out_col, labels):
    """Index -> label."""
    return MF.IndexToString(inputCol=in_col, outputCol=out_col, labels=list(labels)).transform(df)


def onehot(df, in_col, out_col, drop_last: bool = False, drop: bool = False, handle_invalid: str = "error"):
    """String index then one-hot, without dropping the last category."""
    mid = f"__{out_col}_idx"
    idx = MF.StringIndexer(inputCol=in_col, outputCol=mid, handleInvalid=handle_invalid).fit(df).transform(df)
    enc = MF.OneHotEncoder(inputCol=mid, outputCol=out_col, dropLast=drop_last).fit(idx)
    return _finish(enc.transform(idx).drop(mid), in_col, out_col, drop)


def normalizer(df, in_col, out_col, p: float = DF.NORMALIZER_P):
    """P-norm normalisation of a vector column."""
    return MF.Normalizer(inputCol=in_col, outputCol=out_col, p=p).transform(df)


def _vec(df, in_col):
    if df.schema[in_col].dataType.typeName() == "vector":
        return df, in_col, False
    tmp = f"__{in_col}_vec"
    return MF.VectorAssembler(inputCols=[in_col], outputCol=tmp).transform(df), tmp, True


def _scalar_back(df, tmp_out, out_col, was_scalar):
    if not was_scalar:
        return df
    return df.withColumn(out_col, vector_to_array(tmp_out)[0]).drop(tmp_out)


def standard_scaler(df, in_col, out_col, with_std: bool = True, with_mean: bool = True, drop: bool = False):
    """(x - mean) / sample std; std 0 -> 0. Scalar or vector column."""
    d, vin, scalar = _vec(df, in_col)
    tmp = f"__{out_col}_v" if scalar else out_col
    m = MF.StandardScaler(inputCol=vin, outputCol=tmp, withStd=with_std, withMean=with_mean).fit(d)
    r = m.transform(d)
    r = _scalar_back(r, tmp, out_col, scalar)
    if scalar:
        r = r.drop(vin)
    return _finish(r, in_col, out_col, drop)


def min_max_scaler(df, in_col, out_col, min_: float = DF.MIN_MAX_RANGE[0], max_: float = DF.MIN_MAX_RANGE[1]):
    """C11: rescale to [min, max]; a constant column maps to the midpoint."""
    d, vin, scalar = _vec(df, in_col)
    tmp = f"__{out_col}_v" if scalar else out_col
    r = MF.MinMaxScaler(inputCol=vin, outputCol=tmp, min=min_, max=max_).fit(d).transform(d)
    r = _scalar_back(r, tmp, out_col, scalar)
    return r.drop(vin) if scalar else r


def max_abs_scaler(df, in_col, out_col, drop: bool = False):
    """Divide by the largest absolute value (keeps sparsity)."""
    d, vin, scalar = _vec(df, in_col)
    tmp = f"__{out_col}_v" if scalar else out_col
    r = MF.MaxAbsScaler(inputCol=vin, outputCol=tmp).fit(d).transform(d)
    r = _scalar_back(r, tmp, out_col, scalar)
    if scalar:
        r = r.drop(vin)
    return _finish(r, in_col, out_col, drop)


def bucketizer(df, in_col, out_col, splits, handle_invalid: str = "error", drop: bool = False):
    """Bucket number from explicit splits (left-closed, last bucket closed)."""
    r = MF.Bucketizer(splits=list(splits), inputCol=in_col, outputCol=out_col,
                      handleInvalid=handle_invalid).transform(df)
    return _finish(r, in_col, out_col, drop)


def vector_assembler(df, input_cols, out_col, drop: bool = False, handle_invalid: str = "error"):
    """Assemble columns into one vector, optionally dropping the inputs."""
    r = MF.VectorAssembler(inputCols=list(input_cols), outputCol=out_col,
                           handleInvalid=handle_invalid).transform(df)
    return r.drop(*input_cols) if drop else r


def discretizer(df, in_col, out_col, num_buckets: int = DF.QUANTILE_NUM_BUCKETS,
                relative_error: float = DF.QUANTILE_RELATIVE_ERROR,
                handle_invalid: str = "error", drop: bool = False):
    """C4: quantile buckets; duplicate cut points collapse. ``relative_error`` 0:
    exact quantiles, no column goes through the driver."""
    if relative_error == 0:
        splits = _splits(exact_quantiles(df, [in_col], [num_buckets])[0])
        b = MF.Bucketizer(splits=splits, inputCol=in_col, outputCol=out_col, handleInvalid=handle_invalid)
        return _finish(b.transform(df), in_col, out_col, drop)
    m = MF.QuantileDiscretizer(numBuckets=num_buckets, inputCol=in_col, outputCol=out_col,
                               relativeError=relative_error, handleInvalid=handle_invalid).fit(df)
    return _finish(m.transform(df), in_col, out_col, drop)


def untransform(df, in_col, out_col):
    """C14: copy a column under a new name."""
    return df.withColumn(out_col, F.col(in_col))


def vector_indexer(df, in_col, out_col, max_categories: int = DF.VECTOR_INDEXER_MAX_CATEGORIES):
    """Slots with at most ``max_categories`` distinct values become
    category indices; others are kept."""
    m = MF.VectorIndexer(inputCol=in_col, outputCol=out_col, maxCategories=max_categories).fit(df)
    return m.transform(df), m


def vector_slicer(df, in_col, out_col, indices):
    """Keep the given slots of a vector."""
    return MF.VectorSlicer(inputCol=in_col, outputCol=out_col, indices=list(indices)).transform(df)


def r_formula(df, formula: str, features_col: str = "features", label_col: str = "label"):
    """C17: R model formula -> features vector and label."""
    return MF.RFormula(formula=formula, featuresCol=features_col, labelCol=label_col).fit(df).transform(df)


def chisq_selector(df, num_top_features: int = 1, features_col: str = "features", output_col: str = "selected",
                   label_col: str = "label"):
    """Top-k categorical features by chi-square against a categorical
    label. Returns ``(df, selected feature indices)``."""
    sel = MF.UnivariateFeatureSelector(featuresCol=features_col, outputCol=output_col, labelCol=label_col,
                                       selectionMode="numTopFeatures")
    sel.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(num_top_features)
    m = sel.fit(df)
    return m.transform(df), list(m.selectedFeatures)
