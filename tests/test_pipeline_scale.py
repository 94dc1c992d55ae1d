"""pipeline_end_to_end at size: lines, pairs and training rows go through Arrow batches and blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fmspark.functions import inrow as B
from fmspark.functions import sparse as S
from fmspark.operators import embed as E
from fmspark.operators import fm_train as T
from fmspark.operators import rows as R
from fmspark.sinks import writers as W
from fmspark.sources import libsvm as L

PAIRS = "row_id string, label double, features array<struct<idx:int,val:double>>"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_have_the_text_of_each_number(spark):
    inf, nan = float("inf"), float("nan")
    odd = [[(1, 0.5), (2, 1.0), (3, 0.0), (4, -0.0), (5, 100.0), (6, -3.25)], [], None, [(1, 1e7), (2, 1e15), (3, -1e300), (4, 1e-5)],
           [(1, None), (None, 2.0), (None, 1.0), (3, 3.5)], [None, (1, 2.0), None, (2, 0.25)], [(1, nan), (2, inf), (3, -inf), (4, 9999999.0)]]
    df = spark.createDataFrame([(f"r{i}" if i else None, 1.0 if i else None, f) for i, f in enumerate(odd)], PAIRS).coalesce(1)
    body = S.format_pairs("features")
    for got, head in ((W.fm_lines(df), S.fmt_num(F.col("label"))), (W.prd_lines(df, key="row_id"), F.col("row_id"))):
        assert [r[0] for r in got.collect()] == [r[0] for r in df.select(F.concat_ws(" ", head, body)).collect()]
        assert "MapInArrow" in _plan(got) and "transform" not in _plan(got)


def test_odd_lines_parse_as_expressions_do(spark):
    lines = ["1 1:0.5 2:1", " 0  3:-0 4:1e5   7:1.0E-5 ", "1", "-1.5 1:2\t2:3", "+1 +5:1", "1 5", "1 3:0:1", "1 007:1 2:.5 3:5.", "1 1:NaN 2:Infinity",
             "1 2147483647:1", "1 1:12345678901234567890123 2:0.1234567890123456789012345", None]
    df = spark.createDataFrame([(str(i), x) for i, x in enumerate(lines)], "row_id string, value string")
    t = S.tokens("value")
    want = df.select("row_id", t[0].cast("double").alias("label"), S.parse_pairs(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0)))).alias("features"))
    assert sorted(map(str, L.parse_lines(df).collect())) == sorted(map(str, want.collect()))
    assert "MapInArrow" in _plan(L.parse_lines(df))
    for bad in ("1 a:1", "1 1:z", "x 1:1", "1 3000000000:1", "1 1:"):
        one = spark.createDataFrame([("r", bad)], "row_id string, value string")
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            L.parse_lines(one).collect()
        assert L.parse_lines(one, bad="null").count() == 1


@pytest.mark.parametrize("at_once", [3, 10_000])
def test_repeated_lines_are_counted_not_sorted(spark, monkeypatch, at_once):
    def sorted_rows(*a, **k):
        raise AssertionError("equal lines need no order")
    monkeypatch.setattr(L, "numbered", sorted_rows)
    monkeypatch.setattr(L, "MADE_AT_ONCE", at_once)
    lines = spark.createDataFrame([("1 1:1",)] * 8 + [("0 2:1",)] * 3 + [("0 3:1",), ("1 4:1",)], "value string").repartition(3)
    got = {}
    for r in L.with_row_ids(lines).collect():
        got.setdefault(r.value, []).append(r.row_id)
    for text, n in (("1 1:1", 8), ("0 2:1", 3), ("0 3:1", 1), ("1 4:1", 1)):
        first = sorted(got[text], key=len)[0]
        assert sorted(got[text]) == sorted([first, *[f"{first}-{i}" for i in range(1, n)]])


def test_unique_rows_are_embedded_where_they_are(spark):
    rows = spark.createDataFrame([("a", 1.0, [(1, 0.5), (6, 1.0), (7, 0.0), (8, 1.0), (3, None)]), ("b", None, []), ("c", 2.0, None),
                                  ("d", 0.0, [(8, 1.0), (8, 1.0), (1, 2.0), (None, 1.0)]), ("e", 1.0, [(4, 0.1)]), ("f", 1.0, [None, (6, 1.0), (9, 0.5)])], PAIRS)
    latent = spark.createDataFrame([(6, [0.25, -1.0]), (8, [3.0])], "idx int, v array<double>")
    for append in (True, False):
        for numbering, dense in (("offset", False), ("zero", False), ("zero", True)):
            how = dict(append=append, numbering=numbering, dense=dense, keep=("label",))
            want, got = E.embed(rows, latent, 5, **how), E.embed(rows, latent, 5, in_row=True, unique=True, **how)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.dtypes == want.dtypes
            assert "Exchange" not in _plan(got) and "Sort" not in _plan(got)


def test_blocks_hold_every_row(spark):
    rng = np.random.default_rng(3)
    sizes = [0, 3, 1200, 700, *rng.integers(0, 9, 400)]
    rows = [(float(i % 2), [(int(j), float(i + j)) for j in range(n)] if i != 5 else None, int(i % 3)) for i, n in enumerate(sizes)]
    rows[9][1].append((None, 5.0))
    df = spark.createDataFrame(rows, "label double, features array<struct<idx:int,val:double>>, batch int").coalesce(2)
    got, n_blocks = {0: [], 1: [], 2: []}, 0
    for b in T._blocks(df).toArrow().combine_chunks().to_batches():
        for i in range(b.num_rows):
            part = b.slice(i, 1)
            y, n, idx, x = (B.unpacked(part.column(c), k) for c, k in (("y", float), ("n", np.int32), ("idx", np.int32), ("x", float)))
            at = np.cumsum(n) - n
            got[part.column("batch")[0].as_py()] += [(y[r], [(int(a), float(v)) for a, v in zip(idx[at[r]:at[r] + n[r]], x[at[r]:at[r] + n[r]])]) for r in range(len(n))]
            n_blocks += 1
    want = {k: [(y, [p for p in f or [] if p[0] is not None]) for y, f, c in rows if c == k] for k in got}
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()} and 5 < n_blocks < 100


def test_reindex_leaves_zeros_out(spark):
    rows = spark.createDataFrame([("a", 1.0, [(5, 4.0), (9, 0.0), (7, None), (9, -0.0), (9, 3.0)]), ("b", 0.0, []), ("c", 0.0, None)], PAIRS)
    fmap = spark.createDataFrame([(5, 0, 2.0), (7, 1, 1.0), (9, 2, 3.0)], "idx int, pos int, s double")
    for budget in (None, 1):
        got = {r.row_id: [tuple(p) for p in r.features] for r in R.reindex(rows, fmap, once=True, keep_zero=False, max_broadcast_bytes=budget).collect()}
        assert got == {"a": [(0, 2.0), (2, 1.0)], "b": [], "c": []}
