"""Equal-average search and vector codes, against plain search over all entries."""

import hashlib
import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from inputs import SF_SMALL

from fmspark.llm import vector_codes as V


def all_entries(pieces, book):
    dist = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in book] for p in pieces]
    return [min(range(len(book)), key=lambda j: (d[j], j)) for d in dist], [min(d) for d in dist]


@pytest.mark.parametrize("d,m,top", [(1, 16, 3), (2, 16, 4), (8, 16, 500), (8, 3, 2), (3, 1, 9), (4, 16, 2 ** 31), (0, 4, 1)])
def test_search_equals_all_entries(d, m, top):
    rng = np.random.default_rng(d * m)
    book = rng.integers(-top, top + 1, (m, d))
    pieces = np.concatenate([rng.integers(-top, top + 1, (200, d)), book])  # ties abound where `top` is small
    entry, dist, looked = V.nearest_entries(pieces, book)
    assert (entry.tolist(), [int(x) for x in dist]) == all_entries(pieces, book)
    assert looked <= len(pieces) * m


def test_search_looks_at_few_entries():
    rng = np.random.default_rng(1)
    book = np.arange(64)[:, None] * 100 + rng.integers(0, 5, (64, 8))
    _, _, looked = V.nearest_entries(np.repeat(book, 20, axis=0), book)
    assert looked < 3 * 20 * 64


def brute(rows, parts=8, entries=16, rounds=6):
    """The same by definition, on lists."""
    kept = [(i, lab, v) for i, lab, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return {}, None
    width = -(-max(len(v) for _, _, v in kept) // parts)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    ints = [[math.floor(Fraction(x) * 4096) for x in v] + [0] * (width * parts - len(v)) for _, _, v in kept]
    piece = lambda v, p: v[p * width:(p + 1) * width]
    books = [[piece(v, p) for v in ints[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            entry, _ = all_entries([piece(v, p) for v in ints], books[p])
            for e in range(len(books[p])):
                mine = [piece(v, p) for v, x in zip(ints, entry) if x == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [all_entries([piece(v, p) for v in ints], books[p]) for p in range(parts)]
    out = []
    for k, (i, lab, _) in enumerate(kept):
        out.append((i, lab, "".join(f"{found[p][0][k]:02x}" for p in range(parts)), sum(found[p][1][k] for p in range(parts))))
    text = ",".join(str(x) for b in books for e in b for x in e)
    return out, hashlib.sha256(text.encode()).hexdigest()


def run(spark, rows, extra=""):
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], "vec_id long, label int, embedding array<double>, id long, vec int").repartition(3)
    got = V.vectors(df)
    books = V.fit(got)
    return V.compress(got, books), books


def test_equals_the_definition_on_awkward_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), int(i) % 3 if i % 7 else None, (rng.normal(size=16) / 3).tolist()) for i in range(90)]
    rows += [(4, 1, rows[4][2]), (4, 1, [0.5] * 16), (None, 2, [0.25] * 16), (200, 0, None), (201, 0, [1.0, None] + [0.0] * 14),
             (202, 0, [float("nan")] * 16), (203, 0, [float("inf")] * 16), (204, 1, []), (205, 1, [0.1, -0.2, 0.3]), (206, 1, [0.0] * 16)]
    codes, books = run(spark, rows)
    want, sha = brute(rows)
    key = lambda r: tuple(-10 ** 9 if x is None else x for x in r)
    got = [(r.id, r.label, r.code.hex(), r.error) for r in codes.collect()]
    assert sorted(got, key=key) == sorted(want, key=key) and books.sha256() == sha
    per = {}
    for _, lab, _, e in want:
        per[lab] = per.get(lab, 0) + e
    assert {r.label: r.label_error for r in V.label_errors(codes).collect()} == per
    near = V.decompress(codes, books).collect()
    for r in near:
        flat = [x / 4096 for p in range(8) for x in books.books[p][r.code[p]]]
        assert r.vec == flat


def test_very_large_numbers_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, 0, [float(x) for x in rng.normal(size=8) * 10.0 ** int(rng.integers(-3, 300))]) for i in range(25)]
    rows += [(30, 1, [1.7e308] * 8), (31, 1, [5e-324] * 8), (32, 2, [1e9] * 8)]
    codes, books = run(spark, rows)
    want, sha = brute(rows)
    assert books.sha256() == sha
    assert sorted((r.id, r.code.hex(), r.error) for r in codes.collect()) == sorted((i, c, e if e < 2 ** 63 else None) for i, _, c, e in want)
    sums = {r.label: r.label_error for r in V.label_errors(codes).collect()}
    assert sums[0] is None


def test_few_and_no_vectors(spark):
    rows = [(1, None, [0.5] * 8), (2, None, [1.0] * 8)]
    codes, books = run(spark, rows)
    assert sorted((r.id, r.code.hex(), r.error) for r in codes.collect()) == [(1, "00" * 8, 0), (2, "01" * 8, 0)]
    assert books.sha256() == brute(rows)[1]
    codes, books = run(spark, [(1, 2, None)])
    assert codes.count() == 0 and V.label_errors(codes).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_SMALL}/embeddings.parquet'")
    want = con.execute(V.ORACLE).fetchall()
    got = [tuple(r) for r in V.query(spark, SF_SMALL).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()]
    assert sorted(got) == sorted(want)
