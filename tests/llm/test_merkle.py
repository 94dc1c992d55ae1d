"""Merkle manifest against the tree built on lists."""

import hashlib
import zlib

import duckdb
import pytest
from inputs import SF_SMALL
from pyspark.sql import functions as F

from fmspark.llm import merkle as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    vals = [row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4]]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals])


def tree(digests):
    """All levels and the siblings of each bottom node, None where alone."""
    levels = [list(digests)]
    while len(levels[-1]) > 1:
        a = levels[-1]
        levels.append([sha(*a[i:i + 2]) for i in range(0, len(a), 2)])
    return levels


def siblings(levels, i):
    out = []
    for a in levels[:-1]:
        j = i ^ 1
        out.append((i & 1, a[j] if j < len(a) else None))
        i >>= 1
    return out


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for n in names:
        langs[n].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[n] = tree([leaf_of(r) for r in langs[n]])
    top = tree([trees[n][-1][0] for n in names])
    out = []
    for at, n in enumerate(names):
        for i, r in enumerate(langs[n]):
            path = siblings(trees[n], i) + siblings(top, at)
            bad = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            h = leaf_of(r, 1 if bad else 0)
            for side, s in path:
                h = sha(h) if s is None else sha(s, h) if side else sha(h, s)
            root = top[-1][0]
            out.append((r[0], leaf_of(r), trees[n][-1][0], root, sha(*[s for _, s in path if s]), h, h == root))
    return out


@pytest.fixture()
def result(spark, monkeypatch):
    def run(rows, levels=M.LEVELS, parts=3):
        docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", idx long, digest int").repartition(parts)
        monkeypatch.setattr(M, "documents", lambda *_: docs)
        real = M.manifest
        monkeypatch.setattr(M, "manifest", lambda d, **k: real(d, levels=levels, **k))
        got = [tuple(r) for r in M.query(spark, "").collect()]
        monkeypatch.setattr(M, "manifest", real)
        return got
    return run


def key(r):
    return tuple("" if x is None else str(x) for x in r)


@pytest.mark.parametrize("levels", [1, 8])
def test_equals_the_tree_on_lists(result, levels):
    rows = [(i, "web", ["en", "de", "fr"][i % 3 if i % 5 else 0], i * 3, f"text {i}") for i in range(77)]
    rows += [(None, None, None, None, None), (1, "s", "en", None, "é\nü"), (1, "s", "en", 5, ""), (1, "s", "en", 5, ""), (2 ** 62, "", "", 2 ** 63 - 1, "x" * 5000),
             (None, "a", "en", 1, "t"), (-5, "b", "Ü", 2, "neg"), (7, "only", "zz", 0, None)]
    assert sorted(result(rows, levels), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("sizes", [[], [1], [17], [1, 2, 3, 4, 5, 8, 9, 16, 17]])
def test_sizes_around_blocks(result, sizes):
    rows = [(i, "a", f"lang {n}", 1, str(i)) for n in sizes for i in range(n)]
    assert sorted(result(rows, levels=2), key=key) == sorted(brute(rows), key=key)


def test_many_equal_rows_span_ranges(result):
    rows = [(3, "a", "en", 1, "same")] * 150 + [(i, "a", "de", 1, str(i)) for i in range(20)]
    got = result(rows, levels=3)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_a_changed_row_is_found(spark):
    docs = spark.createDataFrame([(i, "a", "en", i, "t") for i in range(50)], SCHEMA)
    rows = M.manifest(docs)
    other = M.fold(F.sha2(F.lit("other"), 256), F.col("path"))
    assert rows.where((M.fold(F.col("leaf"), F.col("path")) != F.col("root")) | (other == F.col("root"))).count() == 0


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    got = M.query(spark, SF_SMALL)
    want = con.execute(M.ORACLE)
    assert [c[0] for c in want.description] == got.columns
    want = want.fetchall()
    got = [tuple(r) for r in got.collect()]
    assert len(want) == len(got) and sorted(got, key=key) == sorted(want, key=key)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)
