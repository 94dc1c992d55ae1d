"""Directly addressable codes and the token files, against the ids themselves."""

import zlib

import numpy as np
import pytest
from inputs import SF_SMALL
from pyspark.sql import functions as F

from fmspark.llm import token_files as K
from fmspark.llm.wordids import vocabulary_path


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16])
@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (7, 2), (512, 70_000), (513, 300), (5000, 1 << 20), (4096, 1 << 40)])
def test_segment_round_trip_and_access(bits, n, top):
    rng = np.random.default_rng(n + bits)
    ids = (rng.random(n) ** 6 * top).astype(np.uint64)
    seg = K.Segment(K.encode_segment(ids, bits))
    assert len(seg) == n and (seg.slice(0, n) == ids).all()
    at = rng.integers(0, n, 300) if n else np.zeros(0, np.int64)
    assert (seg.at(at) == ids[at]).all()
    for _ in range(40):
        lo = int(rng.integers(0, n + 1))
        size = int(rng.integers(0, n - lo + 1))
        assert (seg.slice(lo, size) == ids[lo:lo + size]).all()
    for level in range(len(seg.chunks) - 1):
        bitmap = np.unpackbits(seg.bitmaps[level].view(np.uint8), bitorder="little")
        m = len(seg.chunks[level])
        pos = np.unique(rng.integers(0, m + 1, 50))
        assert (seg.rank(level, pos) == [bitmap[:p].sum() for p in pos]).all()


def test_bad_access_is_refused():
    seg = K.Segment(K.encode_segment(np.arange(10)))
    with pytest.raises(IndexError):
        seg.at(np.array([10]))
    with pytest.raises(IndexError):
        seg.slice(5, 6)
    with pytest.raises(ValueError):
        K.Segment(b"????" + bytes(20))


def expected(rows, end=K.END_ID):
    """Ids in ascending order of (id, null last); ties stay open."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary_path(K.VOCABULARY))
    return [(d, tok.encode(t or "", add_special_tokens=False).ids + [end]) for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0]))]


def test_query_equals_the_tokenizer(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want, at = [], 0
    for d, ids in expected(docs):
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = K.query(spark, SF_SMALL)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_odd_rows_small_segments_and_lookup(spark, scratch):
    long = "some very long text, " * 5000
    rows = [(5, None), (3, ""), (None, "no id"), (3, "a b"), (3, "a b"), (2 ** 60, long), (-7, "x\x85y  <|endoftext|>"), (None, None), (5, "Tie!"), (8, "été 12")]
    docs = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, part int, seg int, data int").repartition(3)
    K.write_tokens(docs, scratch, segment=50, bits=5)
    back = K.read_documents(spark, scratch, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in back] == [-7, 3, 3, 3, 5, 5, 8, 2 ** 60, None, None]
    at, flat = 0, []
    for r in back:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and r.ids_crc32 == zlib.crc32(r.ids)
        at, flat = at + len(ids), flat + ids
    want = expected(rows)
    assert sorted((r.doc_id is None, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in back if r.doc_id is not None) \
        == sorted((False, d, ids) for d, ids in want if d is not None)
    assert spark.read.parquet(f"{scratch}/segments").count() > 3
    ask = spark.createDataFrame([(p,) for p in [0, 0, 1, at - 1, at, at + 70, -1, None] + list(range(5, at, 997))], "position long")
    got = {r.position: r.token_id for r in K.tokens_at(ask, scratch, segment=50).collect()}
    assert got == {p: flat[p] for p in {0, 1, at - 1} | set(range(5, at, 997))}


def test_equal_rows_spread_and_rerun_alike(spark, scratch):
    docs = spark.range(4000).select((F.col("id") % 3).alias("doc_id"), F.when(F.col("id") % 2 == 0, "same text here").otherwise("other").alias("text"))
    K.write_tokens(docs, f"{scratch}/a", segment=100)
    K.write_tokens(docs.repartition(5), f"{scratch}/b", segment=100)
    a, b = (sorted(tuple(r) for r in K.read_documents(spark, f"{scratch}/{x}").collect()) for x in "ab")
    assert a == b and len(a) == 4000
    assert spark.read.parquet(f"{scratch}/a/parts").count() > 3


def test_empty_table(spark, scratch):
    K.write_tokens(spark.createDataFrame([], "doc_id long, text string"), scratch)
    assert K.read_documents(spark, scratch).count() == 0
    assert K.tokens_at(spark.createDataFrame([(0,)], "position long"), scratch).count() == 0
