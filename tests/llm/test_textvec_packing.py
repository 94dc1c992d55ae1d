"""Vectorised text helpers, and packing against its definition."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fmspark.llm import packing as P
from fmspark.llm import textvec as T
from fmspark.llm import wordids as W

ODD = ["", None, "x", " lead trail \n", "a b  c a b c a", "été là\tö\x0bz", "a\x1cb\x85c", "w" * 5000, "一 二 三 四 五 六", "a " * 3000]


def test_words_are_runs_of_other_bytes():
    for i, j, w in T.each_slice(pa.array(ODD)):
        assert w.count.tolist() == [len((t or "").encode().split()) for t in ODD[i:j]]


def test_equal_words_and_only_they_share_hashes():
    texts = ["ab abc abcdefgh abcdefghi abcdefghj ab", "abcdefgh" * 3 + " " + "abcdefgh" * 3 + "x"]
    seen = {}
    for i, j, w in T.each_slice(pa.array(texts)):
        for word, h in zip(b" ".join(t.encode() for t in texts[i:j]).split(), w.hashes.tolist()):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_shingles_repeat_and_short_texts():
    words = "a b c d e a b c d e f".split()
    (_, _, w), = T.each_slice(pa.array([" ".join(words), "p q", None]))
    h, text = w.shingles(5)
    assert np.bincount(text, minlength=3).tolist() == [7, 1, 0]
    assert h[0] == h[5] and len(set(h[:7].tolist())) == 6
    assert T.occurrence(h[:7]).tolist() == [0, 0, 0, 0, 0, 1, 0]


def test_slices_do_not_change_hashes():
    texts = [f"w{i} x{i % 7} y z" * 50 for i in range(300)]
    whole = np.concatenate([w.shingles()[0] for _, _, w in T.each_slice(pa.array(texts))])
    single = np.concatenate([T.bag_of(t) for t in texts])
    assert (whole == single).all()


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(W.vocabulary_path(P.VOCABULARY))


@pytest.mark.parametrize("bits,pool", [(20, 1 << 20), (4, 1 << 20), (10, 300)])
def test_encoder_equals_the_tokenizer(tokenizer, bits, pool):
    enc = W.Encoder(W.vocabulary_path(P.VOCABULARY), table_bits=bits, pool=pool)
    rnd = random.Random(3)
    parts = ["a", "B", "'s", "é", " ", "1", "\x1c", "\x85", "  ", ".", "<|endoftext|>", "　", "ẛ̣", "Σς", "ﬁ", "한", "\n", "q" * 300, "Word,", "don't!", "ÉTÉ.", "İx", "I'LL", "…!", "e\u0301", "ß", "µ"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(600)] + [None, ""]
    buf, offs = T.utf8(pa.array(texts))
    for i in range(0, len(texts), 7):
        j = min(i + 7, len(texts))
        ids, first = enc.encode(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        for k, text in enumerate(texts[i:j]):
            assert ids[first[k]:first[k + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_encoder_tells_words_of_one_first_hash_apart(tokenizer, monkeypatch):
    real = W.word_keys
    monkeypatch.setattr(W, "word_keys", lambda w: (real(w)[0] % np.uint64(3), real(w)[1]))
    enc = W.Encoder(W.vocabulary_path(P.VOCABULARY))
    text = " ".join(f"word{i} Letters{'abc'[i % 3] * i}!" for i in range(30))
    for _ in range(3):
        buf, offs = T.utf8(pa.array([text, None]))
        ids, first = enc.encode(buf, offs)
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids and first.tolist() == [0, len(ids), len(ids)]


@pytest.mark.parametrize("capacity,n", [(10, 50), (64, 2000), (512, 5000), (4096, 4000)])
def test_plan_holds_every_item_once(capacity, n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(np.log(capacity) - 2, 1, n).astype(int), 1, capacity)
    counts = np.bincount(lengths, minlength=capacity + 1)
    got = np.zeros(capacity + 1, int)
    sequences = 0
    for pattern, times in P.plan(counts, capacity):
        assert sum(pattern) <= capacity and times > 0
        np.add.at(got, list(pattern), times)
        sequences += times
    assert (got == counts).all()
    assert sequences <= -(-lengths.sum() // capacity) * 1.02 + 1


def test_plan_uses_exact_complements():
    counts = np.zeros(11, int)
    counts[[7, 3]] = 5, 5
    assert P.plan(counts, 10) == [((7, 3), 5)]
    assert P.plan(np.zeros(11, int), 10) == []


def test_pack_places_every_piece(spark, tokenizer):
    texts = ODD + ["same words here"] * 40 + ["many words " * 300] * 3
    docs = spark.createDataFrame([(None if i == 5 else i % 50, t) for i, t in enumerate(texts)], "doc_id long, text string")
    pieces = P.pieces(docs, capacity=256, with_ids=True)
    rows = P.pack(pieces, 256).collect()
    want = []
    for i, t in enumerate(texts):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for n, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at:at + 256], "<u4").tobytes()
            want.append((None if i == 5 else i % 50, n, at, len(part) // 4, zlib.crc32(part)))
    key = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    whole = P.sequences(P.pack(pieces, 256)).collect()
    assert all(len(r.ids) == 4 * r.n_tokens <= 1024 for r in whole)


def test_pack_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack(P.pieces(none)).count() == 0


def test_extra_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6)], "doc_id long, text string, length long, sequence_id long")
    assert P.pack(P.pieces(docs)).where(F.col("length") == 3).count() == 1
