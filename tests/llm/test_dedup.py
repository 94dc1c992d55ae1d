"""Near-duplicates of documents and paragraphs against all pairs; components."""

import collections
import random

import numpy as np
import pyarrow as pa
import pytest

from fmspark.llm import near_dedup as N
from fmspark.llm import paragraphs as P
from fmspark.llm import similar as S
from fmspark.llm import textvec as T
from fmspark.llm.components import components
from fmspark.llm.similar import bands_for

SF = "/root/testdata/sf0.001"


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def links_of(bags, measure, threshold=0.8):
    """All pairs that share a shingle and reach the threshold."""
    by = collections.defaultdict(set)
    for k, bag in bags.items():
        for s in set(bag.tolist()):
            by[s].add(k)
    pairs = {(a, b) for ks in by.values() for a in ks for b in ks if a < b}
    return [(a, b) for a, b in pairs if measure(bags[a], bags[b]) >= threshold]


def families(seed=5):
    """Clean documents, exact copies, near copies, chains of near copies."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    texts = [" ".join(word() for _ in range(rnd.randint(60, 300))) for _ in range(40)]
    out = list(texts)
    for t in texts[:8]:
        out += [t] * rnd.randint(1, 6)
    for t in texts[8:16]:
        for _ in range(rnd.randint(1, 12)):
            w = t.split()
            w[rnd.randrange(len(w))] = "edited"
            out.append(" ".join(w))
    chain = texts[16].split()
    for _ in range(12):
        at = rnd.randrange(len(chain) - 3)
        chain = chain[:at] + [word(), word()] + chain[at + 2:]
        out.append(" ".join(chain))
    return out + ["", None, " \n", "one two", "one two", "a b c d e"]


def test_components_of_any_shape(spark):
    rnd = random.Random(2)
    edges = [(0, i) for i in range(1, 60)] + [(100 + i, 101 + i) for i in range(40)] + [(200, 200), (300, 301), (301, 300)]
    edges += [(rnd.randrange(400, 440), rnd.randrange(400, 440)) for _ in range(30)]
    want = roots({x for e in edges for x in e}, edges)
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert {r.node: r.root for r in got.collect()} == {n: r for n, r in want.items() if n != r}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_dart_signatures_estimate_weighted_jaccard():
    rnd = np.random.default_rng(4)
    a = T.stream(400, 1)
    b = np.concatenate([a[:300], T.stream(100, 2)])
    element, text = np.concatenate([a, b]), np.repeat([0, 1], [400, 400])
    sig = N.dart_signatures(element, text, np.array([400, 400]), 512)
    assert abs((sig[0] == sig[1]).mean() - 300 / 500) < 0.08
    alone = N.dart_signatures(b, np.zeros(400, np.int64), np.array([400]), 512)
    assert (alone[0] == sig[1]).all()  # a text's signature is its own
    short = N.dart_signatures(a[:1], np.zeros(1, np.int64), np.array([1]), 72)
    assert (short != N.EMPTY).all()
    assert N.dart_signatures(a[:0], np.zeros(0, np.int64), np.array([0]), 8).shape == (1, 8)
    del rnd


def test_bands_reach_the_recall():
    assert 1 - (1 - 0.8 ** 4) ** bands_for(0.8, 0.9999, 4) >= 0.9999


def test_near_classes_against_all_pairs(spark):
    texts = families()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    rows, classes = N.near_classes(docs)
    named = N.labelled(rows, classes).collect()
    bags = {i: T.bag_of(t) for i, t in enumerate(texts)}
    want = roots(bags, links_of(bags, T.weighted_jaccard))
    first = {}
    for r in sorted(named, key=lambda r: r._id):
        if r.root is not None:
            first.setdefault(bytes(r.root), r._id)
    assert {r._id: r._id if r.root is None else first[bytes(r.root)] for r in named} == want
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_large_buckets_against_all_pairs(spark, monkeypatch):
    """Buckets beyond ``SMALL`` go through blocks, here of a few texts."""
    monkeypatch.setattr(S, "SMALL", 3)
    monkeypatch.setattr(S, "BLOCK_TEXTS", 5)
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    texts = []
    for _ in range(60):  # most pairs of copies are below the threshold, some are above
        copy = list(base)
        for p in rnd.sample(range(120), rnd.randrange(1, 5)):
            copy[p] = f"x{rnd.randrange(10 ** 9)}"
        texts.append(" ".join(copy))
    bags = {i: T.bag_of(t) for i, t in enumerate(texts)}
    links = links_of(bags, T.weighted_jaccard)
    want = roots(bags, links)
    assert 1 < len(set(want.values())) < 60
    rows, classes = N.near_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    first = {}
    named = sorted(N.labelled(rows, classes).collect(), key=lambda r: r._id)
    for r in named:
        first.setdefault(bytes(r.root), r._id)
    assert {r._id: first[bytes(r.root)] for r in named} == want


def test_overlaps_and_forest():
    rnd = np.random.default_rng(3)
    a, b = ([sorted(rnd.choice(4000, rnd.integers(0, 1800), replace=False).tolist()) for _ in range(n)] for n in (7, 5))
    got = S.overlaps(pa.array([[], *a], pa.list_(pa.int64()))[1:], pa.array(b, pa.list_(pa.int64())))
    assert got.tolist() == [[len(set(x) & set(y)) for y in b] for x in a]
    assert S.forest(np.array([[1, 0, 0], [1, 1, 0], [0, 0, 0]], bool)).tolist() == [0, 0, 2, 0, 0, 5]
    assert S.forest(np.zeros((0, 2), bool)).tolist() == [0, 1]
    assert S.least_matches(0.8, 72) < 58


def test_keep_one_with_repeated_and_null_ids(spark):
    t = "some words that make up a text of more than five"
    docs = spark.createDataFrame([(1, t), (1, t), (None, t), (None, t + " x y"), (2, "other text altogether, not the same at all"), (None, None)],
                                 "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in N.keep_one(docs).collect()), key=str)
    assert (1, t) in got and got.count((1, t)) == 1 and (None, t) not in got
    assert (None, None) in got and len([g for g in got if g[0] == 2]) == 1
    assert N.keep_one(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bags = {i: T.bag_of(t) for i, t in docs.items()}
    want = roots(bags, links_of(bags, T.weighted_jaccard))
    size = collections.Counter(want.values())
    rows = N.query(spark, SF).collect()
    assert {r.doc_id: (r.class_id, r.n_class) for r in rows} == {i: (c, size[c]) for i, c in want.items()}
    assert len({r.class_key for r in rows if r.class_key}) == len({c for i, c in want.items() if len(bags[i])})


def test_one_id_of_two_texts_is_two_classes(spark, monkeypatch):
    a, b = ("words of one text that has no copy", "quite other words in another text here")
    monkeypatch.setattr(N, "documents", lambda *_: spark.createDataFrame([(1, a), (1, b), (2, b), (3, None)], "doc_id long, text string"))
    got = sorted((r.doc_id, r.class_id, r.n_class, r.class_key is None) for r in N.query(spark, "").collect())
    assert got == [(1, 1, 1, False), (1, 1, 2, False), (2, 1, 2, False), (3, 3, 1, True)]
    assert len({r.class_key for r in N.query(spark, "").collect()}) == 3


def cuts(text, radius=P.RADIUS):
    """Paragraphs of a text by definition: lists of words, cut before a word whose
    pair hash is the smallest within ``radius``, the first of equal ones."""
    words = (text or "").encode().split()
    one = [T.Words(np.frombuffer(w, np.uint8), np.array([0, len(w)])).hashes for w in words]
    with np.errstate(over="ignore"):
        pair = [int(T.mix(a * T.GOLDEN + b)[0]) for a, b in zip(one, one[1:])]
    at = [0] if words else []
    for i in range(radius + 1, len(words) - radius - 1):
        if pair[i] == min(pair[i - radius:i + radius + 1]) and pair[i] not in pair[i - radius:i]:
            at.append(i)
    return [words[i:j] for i, j in zip(at, at[1:] + [len(words)])]


def repeats_by_definition(docs):
    """{(id, para): (class, removed)} of runs, for documents of different ids."""
    parts = {(i, k): c for i, t in docs.items() for k, c in enumerate(cuts(t))}
    bags = {k: T.bag_of(b" ".join(c).decode()) for k, c in parts.items()}
    want = roots(bags, links_of(bags, T.jaccard))
    size = collections.Counter(want.values())
    out = {}
    for i in docs:
        run = []
        for k in range(len(docs[i] or "") + 2):
            if (i, k) in parts and size[want[(i, k)]] > 1:
                run.append((i, k))
                continue
            if sum(len(parts[x]) for x in run) >= P.MIN_WORDS:
                out |= {x: (want[x], x != want[x]) for x in run}
            run = []
            if (i, k) not in parts:
                break
    return out


def test_paragraph_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {(r.doc_id, r.para): ((r.class_doc_id, r.class_para), r.removed) for r in P.query(spark, SF).collect()}
    assert got == repeats_by_definition(docs)


def test_paragraphs_fill_the_text():
    rnd = random.Random(8)
    texts = [" \n".join(rnd.choice(["a", "é", "one", "two\tthree"]) + str(rnd.randrange(9)) for _ in range(n)) + rnd.choice(["", " \n"]) for n in (0, 1, 5, 16, 17, 300, 40)]
    texts += [None, "", "  ", "same " * 200]
    found = collections.defaultdict(list)
    for i, c in P.cut_texts(pa.array(texts), P.RADIUS):
        for t, n, b, e, words in zip(c.text, c.nth, c.begin, c.end, c.count):
            found[int(t) + i].append((int(n), int(b), int(e), int(words)))
    for i, t in enumerate(texts):
        want = cuts(t)
        assert [w for *_, w in found[i]] == [len(c) for c in want]
        assert [n for n, *_ in found[i]] == list(range(len(want)))
        raw = (t or "").encode()
        if want:
            assert found[i][0][1] == 0 and found[i][-1][2] == len(raw)
            assert all(x[2] == y[1] for x, y in zip(found[i], found[i][1:]))
            assert [raw[b:e].split() for _, b, e, _ in found[i]] == want


def planted(n, words, seed):
    """Documents in pairs that share one passage, each in its own place among its
    own words and with its own line breaks."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))

    def mixed(ws):
        return "".join(w + rnd.choice([" ", " ", " ", " ", "\n", "  "]) for w in ws)
    out = []
    for _ in range(n):
        passage = [word() for _ in range(words)]
        for _ in range(2):
            out.append(mixed([word() for _ in range(rnd.randrange(0, 80))] + passage + [word() for _ in range(rnd.randrange(0, 80))]))
    return out


@pytest.mark.parametrize("words, least", [(50, 0.9), (60, 0.97)])
def test_passages_of_fifty_words_are_found(spark, words, least):
    texts = planted(150, words, words)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = P.repeats(docs).collect()
    found = {r._id // 2 for r in got if r.removed}
    assert len(found) >= least * 150
    assert all(r.class_id // 2 == r._id // 2 for r in got)  # nothing else is


def test_one_passage_in_the_middle_of_lines(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("klmnopqrst") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(40)) + " " + passage + " " + " ".join(word() for _ in range(40))) for i in range(5)]
    got = P.repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r._id for r in got if r.removed} >= {1, 2, 3, 4} and {r.class_id for r in got} <= {0, 1}


def test_documents_are_told_by_id_and_text(spark):
    rnd = random.Random(4)
    own = lambda n: " ".join("".join(rnd.choice("uvwxyz") for _ in range(7)) for _ in range(n))
    passage = own(70)
    first, second, lone = f"{own(30)} {passage}", f"{passage} {own(30)}", own(90)
    # id 1 stands for two texts with one passage; two null ids; id 8 also has an unrelated text
    rows = [(1, first), (1, second), (None, f"{own(25)} {passage}"), (None, f"{own(25)} {passage}"), (8, f"{passage} {own(20)}"), (8, lone), (1, first)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.repeats(docs).collect()
    removed = {(r._id, bytes(r.doc)) for r in got if r.removed}
    assert len({(r._id, bytes(r.doc)) for r in got}) == 5 and len(removed) == 4
    out = collections.Counter((r.doc_id, r.text) for r in P.without_repeats(docs).collect())
    assert out[(8, lone)] == 1 and sum(out.values()) == 7
    kept = [t for i, t in out if passage[100:-100] in t]
    assert len(kept) == 1 and (kept[0] in (first, second)) and out[(1, kept[0])] in (1, 2)


def test_repeats_are_cut_out(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, f"intro\n{passage}\nend"), (2, passage), (3, "nothing repeated"), (4, None), (5, ""), (None, f"{passage}"), (6, f"{passage}\n{passage}"), (7, " ".join(f"été{i}" for i in range(30)) + " " + passage)]
    docs = spark.createDataFrame([(*r, "a", 7) for r in rows], "doc_id long, text string, _cuts string, para int")
    out = {r.doc_id: r.text for r in P.without_repeats(docs).collect()}
    assert out[1] == f"intro\n{passage}\nend" and out[3] == "nothing repeated" and out[4] is None and out[5] == ""
    for i in (2, None, 6, 7):
        assert len([w for w in out[i].split() if w.startswith("word")]) < 40
    assert [w for w in out[7].split() if w.startswith("été")][:15] == [f"été{i}" for i in range(15)]
    assert P.repeats(docs.limit(0)).count() == 0 and P.without_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("k", [8, 64])
def test_minhash_estimates_jaccard(k):
    a = T.stream(200, 7)
    b = np.concatenate([a[:160], T.stream(40, 8)])
    sig = P.minhash(np.concatenate([a, b]), np.repeat([0, 2], 200), 3, k)
    assert (sig[1] == 0).all()
    assert abs((sig[0] == sig[2]).mean() - 160 / 240) < 0.35
