"""Mixing, nearest neighbours, sharding and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fmspark.llm import mixing as M
from fmspark.llm import nearest as N
from fmspark.llm import sharding as S

SF = "/root/testdata/sf0.001"


def water(words, weights, cap=3.0):
    """Targets by sharing the excess again and again."""
    total, target, full = sum(words), [0.0] * len(words), set()
    rest = float(total)
    while rest > 1e-9:
        free = [i for i in range(len(words)) if i not in full]
        if not free:
            break
        share = sum(weights[i] for i in free)
        for i in free:
            target[i] += rest * weights[i] / share
        rest = 0.0
        for i in free:
            if target[i] >= cap * words[i]:
                rest += target[i] - cap * words[i]
                target[i] = cap * words[i]
                full.add(i)
    return target


@pytest.mark.parametrize("words", [[100, 100, 100], [5, 1000, 5, 3, 700], [0, 10, 0], [1, 1, 1000], [0, 0]])
def test_targets(spark, words):
    weights = [(i % 3) + 1 for i in range(len(words))]
    rows = spark.createDataFrame([(f"s{i}", w, weights[i]) for i, w in enumerate(words)], "source string, words long, weight long")
    got = {r.source: r.target for r in M.targets(rows).collect()}
    want = water(words, weights)
    assert all(abs(got[f"s{i}"] - want[i]) < 1e-6 for i in range(len(words)))


def test_weights_by_code_point_null_last(spark):
    names = ["b", "a", "é", "Z", "𝒳", "", None, "￿"]
    got = {r.source: r.weight for r in M.weights_in_order(spark.createDataFrame([(n,) for n in names], "source string")).collect()}
    ordered = sorted((n for n in names if n is not None)) + [None]
    assert got == {n: i % 3 + 1 for i, n in enumerate(ordered)}


def test_flight_keeps_both_totals():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 50, 400):
        size = sorted((rng.randint(0, 300) for _ in range(n)), reverse=True)
        p = [rng.random() for _ in range(n)]
        out = M.fly(p, size, random.Random(1))
        assert sum(0 < x < 1 for x in out) <= 2
        assert abs(sum(out) - sum(p)) < 1e-6
        assert abs(sum(x * s for x, s in zip(out, size)) - sum(x * s for x, s in zip(p, size))) < 1e-4
        done = M.fly_and_land(p, size, random.Random(1))
        assert all(x in (0.0, 1.0) for x in done)


def test_flight_is_unbiased():
    size, p = [9.0, 7, 5, 5, 4, 2, 1], [0.3, 0.5, 0.7, 0.2, 0.6, 0.4, 0.3]
    total = np.zeros(7)
    for seed in range(3000):
        total += M.fly(p, size, random.Random(seed))
    assert np.abs(total / 3000 - p).max() < 0.05


def mixed_docs(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join("w" * rnd.randint(1, 5) for _ in range(rnd.randint(1, 80))), f"s{min(i % 7, 3)}") for i in range(1500)]
    rows += [(9000, "same row " * 9, "s0")] * 200 + [(None, "no id", None), (9001, None, "s1"), (9002, "", "s2"), (9003, "x", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_meets_targets_and_agrees(spark):
    docs = mixed_docs(spark)
    units, goal = M.mix(docs)
    taken = {r.source: r.t for r in units.groupBy("source").agg(F.sum(F.col("taken") * F.col("size")).alias("t")).collect()}
    for r in goal.collect():
        assert abs(taken[r.source] - r.target) <= max(3, 0.01 * r.target)
    assert units.where("taken > 3 * n").count() == 0
    again, _ = M.mix(docs.repartition(7))
    key = ["source", "_id", "key", "taken"]
    assert sorted(map(str, units.select(key).collect())) == sorted(map(str, again.select(key).collect()))
    out = M.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == units.agg(F.sum("taken")).first()[0]
    assert M.mixed(docs.limit(0)).count() == 0


def test_mix_keeps_large_ids_beside_null_ones(spark):
    rows = [(2 ** 53 + 2 * i + 1, f"text {i} " * (1 + i % 9), "s") for i in range(60)] + [(None, "no id", "s"), (None, "nor here", "s"), (0, "no id", "s")]
    rows += [(i, "w " * 90, "t") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    units, _ = M.mix(docs)
    assert {(r._id, r.source) for r in units.collect()} == {(i, s) for i, _, s in rows}
    out = M.mixed(docs)
    assert out.count() == units.agg(F.sum("taken")).first()[0] > 9
    assert {(r.doc_id, r.text) for r in out.collect()} <= {(i, t) for i, t, _ in rows}


def test_mix_query_shape(spark):
    rows = M.query(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted((r.doc_id, r.size) for r in rows) == sorted((d.doc_id, len((d.text or "").encode().split())) for d in docs)
    assert all(r.taken <= 3 * r.size for r in rows)


def plain_nearest(rows, k):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = set()
    for q in ok:
        if q % 20:
            continue
        found = {}
        for c, vs in ok.items():
            for v in vs:
                if c != q and len(v) == len(ok[q][0]):
                    s = 0.0
                    for a, b in zip(v, ok[q][0]):
                        s += a * b
                    found[c] = max(found.get(c, -np.inf), s)
        best = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:k]
        out |= {(q, n + 1, c, s) for n, (c, s) in enumerate(best)}
    return out


def test_nearest_is_exact(spark):
    rng = np.random.default_rng(6)
    vecs = rng.normal(size=(300, 16)).astype(np.float32)
    vecs[50:130] = vecs[50]
    rows = [(i, v.tolist()) for i, v in enumerate(vecs)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [float("nan")] + [1.0] * 15), (1003, [None] + [1.0] * 15), (1004, [float("inf")] * 16),
             (None, [1.0] * 16), (1005, [1.0] * 8), (1020, [2.0] * 8), (40, vecs[40].tolist()), (60, vecs[60].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    for query_bytes, base_bytes in ((N.QUERY_BYTES, N.BASE_BYTES), (512, 8192)):
        got = N.nearest(df.where("vec_id % 20 = 0"), df, 20, query_bytes=query_bytes, base_bytes=base_bytes).collect()
        assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == plain_nearest(rows, 20)
    assert N.nearest(df.limit(0), df).count() == 0


def test_nearest_of_extreme_magnitudes(spark):
    rows = [(0, [1e-322, 2e-322]), (20, [1e200, 1e200]), (40, [1e200, -1e200]), (60, [1.5e308, 5e-324])]
    rows += [(1, [1.0, 2.0]), (2, [1e-322, 1e-322]), (3, [1e200, 3.0]), (4, [-1e200, 1e200]), (5, [5e-324, 5e-324]), (6, [1e160, -1e160])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = N.nearest(df.where("vec_id % 20 = 0"), df, 20).collect()
    for q, v in rows[:4]:
        found = []
        for c, w in rows:
            if c != q:
                with np.errstate(over="ignore", invalid="ignore"):
                    found.append((c, float(np.float64(w[0]) * v[0] + np.float64(w[1]) * v[1])))
        want = sorted(found, key=lambda x: (x[1] != x[1], -x[1] if x[1] == x[1] else 0.0, x[0]))
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [(r.vec_id, str(r.score)) for r in mine] == [(c, str(x)) for c, x in want]


def test_quantised_bounds_hold():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(40, 1500)), rng.normal(size=(60, 1500)) * 10
    xc, xs, _, xe = N.encode(x)
    yc, ys, yn, ye = N.encode(y)
    off = np.abs(N.code_products(xc, yc) * xs[:, None] * ys[None, :] - x @ y.T)
    assert (off <= xe[:, None] * yn[None, :] + np.linalg.norm(x, axis=1)[:, None] * ye[None, :] + 1e-9).all()


def test_shards_fit_and_split_only_when_needed(spark):
    rows = [(7 if i % 3 == 0 else i, "x" * 1000) for i in range(1500)] + [(None, None), (1, ""), (5, "y" * 300000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = S.shard(docs, limit=100_000).collect()
    assert sorted(str((r._id, r["size"])) for r in got) == sorted(str((i, len(t or "") + S.ROW_BYTES)) for i, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    for shard, members in by.items():
        total = sum(r["size"] for r in members)
        assert all((r.shard_bytes, r.shard_rows) == (total, len(members)) for r in members)
        assert total <= 100_000 or len(members) == 1
        assert members[0].oversized == (total > 100_000)
    # a shard and its sibling together would not fit
    for shard, members in by.items():
        bits = shard.split(".")[0]
        if shard and "." not in shard:
            both = sum(r["size"] for s, ms in by.items() for r in ms if s.split(".")[0].startswith(bits[:-1]))
            assert both > 100_000
    assert S.shard(docs.limit(0)).count() == 0
    assert {r.shard for r in S.shard(docs, limit=1 << 40).collect()} == {""}


def test_shards_do_not_depend_on_the_order_of_rows(spark):
    rows = [(7, f"text {i % 40} " * 20) for i in range(600)] + [(i, "x" * 300) for i in range(100)] + [(None, "no id " * 30)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (sorted((r._id is None, r._id, r.shard, r["size"]) for r in S.shard(d, limit=10_000).collect())
            for d in (docs.repartition(2), docs.repartition(11).orderBy("text")))
    assert [tuple(map(str, x)) for x in a] == [tuple(map(str, x)) for x in b] and len({x[2] for x in a}) > 10


def test_pipeline_stages_against_brute_force(spark):
    """What the first three stages keep and write, by plain definitions."""
    import corpus_pipeline as C
    from test_dedup import links_of, roots
    from test_filters import plain_spans

    from fmspark.llm import quality_rules as Q
    from fmspark.llm import textvec as T
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = C.saved(C.quality(spark, docs, SF), "good")
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in Q.query(spark, SF).where("kept").collect()}
    texts = {r.doc_id: r.text for r in good.collect()}
    assert all(len(t.encode().split()) >= 50 for t in texts.values())
    one = C.saved(C.deduplicate(spark, good, SF), "one")
    bags = {i: T.bag_of(t) for i, t in texts.items()}
    assert {r.doc_id for r in one.collect()} == set(roots(bags, links_of(bags, T.weighted_jaccard)).values())
    for r in C.redact(spark, one, SF).collect():
        assert not plain_spans(r.text)
        if not plain_spans(texts[r.doc_id]):
            assert r.text == texts[r.doc_id] or "<SECRET>" in r.text or "<IBAN>" in r.text or "<SSN>" in r.text


def test_pipeline_stages_on_odd_rows(spark):
    import corpus_pipeline as C
    long = [" ".join(f"w{i}x{j}" for j in range(80)) for i in range(6)]
    rows = [(None, long[0], None, None, None), (1, long[1], "en", "s", 3), (1, long[2], "en", "s", 3), (2, long[1], None, None, 3), (2, long[1], None, None, 3),
            (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, long[3] + " mail a.b@c.de", "en", None, 9), (None, None, None, None, None)]
    docs = spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _row string, size int")
    for table in (docs, docs.limit(0)):
        before = table
        for name, stage in C.STAGES[:-1]:
            before = C.saved(stage(spark, before, SF), "odd")
            assert before.columns == docs.columns, name
        out = C.STAGES[-1][1](spark, before, SF)
        assert out.count() >= before.count() and (before.count() > 0) == (table.count() > 0)
    kept = C.saved(C.quality(spark, docs, SF), "odd")
    assert {r.text for r in C.deduplicate(spark, kept, SF).collect()} == {r.text for r in kept.collect()}


def test_pipeline_stages(spark):
    import corpus_pipeline as C
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = docs
    for name, stage in C.STAGES[:-1]:
        after = C.saved(stage(spark, before, "/root/testdata/sf0.01"), "test")
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= 3 * before.count()
        before = after
    packed = C.STAGES[-1][1](spark, before, "/root/testdata/sf0.01")
    assert packed.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("s")).where("s > 4096").count() == 0
