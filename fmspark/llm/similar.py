"""Classes of similar texts from banded signatures.

Input is one row per text (equal texts may stand several times): a 16-byte
content key, its band hashes, its weight (size) and a sketch, one byte of each
signature value. Two texts that share a band are candidates. Candidates whose
sketches agree in fewer places than a pair at the threshold does but once in
``1 / MISS`` times are not looked at further; the others are verified on the
units (hashed shingles) of their whole texts, by ``array_intersect``; classes
are the connected components of verified links.

A bucket may hold a third of all texts, so its pairs are never listed, and links
are reduced to forests before they leave a task:

1. Every text is checked against one leader, the smallest key of all its
   buckets. Keys are hashes, so the smallest key is a random text, and the same
   one for a group of similar texts in most of its buckets: about one check a
   text.
2. In buckets of more than ``SMALL`` texts that still hold several classes, up to
   ``LEADERS`` texts outside the largest class, those with the most neighbours
   in such buckets, meet all texts of the bucket. This settles most texts that
   have a link at all, wherever in their group they stand.
3. In buckets that are still open, texts of different classes pair up (up to
   ``SMALL`` texts), or the texts outside the largest class meet all, block by
   block. Few links between classes are left by then.

All overlaps of two blocks are products of 0/1 matrices over the units both
have. Of the links found there, a task gives out one for each text, to the first
text that its links lead to in the block. A block is bounded in texts and in
units, so a task's memory is too, and no link between texts that share a band is
lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small
from .components import components, renamed
from .textvec import Words, each_slice

SMALL = 32
LEADERS = 64
# Texts and units that a block of a larger bucket holds on average.
BLOCK_TEXTS = 256
BLOCK_UNITS = 150_000
# Columns of a 0/1 matrix.
COLUMNS = 1024
# Probability that the sketches rule out a pair at the threshold.
MISS = 1e-5


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` rows that a pair at ``threshold`` shares one of with
    probability ``recall`` or more."""
    n = 1
    while 1 - (1 - threshold ** rows) ** n < recall:
        n += 1
    return n


def least_matches(threshold: float, k: int, miss: float = MISS) -> int:
    """Places of ``k`` in which a pair at ``threshold`` agrees at least, but
    for a probability of ``miss``."""
    below, m = 0.0, 0
    while m < k:
        below += math.comb(k, m) * threshold ** m * (1 - threshold) ** (k - m)
        if below > miss:
            break
        m += 1
    return m


def sketches(sig: np.ndarray) -> pa.Array:
    """The low byte of every signature value, one binary a row."""
    n, k = sig.shape
    flat = (sig & np.uint64(255)).astype(np.uint8)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1, dtype=np.int32) * k).tobytes()), pa.py_buffer(flat.tobytes())])


def agreeing(a: Column, b: Column) -> Column:
    """Places in which two sketches of one length agree."""

    @F.arrow_udf("int")
    def agree(x: pa.Array, y: pa.Array) -> pa.Array:
        def grid(v: pa.Array) -> np.ndarray:
            offs = np.frombuffer(v.buffers()[1], np.int32)[v.offset:v.offset + len(v) + 1]
            return np.frombuffer(v.buffers()[2], np.uint8)[offs[0]:offs[-1]].reshape(len(v), -1)
        if not len(x):
            return pa.array([], pa.int32())
        return pa.array((grid(x) == grid(y)).sum(axis=1, dtype=np.int32))

    return agree(a, b)


def unit_lists(text: str, elements: Callable[[Words], tuple[np.ndarray, np.ndarray]]) -> Column:
    """The hashes that ``elements`` finds in each text of a column, as a list."""

    @F.arrow_udf("array<bigint>")
    def lists(texts: pa.Array) -> pa.Array:
        found, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for _, _, w in each_slice(texts):
            element, of = elements(w)
            found.append(element)
            ends.append(ends[-1][-1] + np.cumsum(np.bincount(of, minlength=w.docs)))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate(found).view(np.int64)))

    return lists(text)


def buckets_of(items: DataFrame) -> DataFrame:
    """(hash, key, weight, lead) of the buckets that hold two different texts or
    more, each text once. Found over bare hashes; only rows of shared buckets
    carry their keys on."""
    # 32 bits tell a bucket's texts apart well enough to see that there are several
    each = items.select(F.explode("bands").alias("hash"), F.hash("key").alias("k"))
    shared = saved(each.groupBy("hash").agg(F.min("k").alias("a"), F.max("k").alias("b")).where("a <> b").select("hash"), "shared")
    rows = items.select("key", "weight", F.explode("bands").alias("hash")).join(small(shared, 24), "hash")
    rows = saved(rows.dropDuplicates(["hash", "key"]), "members")
    leads = saved(rows.groupBy("hash").agg(F.min("key").alias("lead")), "leads")
    return saved(rows.join(leads, "hash"), "buckets")


def similar_classes(items: DataFrame, units: Callable[[DataFrame], DataFrame], threshold: float, matches: int | None) -> DataFrame:
    """``items``: a written table (key, weight, bands, sketch) with band hashes
    that differ between bands. ``units(keys)`` gives (key, units) of a key table,
    once each: the different units of a text, whose Jaccard is the similarity.
    ``matches``: places in which the sketches of a pair agree at least; None where
    there are no sketches and every candidate is verified. Returns (key, root) of the texts that are not the smallest key of their class;
    ``root`` is that key."""
    buckets = buckets_of(items)
    keys = saved(buckets.select("key", "weight").distinct(), "keys")
    library = saved(units(keys.select("key")), "units")
    marks = None
    if matches is not None:
        marks = saved(items.select("key", "sketch").join(small(keys.select("key"), 48), "key", "left_semi").dropDuplicates(["key"]), "marks")
    # 1: each text against the smallest leader of all its buckets
    first = buckets.where("key <> lead").groupBy("key").agg(F.min("lead").alias("lead"), F.first("weight").alias("wb"))
    sizes = keys.select(F.col("key").alias("lead"), F.col("weight").alias("wa"))
    tested = saved(first.join(sizes, "lead").where(_near_size(F.col("wa"), F.col("wb"), threshold))
                   .select(F.col("lead").alias("a"), F.col("key").alias("b")), "pairs")
    classes = components(_verified(tested, library, threshold))
    # 2: the most central texts of large open buckets against all of them
    mixed = _open_rows(buckets, classes)
    links = saved(_block_links(_leaders(mixed.where(F.col("n") > SMALL)), library, threshold).distinct(), "links")
    classes = _merged(classes, links)
    # 3: what is still open
    mixed = _open_rows(buckets, classes)
    pairs = saved(_small_pairs(mixed, marks, threshold, matches).join(tested, ["a", "b"], "left_anti"), "pairs")
    links = _verified(pairs, library, threshold).unionByName(_block_links(_all_blocks(mixed.where(F.col("n") > SMALL)), library, threshold))
    classes = _merged(classes, saved(links.distinct(), "links"))
    return saved(classes.select(F.col("node").alias("key"), "root"), "classes")


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (node, root) joined further by ``links`` (u, v)."""
    found = components(renamed(links, classes, "u", "v"))
    return saved(renamed(classes, found, "root").unionByName(found), "merged")


def _open_rows(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (hash, key, weight, root) of the buckets whose texts are in more than
    one class, with what ``_open`` says about the bucket."""
    rows = saved(renamed(buckets.select("hash", "key", "weight", F.col("key").alias("root")), classes, "root"), "classed")
    return saved(rows.join(saved(_open(rows), "open"), "hash"), "mixed")


def _near_size(a: Column, b: Column, threshold: float) -> Column:
    """Whether the sizes alone do not rule the threshold out."""
    return F.least(a, b) >= F.lit(threshold) * F.greatest(a, b)


def _open(rows: DataFrame) -> DataFrame:
    """Buckets whose texts are in more than one class: their texts, the largest
    class (``top``), the blocks for all and for those outside it, and how many
    of their texts fit one block on average."""
    per = rows.groupBy("hash", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
    all_ = per.groupBy("hash").agg(F.sum("n").alias("n"), F.sum("w").alias("w"), F.count(F.lit(1)).alias("roots"),
                                   F.max(F.struct("n", "root", "w")).alias("top")).where("roots > 1")

    def blocks(n: Column, w: Column) -> Column:
        return F.ceil(F.greatest(n / BLOCK_TEXTS, w / BLOCK_UNITS, F.lit(1))).cast("int")

    return all_.select("hash", "n", F.col("top.root").alias("top"), blocks(F.col("n"), F.col("w")).alias("blocks"),
                       blocks(F.col("n") - F.col("top.n"), F.col("w") - F.col("top.w")).alias("odd_blocks"),
                       F.greatest(F.lit(1), F.least(F.lit(LEADERS), F.floor(F.lit(BLOCK_UNITS) * F.col("n") / F.col("w")))).cast("int").alias("fit"))


def _leaders(mixed: DataFrame) -> DataFrame:
    """Rows for ``_block_links``: each bucket's leaders, one block, and all its
    texts. Texts outside the largest class are dealt to as many hands as a block
    holds; the most central text of each hand leads."""
    central = mixed.groupBy("key").agg(F.sum("n").alias("near"))
    odd = mixed.where(F.col("root") != F.col("top")).join(central, "key")
    lead = (odd.groupBy("hash", F.pmod(F.xxhash64("key", F.lit(1)), F.col("fit")).alias("hand"))
            .agg(F.max(F.struct("near", "key", "root", "blocks")).alias("m")))
    lead = lead.select("hash", F.lit(0).alias("i"), F.explode(F.sequence(F.lit(0), F.col("m.blocks") - 1)).alias("j"), F.lit(True).alias("odd"), "m.key", "m.root")
    every = mixed.select("hash", F.lit(0).alias("i"), F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int").alias("j"), F.lit(False).alias("odd"), "key", "root")
    return lead.unionByName(every)


def _all_blocks(mixed: DataFrame) -> DataFrame:
    """Rows for ``_block_links``: every block of texts outside a bucket's largest
    class with every block of its texts."""
    spread = F.xxhash64("key")
    odd = mixed.where(F.col("root") != F.col("top")).select(
        "hash", F.pmod(spread, F.col("odd_blocks")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"),
        F.lit(True).alias("odd"), "key", "root")
    every = mixed.select(
        "hash", F.explode(F.sequence(F.lit(0), F.col("odd_blocks") - 1)).alias("i"), F.pmod(spread, F.col("blocks")).cast("int").alias("j"),
        F.lit(False).alias("odd"), "key", "root")
    return odd.unionByName(every)


def _small_pairs(mixed: DataFrame, marks: DataFrame | None, threshold: float, matches: int | None) -> DataFrame:
    """(a, b): texts of different classes in the same small open bucket."""
    rows = mixed.where(F.col("n") <= SMALL).select("hash", "key", "root", "weight")
    if marks is not None:
        rows = rows.join(marks, "key")
    b = rows.select("hash", *[F.col(c).alias(f"{c}_b") for c in rows.columns if c != "hash"])
    pairs = (rows.join(b, "hash").where((F.col("key") < F.col("key_b")) & (F.col("root") != F.col("root_b")))
             .where(_near_size(F.col("weight"), F.col("weight_b"), threshold)))
    if marks is not None:
        pairs = pairs.where(agreeing(F.col("sketch"), F.col("sketch_b")) >= matches)
    return pairs.select(F.col("key").alias("a"), F.col("key_b").alias("b")).distinct()


def overlaps(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """Common units of every list of ``a`` with every list of ``b``; a list has
    no unit twice."""
    va, vb = a.flatten().to_numpy(zero_copy_only=False), b.flatten().to_numpy(zero_copy_only=False)
    ra, rb = (np.repeat(np.arange(len(x)), pc.list_value_length(x).to_numpy(zero_copy_only=False)) for x in (a, b))
    both = np.intersect1d(va, vb)
    out = np.zeros((len(a), len(b)), np.float32)
    if not len(both):
        return out

    def columns(v: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(both, v), len(both) - 1)
        hit = both[at] == v
        at, r = at[hit], r[hit]
        order = np.argsort(at, kind="stable")
        return at[order], r[order]

    (ca, ra), (cb, rb) = columns(va, ra), columns(vb, rb)
    for lo in range(0, len(both), COLUMNS):
        m = []
        for c, r, n in ((ca, ra, len(a)), (cb, rb, len(b))):
            i, j = np.searchsorted(c, [lo, lo + COLUMNS])
            x = np.zeros((n, min(COLUMNS, len(both) - lo)), np.float32)
            x[r[i:j], c[i:j] - lo] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out


def forest(linked: np.ndarray) -> np.ndarray:
    """The first member of each row's and each column's component in a
    two-sided graph; columns are numbered after rows."""
    n, m = linked.shape
    row, col = np.arange(n), np.arange(n, n + m)
    while n and m:
        before = row.sum() + col.sum()
        col = np.minimum(col, np.where(linked, row[:, None], n + m).min(axis=0))
        row = np.minimum(row, np.where(linked, col[None, :], n + m).min(axis=1))
        if row.sum() + col.sum() == before:
            break
    return np.concatenate([row, col])


def _block_links(rows: DataFrame, library: DataFrame, threshold: float) -> DataFrame:
    """(u, v): linked texts of different classes; in each group (hash, i, j) of
    ``rows`` the ``odd`` texts meet the others. One link a text and group."""
    rows = rows.join(library, "key")

    def links(block: pa.Table) -> pa.Table:
        block = block.combine_chunks()
        code = pa.chunked_array([block["root"].combine_chunks().dictionary_encode().indices]).to_numpy()
        is_odd = block["odd"].to_numpy()
        block = block.take(np.argsort(~is_odd, kind="stable")).combine_chunks()
        lists, n = block["units"].combine_chunks(), int(is_odd.sum())
        size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        common = overlaps(lists[:n], lists[n:])
        linked = common >= threshold * (size[:n, None] + size[None, n:] - common)
        linked &= code[is_odd][:, None] != code[~is_odd][None, :]
        top = forest(linked)
        u = np.flatnonzero(top != np.arange(len(top)))
        key = block["key"]
        return pa.table({"u": key.take(pa.array(u)), "v": key.take(pa.array(top[u]))})

    return rows.groupBy("hash", "i", "j").applyInArrow(links, "u binary, v binary")


def _verified(pairs: DataFrame, library: DataFrame, threshold: float) -> DataFrame:
    a = library.select(F.col("key").alias("a"), F.col("units").alias("ta"))
    b = library.select(F.col("key").alias("b"), F.col("units").alias("tb"))
    both = pairs.join(b, "b").join(a, "a").withColumn("common", F.size(F.array_intersect("ta", "tb")))
    near = F.col("common") >= F.lit(threshold) * (F.size("ta") + F.size("tb") - F.col("common"))
    return both.where(near).select(F.col("a").alias("u"), F.col("b").alias("v"))
