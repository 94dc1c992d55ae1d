"""Vectorised work on whole texts inside a task.

An Arrow string array is one byte buffer with offsets, so words, hashes and
counts of thousands of texts come from a few numpy passes over the bytes,
without a Python object per word. Texts are handled in slices of a
quarter megabyte (a longer text is a slice of its own), so memory does not follow the
size of a batch.

A word is a run of bytes other than space and 0x09-0x0D. A shingle is ``n``
words in a row; a text with fewer words (but at least one) has one shingle, all
of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 1 << 18
GOLDEN = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = np.asarray(x, dtype=U64).copy()
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit numbers fixed by ``seed``."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1 << 20)) * GOLDEN)


IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
# keeps the first k bytes of a little-endian 8-byte load
FIRST_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=U64)


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    offs = np.frombuffer(off, dtype=np.int64 if wide else np.int32)
    offs = offs[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive texts whose bytes stay under ``limit``, at least one each."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Words:
    """The words of one slice of texts: ``first[d]:first[d + 1]`` are those of
    text ``d``; ``hashes`` has one 64-bit hash each."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray):
        self.buf, self.offs, self.docs = buf, offs, len(offs) - 1
        inw = ~IS_SPACE[buf] if len(buf) else np.zeros(0, bool)
        begins, ends = inw.copy(), inw.copy()
        if len(buf):
            begins[1:] &= ~inw[:-1]
            ends[:-1] &= ~inw[1:]
            heads = offs[:-1][offs[:-1] < offs[1:]]
            tails = offs[1:][offs[:-1] < offs[1:]] - 1
            begins[heads] = inw[heads]
            ends[tails] = inw[tails]
        self.inw = inw
        self.starts = np.flatnonzero(begins)
        self.lens = np.flatnonzero(ends) + 1 - self.starts
        self.first = np.searchsorted(self.starts, offs)
        self.count = np.diff(self.first)

    @property
    def hashes(self) -> np.ndarray:
        """One 64-bit hash a word, from its bytes eight at a time."""
        if not len(self.starts):
            return np.zeros(0, U64)
        padded = np.concatenate([self.buf, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.buf) + 1,), "<u8", padded, strides=(1,))
        with np.errstate(over="ignore"):
            h = mix((eight[self.starts] & FIRST_BYTES[np.minimum(self.lens, 8)]) + self.lens.astype(U64) * GOLDEN)
            more, k = np.flatnonzero(self.lens > 8), 8
            while len(more):
                part = eight[self.starts[more] + k] & FIRST_BYTES[np.minimum(self.lens[more] - k, 8)]
                h[more] = mix((h[more] ^ part) * GOLDEN)
                k += 8
                more = more[self.lens[more] > k]
        return h

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.docs), self.count)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of byte flags over each text."""
        c = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return c[self.offs[1:]] - c[self.offs[:-1]]

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words of the ``n``-word windows inside one text, and the
        windows' hashes."""
        h = self.hashes
        if len(h) < n:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        left = np.repeat(self.first[1:], self.count) - np.arange(len(h))
        at = np.flatnonzero(left >= n)
        return at, self._join(h, at, n)

    @staticmethod
    def _join(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(at), U64)
        with np.errstate(over="ignore"):
            for k in range(n):
                out = out * GOLDEN + h[at + k]
        return mix(out)

    def shingles(self, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes in text order, repeats kept, and each one's text."""
        h = self.hashes
        left = np.repeat(self.first[1:], self.count) - np.arange(len(h))
        at = np.flatnonzero(left >= n)
        text = self.text_of_word()[at]
        whole = self._join(h, at, n)
        short = np.flatnonzero((self.count > 0) & (self.count < n))
        if len(short):
            extra = np.zeros(len(short), U64)
            with np.errstate(over="ignore"):
                for k in range(n - 1):
                    has = self.count[short] > k
                    idx = np.minimum(self.first[short] + k, len(h) - 1)
                    extra = np.where(has, extra * GOLDEN + h[idx], extra)
            extra = mix(extra + self.count[short].astype(U64))
            text = np.concatenate([text, short])
            whole = np.concatenate([whole, extra])
            order = np.argsort(text, kind="stable")
            text, whole = text[order], whole[order]
        return whole, text


def each_slice(arr: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """The texts of an array, a slice of words at a time."""
    buf, offs = utf8(arr)
    for i, j in slices(offs):
        yield i, j, Words(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def occurrence(keys: np.ndarray) -> np.ndarray:
    """For each key its running number among equal keys (0 for the first)."""
    out = np.zeros(len(keys), np.int64)
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return out
    at = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys)
    sub = keys[at]
    order = np.argsort(sub, kind="stable")
    ks = sub[order]
    head = np.flatnonzero(np.concatenate([[True], ks[1:] != ks[:-1]]))
    run = np.arange(len(ks)) - np.repeat(head, np.diff(np.append(head, len(ks))))
    out[at[order]] = run
    return out


def in_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes made distinct by the text they stand in."""
    with np.errstate(over="ignore"):
        return mix(hashes + (text.astype(U64) + U64(1)) * GOLDEN)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of minimum over sum of maximum counts of two bags of hashes."""
    if not len(a) or not len(b):
        return 0.0
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    common = int(np.minimum(ca[ia], cb[ib]).sum())
    return common / (len(a) + len(b) - common)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets given as hashes, repeats ignored."""
    return weighted_jaccard(np.unique(a), np.unique(b))


def bag_of(text: str | None, n: int = 5) -> np.ndarray:
    """Shingle hashes of one text, repeats kept."""
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return Words(raw, np.array([0, len(raw)], np.int64)).shingles(n)[0]
