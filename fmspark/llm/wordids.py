"""Token ids of whole texts, many words at a time.

The vocabulary's tokens never cross white space, so a text's ids are those of
its words in a row, and the ids of a word of letters with marks after it are
those of the letters and of the marks. ``Encoder`` finds the words of a slice
of texts with numpy, looks all of them up in a table of known words at once and
gives only different unknown ones to the tokenizer. The table has a fixed
number of places; a word is keyed by 128 hash bits, and one that finds its
places taken replaces what is there. Memory is bounded by the table and by
``POOL`` ids, after which the table starts over.
"""

from __future__ import annotations

import os
import re
import string

import numpy as np

from .textvec import FIRST_BYTES, GOLDEN, U64, Words, mix

TABLE_BITS = 20
PROBES = 4
POOL = 8_000_000
# letters whose lower case Python and the vocabulary agree on, then marks; or anything else
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
WORD = re.compile(rf"^(?:([{LETTERS}]+)([{re.escape(string.punctuation)}]*)|(.*))$", re.M)
SECOND = U64(0xD6E8FEB86659FD93)
# words in one text given to the tokenizer, and in one call
ROW, CALL = 200, 20_000


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def word_keys(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word."""
    first = w.hashes
    if not len(first):
        return first, first.copy()
    padded = np.concatenate([w.buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(w.buf) + 1,), "<u8", padded, strides=(1,))
    with np.errstate(over="ignore"):
        second = mix((eight[w.starts] & FIRST_BYTES[np.minimum(w.lens, 8)]) * SECOND + w.lens.astype(U64))
        more, k = np.flatnonzero(w.lens > 8), 8
        while len(more):
            part = eight[w.starts[more] + k] & FIRST_BYTES[np.minimum(w.lens[more] - k, 8)]
            second[more] = mix(second[more] * SECOND + part)
            k += 8
            more = more[w.lens[more] > k]
    return first, second


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers ``start, ..., start + length - 1`` of each pair, in a row."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(start - (ends - length), length) + np.arange(total)


class Encoder:
    """Token ids of texts, as ``tokenizers`` gives them without special tokens."""

    def __init__(self, path: str, table_bits: int = TABLE_BITS, pool: int = POOL):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        words = self.tok.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.size, self.limit = 1 << table_bits, pool
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(self.size, U64)
        self.check = np.zeros(self.size, U64)
        self.at = np.zeros(self.size, np.int64)
        self.n = np.full(self.size, -1, np.int32)  # -1: free
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _store(self, ids: np.ndarray) -> int:
        """Append to the pool; the place of the first id."""
        first, need = self.used, self.used + len(ids)
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        self.pool[first:need] = ids
        self.used = need
        return first

    def _find(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the pool and number of ids of each word; -1: not known."""
        at, n = np.zeros(len(key), np.int64), np.full(len(key), -1, np.int32)
        todo = np.arange(len(key))
        for j in range(PROBES):
            slot = ((key[todo] + U64(j)) & U64(self.size - 1)).astype(np.int64)
            hit = (self.key[slot] == key[todo]) & (self.check[slot] == check[todo]) & (self.n[slot] >= 0)
            at[todo[hit]], n[todo[hit]] = self.at[slot[hit]], self.n[slot[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return at, n

    def _remember(self, key: np.ndarray, check: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        """Put words into the table: into their first free place, else over
        what stands in one of their places."""
        todo = np.arange(len(key))
        for j in range(PROBES):
            slot = ((key[todo] + U64(j)) & U64(self.size - 1)).astype(np.int64)
            free = (self.n[slot] < 0) | ((self.key[slot] == key[todo]) & (self.check[slot] == check[todo]))
            if j == PROBES - 1:
                slot = ((key[todo] + (check[todo] >> U64(60)) % U64(PROBES)) & U64(self.size - 1)).astype(np.int64)
                free[:] = True
            _, one = np.unique(slot, return_index=True)  # two words do not take one place
            mine = one[free[one]]
            s, t = slot[mine], todo[mine]
            self.key[s], self.check[s], self.at[s], self.n[s] = key[t], check[t], at[t], n[t]
            left = np.ones(len(todo), bool)
            left[mine] = False
            todo = todo[left]

    def _tokenize(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in a row and how many each has. Words of letters are one
        run of tokens, of which only the last ends a word, so many go into one
        text and come apart again."""
        order, ids, n = [], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        rest = [i for i, s in enumerate(words) if not s.isalpha()]
        plain = [i for i, s in enumerate(words) if s.isalpha()]
        for k in range(0, len(plain), CALL):
            rows = [plain[i:i + ROW] for i in range(k, min(k + CALL, len(plain)), ROW)]
            texts = [" ".join([words[i] for i in row]) for row in rows]
            for row, e in zip(rows, self.tok.encode_batch_fast(texts, add_special_tokens=False)):
                got = np.asarray(e.ids, np.uint32)
                ends = np.flatnonzero(self.ends[got]) + 1
                if len(ends) == len(row):
                    order += row
                    ids.append(got)
                    n.append(np.diff(ends, prepend=0))
                else:
                    rest += row
        for k in range(0, len(rest), CALL):
            part = rest[k:k + CALL]
            got = [e.ids for e in self.tok.encode_batch_fast([words[i] for i in part], add_special_tokens=False)]
            order += part
            ids.append(np.array([t for row in got for t in row], np.uint32))
            n.append(np.array([len(row) for row in got], np.int64))
        n, back = np.concatenate(n), np.argsort(order)
        at = (np.cumsum(n) - n)[back]
        return np.concatenate(ids)[ranges(at, n[back])], n[back].astype(np.int32)

    def _learn(self, text: str, whole: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places and numbers of ids of the different words of ``text``, one a
        line. ``whole``: they go to the tokenizer as they are; else in parts
        (case does not matter to the vocabulary), of which the known ones are
        looked up."""
        if whole:
            ids, n = self._tokenize(text.split("\n"))
            return self._store(ids) + np.cumsum(n) - n, n
        parts, many = [], []
        for letters, marks, other in WORD.findall(text):
            parts.append(letters.lower() if letters else other)
            if marks:
                parts.append(marks)
            many.append(2 if marks else 1)
        raw = "\n".join(parts).encode()
        part_at, part_n = self._known(Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64)), whole=True)
        many = np.asarray(many)
        last = np.cumsum(many) - 1
        at, n = part_at[last], part_n[last]
        two = np.flatnonzero(many == 2)
        if len(two):
            both = np.stack([last[two] - 1, last[two]], axis=1).ravel()
            ids = self.pool[ranges(part_at[both], part_n[both])]
            n[two] += part_n[last[two] - 1]
            at[two] = self._store(ids) + np.cumsum(n[two]) - n[two]
        return at, n

    def _known(self, w: Words, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Place in the pool and number of ids of each word."""
        key, check = word_keys(w)
        at, n = self._find(key, check)
        new = np.flatnonzero(n < 0)
        if len(new):
            _, one, back = np.unique(key[new], return_index=True, return_inverse=True)
            one = new[one]
            raw = np.full(int((w.lens[one] + 1).sum()), 10, np.uint8)
            ends = np.cumsum(w.lens[one] + 1)
            raw[ranges(ends - w.lens[one] - 1, w.lens[one])] = w.buf[ranges(w.starts[one], w.lens[one])]
            new_at, new_n = self._learn(raw[:-1].tobytes().decode(errors="replace"), whole)
            self._remember(key[one], check[one], new_at, new_n)
            at[new], n[new] = new_at[back], new_n[back]
            odd = new[check[one][back] != check[new]]  # another word with the same first hash
            for i in odd.tolist():
                word = w.buf[w.starts[i]:w.starts[i] + w.lens[i]].tobytes().decode(errors="replace")
                ids, _ = self._tokenize([word])
                at[i], n[i] = self._store(ids), len(ids)
        return at, n

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (UTF-8 bytes with offsets) in a row, and the offset
        of each text's first id."""
        if self.used > self.limit:
            self._clear()
        w = Words(buf, offs)
        at, n = self._known(w)
        total = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        return self.pool[ranges(at, n)], total[w.first]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder of a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
