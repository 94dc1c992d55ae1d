"""Quality rules: a learned decision list over per-document statistics.

Statistics of whole texts are counted inside the tasks (numpy over the Arrow
buffers); sequential covering learns an ordered list of threshold conjunctions
from labelled rows; the list is applied as one Spark CASE expression.

Learning (``learn``): conditions ``statistic <= t`` or ``statistic > t`` with
``t`` half-way between quantiles of the labelled rows. A rule is *grown* on two thirds of
the rows by the condition of largest FOIL gain until it covers no good row or
nothing improves, then *pruned* from its end on the last third, keeping the
prefix of best ``(bad - good) / (bad + good)``. It joins the list if it is
precise enough on the pruning rows; the rows it covers are removed and the next
rule is grown on the rest. Rows no rule covers are kept.

The labelled rows used are at most ``max_labelled`` (by smallest hash of the
id); every document's statistics and verdict come from its whole text.

Cases: a null or empty text has all statistics 0 and fails the base rule
(fewer than ``min_words`` words). Labels that are null or whose document is
missing are not used; a document labelled both ways counts as bad. Without
usable labels of both kinds the list is empty and only the base rule decides.
Repeated rows are judged one by one, alike. Null ids are judged like others.
Further columns, of any name, are carried along untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_name, ship
from .textvec import IS_SPACE, each_slice, in_text, utf8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_upper", "n_digits", "n_marks", "n_distinct_words")
STATS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
_STATS_ARROW = pa.struct([(c, pa.int64()) for c in COUNTS])

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LABELLED = 20_000


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL = _set(b"#*$%&|<>")
_MARK = _set(b"!?;:=_~^\\/{}[]@+")
_UPPER = _set(bytes(range(65, 91)))
_DIGIT = _set(bytes(range(48, 58)))
# bytes that begin a character of a word: neither white space nor 10xxxxxx
_WORD_CHAR = ~IS_SPACE & ((np.arange(256) & 0xC0) != 0x80)


def _repeat_words(w, n: int = 3) -> np.ndarray:
    """Words a text has inside ``n``-word windows that stand in it twice."""
    at, h = w.windows(n)
    covered = np.zeros(len(w.starts), bool)
    if len(at):
        keys = in_text(h, w.text_of_word()[at])
        s = np.sort(keys)
        twice = np.unique(s[1:][s[1:] == s[:-1]])
        if len(twice):
            hit = at[twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys]
            for k in range(n):
                covered[hit + k] = True
    c = np.concatenate([[0], np.cumsum(covered)])
    return c[w.first[1:]] - c[w.first[:-1]]


def _distinct_words(w) -> np.ndarray:
    keys = np.unique(in_text(w.hashes, w.text_of_word()), return_index=True)[1] if len(w.starts) else np.zeros(0, int)
    return np.bincount(w.text_of_word()[keys], minlength=w.docs) if len(keys) else np.zeros(w.docs, np.int64)


def _line_counts(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def text_stats(texts: pa.Array) -> pa.Array:
    buf, offs = utf8(texts)
    raw = buf.tobytes()
    lines = [_line_counts(raw[offs[i]:offs[i + 1]]) for i in range(len(offs) - 1)]
    cols: dict[str, list[np.ndarray]] = {c: [] for c in COUNTS if c not in ("n_lines", "n_dup_lines")}
    for _, _, w in each_slice(texts):
        cols["n_words"].append(w.count)
        cols["n_repeat_words"].append(_repeat_words(w))
        cols["n_distinct_words"].append(_distinct_words(w))
        for name, table in (("word_chars", _WORD_CHAR), ("n_symbols", _SYMBOL), ("n_upper", _UPPER),
                            ("n_digits", _DIGIT), ("n_marks", _MARK)):
            cols[name].append(w.per_text(table[w.buf]))
    out = {c: np.concatenate(v).astype(np.int64) if v else np.zeros(0, np.int64) for c, v in cols.items()}
    out["n_lines"] = np.array([x[0] for x in lines], np.int64)
    out["n_dup_lines"] = np.array([x[1] for x in lines], np.int64)
    return pa.StructArray.from_arrays([pa.array(out[c], pa.int64()) for c in COUNTS], fields=list(_STATS_ARROW))


def with_stats(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the struct column ``out`` of the counts of each text."""
    ship(df.sparkSession)

    @F.arrow_udf(STATS_TYPE)
    def stats(texts: pa.Array) -> pa.Array:
        return text_stats(texts)

    return df.withColumn(out, stats(F.col(text_col)))


# Statistics that rules test: name -> (numerator, denominator), a count per
# denominator count; without a denominator the count itself.
RATIOS = {
    "symbols_per_char": ("n_symbols", "word_chars"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "marks_per_char": ("n_marks", "word_chars"),
    "chars_per_word": ("word_chars", "n_words"),
    "repeat_words_share": ("n_repeat_words", "n_words"),
    "distinct_words_share": ("n_distinct_words", "n_words"),
    "dup_lines_share": ("n_dup_lines", "n_lines"),
    "words_per_line": ("n_words", "n_lines"),
    "words": ("n_words", None),
}


@dataclass(frozen=True)
class Condition:
    stat: str
    above: bool
    cut: float

    def __str__(self) -> str:
        return f"{self.stat} {'>' if self.above else '<='} {self.cut:.6g}"

    def column(self, stats: Column) -> Column:
        num, den = RATIOS[self.stat]
        value = stats[num].cast("double")
        if den:
            value = F.when(stats[den] > 0, value / stats[den]).otherwise(F.lit(0.0))
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)


@dataclass(frozen=True)
class Rule:
    """Reject documents for which all conditions hold."""
    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self, stats: Column) -> Column:
        out = self.conditions[0].column(stats)
        for c in self.conditions[1:]:
            out = out & c.column(stats)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _values(counts: np.ndarray) -> np.ndarray:
    """Rule statistics of rows of counts, one column a statistic."""
    at = {c: k for k, c in enumerate(COUNTS)}
    cols = []
    for num, den in RATIOS.values():
        v = counts[:, at[num]].astype(float)
        if den:
            d = counts[:, at[den]].astype(float)
            v = np.where(d > 0, v / np.where(d > 0, d, 1), 0.0)
        cols.append(v)
    return np.stack(cols, axis=1)


def _cuts(v: np.ndarray, n: int) -> np.ndarray:
    """Thresholds half-way between neighbouring quantiles, so that a cut keeps
    its distance from the rows on either side."""
    if not len(v):
        return np.zeros(0)
    q = np.unique(np.quantile(v, np.linspace(0, 1, n + 1)))
    return (q[1:] + q[:-1]) / 2


def learn(counts: np.ndarray, bad: np.ndarray, *, max_rules: int = 12, max_conditions: int = 4,
          cuts: int = 64, min_precision: float = 0.8, min_cover: int = 4) -> list[Rule]:
    """Ordered reject rules from rows of counts (columns ``COUNTS``) and
    whether each row is bad. Deterministic for given rows in any order."""
    names = list(RATIOS)
    x, bad = _values(np.asarray(counts, np.int64).reshape(-1, len(COUNTS))), np.asarray(bad, bool)
    order = np.lexsort([*x.T, bad])
    x, bad = x[order], bad[order]
    prune_set = np.arange(len(x)) % 3 == 2
    quantiles = [_cuts(x[:, f], cuts) for f in range(len(names))]
    left = np.ones(len(x), bool)
    rules: list[Rule] = []

    def holds(c: tuple[int, bool, float], rows: np.ndarray) -> np.ndarray:
        return x[rows, c[0]] > c[2] if c[1] else x[rows, c[0]] <= c[2]

    while len(rules) < max_rules:
        rows = np.flatnonzero(left & ~prune_set)
        conds: list[tuple[int, bool, float]] = []
        while len(conds) < max_conditions:
            p0, n0 = bad[rows].sum(), (~bad[rows]).sum()
            if not p0 or not n0:
                break
            base, best, best_gain = np.log2(p0 / (p0 + n0)), None, 1e-9
            for f in range(len(names)):
                v, q = x[rows, f], quantiles[f]
                if not len(q):
                    continue
                side = np.searchsorted(q, v, side="left")  # v <= q[k] iff side <= k
                pc = np.cumsum(np.bincount(side[bad[rows]], minlength=len(q) + 1))[:len(q)]
                nc = np.cumsum(np.bincount(side[~bad[rows]], minlength=len(q) + 1))[:len(q)]
                for above, p, n in ((False, pc, nc), (True, p0 - pc, n0 - nc)):
                    gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - base), 0.0)
                    k = int(np.argmax(gain))
                    if gain[k] > best_gain:
                        best, best_gain = (f, above, float(q[k])), gain[k]
            if best is None:
                break
            conds.append(best)
            rows = rows[holds(best, rows)]
        if not conds:
            break
        rows, worth = np.flatnonzero(left & prune_set), []
        for k in range(len(conds)):
            rows = rows[holds(conds[k], rows)]
            p, n = int(bad[rows].sum()), int((~bad[rows]).sum())
            worth.append(((p - n) / (p + n) if p + n else -1.0, p, n))
        keep = max(range(len(conds)), key=lambda k: (worth[k][0], -k))
        _, p, n = worth[keep]
        if p < min_cover or p / max(1, p + n) < min_precision:
            break
        rule = Rule(tuple(Condition(names[f], a, c) for f, a, c in conds[:keep + 1]), p, n)
        covered = np.ones(len(x), bool)
        every = np.arange(len(x))
        for c in conds[:keep + 1]:
            covered &= holds(c, every)
        left &= ~covered
        rules.append(rule)
    return rules


def verdict(rules: list[Rule], stats: Column) -> Column:
    """True where no rule rejects; the rules in their order."""
    case = None
    for r in rules:
        case = F.when(r.column(stats), False) if case is None else case.when(r.column(stats), False)
    return F.lit(True) if case is None else case.otherwise(True)


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = MAX_LABELLED, seed: int = 7, **how) -> list[Rule]:
    """Learn the list from at most ``max_labelled`` labelled documents. The
    sample (two small numbers a row) is broadcast to the scan of the
    documents, and only its documents' counts reach the driver."""
    picked = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_good"))
              .orderBy(F.xxhash64(F.col("_id"), F.lit(seed)), "_id").limit(max_labelled))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_id")
    one = F.min_by("_stats", F.coalesce(F.md5("_text"), F.lit("")))  # of several texts of an id, one as it is
    rows = (with_stats(texts, "_text", "_stats").groupBy("_id", "_good").agg(one.alias("_stats"))
            .select("_id", "_good", *[F.col("_stats")[c].alias(c) for c in COUNTS]).toPandas())
    return learn(rows[list(COUNTS)].to_numpy(np.int64).reshape(-1, len(COUNTS)), (rows["_good"] == 0).to_numpy(), **how)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> tuple[DataFrame, str, Column]:
    """The documents with a struct of counts (its name second) and the
    expression that tells whether a row is kept."""
    name = free_name(docs, "_stats")
    out = with_stats(docs, text_col, name)
    s = F.col(name)
    return out, name, ~base_failed(s) & verdict(rules, s)


def keep_good(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The documents that the base rule and the learned list keep."""
    text_col = how.get("text_col", "text")
    out, name, kept = judge(docs, fit(docs, labels, **how), text_col)
    return out.where(kept).drop(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out, name, kept = judge(docs.select("doc_id", "text"), rules)
    s = F.col(name)
    return out.select("doc_id", *[s[c].alias(c) for c in COUNTS[:5]], base_failed(s).alias("base_failed"),
                      kept.alias("kept"), *[s[c].alias(c) for c in COUNTS[5:]])
