"""Personal data in whole texts, found with DataFrame functions alone.

Three steps a kind: a regular expression proposes spans, a validator confirms
them (digit counts, octets, the Luhn sum of card numbers, the mod-97 remainder
of bank accounts), and context words next to a span adjust its score. Spans of
the kinds ``email, ip, card, phone`` are kept whenever they are valid; ``iban``,
``ssn`` and ``secret`` (keys and tokens) only with a score of ``min_score`` or more, which a valid check sum
or a context word gives.

Positions come without a loop over characters: splitting a text by the same
expression gives the parts between the matches, and the lengths of parts and
matches add up to the starts. All offsets are code points, end exclusive.

The expressions are written so that Java scans them in one pass over texts
of any length: possessive repeats, and a look-behind instead of a new try at
every character of a run. Nothing is shuffled; a row depends on itself alone.

Cases: a null text has no spans (and stays null when masked). Empty and very
long texts are scanned whole. Null and repeated ids are treated row by row.
Further columns, of any name, are carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, free_name

CONTEXT_CHARS = 40
CONTEXT_SCORE = 0.3
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: float      # of a valid span without context
    context: str      # words near a span that raise its score
    needs: str = ""   # a character that every match holds
    base: bool = True  # kept whatever the score


KINDS = (
    # a local part starts where its run of characters does, or where the last match ended
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         0.9, "mail|contact|write to|reach", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, "ip|address|server|host|login", "."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){12,}+", 0.7, "card|visa|master|credit|debit|payment"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, "phone|tel|call|mobile|fax", "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])",
         0.8, "iban|account|bank|konto", base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, "ssn|social security", "-", base=False),
    # a named value, or one with the prefix of a known issuer
    Kind("secret", r"(?:(?i:\b(?:token|secret|password|passwd|(?:api|access|private)[_-]?key))\x20?[=:]\x20?[\x22\x27]?[A-Za-z0-9_+/=.-]{16,}+"
         r"|\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,}+|-----BEGIN\x20[A-Z\x20]{0,20}PRIVATE\x20KEY-----)",
         0.7, "login|credential|auth|deploy", base=False),
)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of up to 19 digits has a Luhn sum divisible by 10."""
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for k in range(20):  # from the left; the last digit counts once, the one before twice
        d = F.substring(padded, k + 1, 1).cast("int")
        total = total + (d if k % 2 else d * 2 - F.when(d > 4, 9).otherwise(0))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Remainder of a bank account number, letters as 10 to 35, with its first
    four characters moved to the end."""
    s = F.regexp_replace(account, "\\x20", "")
    turned = F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4))
    value = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(
        c == "", acc).otherwise((acc * F.when(c >= "A", 100).otherwise(10) + value(c)) % 97))


def _valid(kind: str, s: Column) -> Column:
    n = F.length(_digits(s))
    return {
        "email": F.lit(True),
        "ip": s.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": n.between(13, 19) & luhn(F.when(n <= 19, _digits(s)).otherwise("1")),
        "phone": n.between(9, 15),
        "iban": mod97(s) == 1,
        "ssn": ~s.rlike("^(?:000|666|9)|-00-|-0000$"),
        "secret": s.rlike("^-----BEGIN|[0-9].*[0-9]"),
    }[kind]


_BLOCK = 256


def _sum_before(lengths: Column, sums: Column, i: Column) -> Column:
    """Sum of the first ``i`` lengths, with the sums of whole blocks at hand."""
    add = lambda a, x: a + x
    block = F.floor(i / _BLOCK).cast("int")
    return (F.aggregate(F.slice(sums, F.lit(1), block), F.lit(0), add)
            + F.aggregate(F.slice(lengths, block * _BLOCK + 1, i - block * _BLOCK), F.lit(0), add))


def find_spans(df: DataFrame, text_col: str = "text", out: str = "spans", *, min_score: float = 0.5,
               kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``df`` with an array of ``kind, start, end, score, base``: by kind in the
    given order, then by start."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = {k.name: free_name(df, f"_{k.name}") for k in kinds}
    none = F.lit(None).cast("struct<m:array<string>,p:array<string>>")
    found = {}
    for k in kinds:
        hits = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
        if k.needs:
            hits = F.when(F.contains(text, F.lit(k.needs)), hits)
        found[name[k.name]] = hits
    step = df.withColumns(found)
    split = {}
    for k in kinds:
        hits = F.col(name[k.name])
        split[name[k.name]] = F.when(F.size(hits) > 0, F.struct(
            hits.alias("m"), F.split(text, k.pattern, -1).alias("p"))).otherwise(none)
    step = step.withColumns(split)
    for stage in (_with_lengths, _with_sums):
        step = step.withColumns({n: F.when(F.col(n).isNotNull(), stage(F.col(n))) for n in name.values()})
    return (step.withColumns({name[k.name]: _spans(k, F.col(name[k.name]), min_score) for k in kinds})
            .withColumn(out, F.concat(*[F.col(n) for n in name.values()])).drop(*name.values()))


def _with_lengths(c: Column) -> Column:
    """Adds ``n``: the length of each part together with the match after it."""
    lengths = F.transform(c["m"], lambda m, i: F.length(m) + F.length(F.get(c["p"], i)))
    return F.struct(c["m"].alias("m"), c["p"].alias("p"), lengths.alias("n"))


def _with_sums(c: Column) -> Column:
    """Adds ``s``: the sums of ``n`` over blocks."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(c["n"]) - 1) / _BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: F.aggregate(F.slice(c["n"], b * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda a, x: a + x))
    return F.struct(c["m"].alias("m"), c["p"].alias("p"), c["n"].alias("n"), sums.alias("s"))


def _spans(k: Kind, c: Column, min_score: float) -> Column:
    """The confirmed spans of a kind, an empty array where there are none."""

    def span(m: Column, i: Column) -> Column:
        start = _sum_before(c["n"], c["s"], i) + F.length(F.get(c["p"], i))
        near = F.lower(F.concat(F.right(F.get(c["p"], i), F.lit(CONTEXT_CHARS)), F.lit(" "),
                                F.left(F.get(c["p"], i + 1), F.lit(CONTEXT_CHARS // 2))))
        score = F.lit(k.score) + F.when(near.rlike(rf"\b(?:{k.context})"), CONTEXT_SCORE).otherwise(0.0)
        return F.struct(F.lit(k.name).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"),
                        F.least(score, F.lit(1.0)).alias("score"), F.lit(k.base).alias("base"), _valid(k.name, m).alias("ok"))

    kept = F.filter(F.transform(c["m"], span), lambda s: s["ok"] & (s["base"] | (s["score"] >= min_score)))
    return F.coalesce(F.transform(kept, lambda s: s.dropFields("ok")),
                      F.array().cast("array<struct<kind:string,start:int,end:int,score:double,base:boolean>>"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


# Spans looked through together, and code points of a part of a text, in `mask`.
_SPANS, _CHARS = 128, 1024


def _reach(chunks: Column) -> Column:
    """``chunks`` (lists of spans) with the greatest end before each of them."""
    ends = F.transform(chunks, lambda c: F.array_max(F.transform(c, lambda s: s["end"])))
    before = F.aggregate(ends, F.array(F.lit(0)), lambda acc, e: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), e))))
    return F.transform(chunks, lambda c, i: F.struct(c.alias("c"), F.get(before, i).alias("reach")))


def _between(parts: Column, a: Column, b: Column) -> Column:
    """Code points ``a`` to ``b`` of a text given as parts of ``_CHARS`` each."""
    i, j = F.floor(a / _CHARS).cast("int"), F.floor((b - 1) / _CHARS).cast("int")
    one = F.substr(F.get(parts, i), a % _CHARS + 1, b - a)
    more = F.concat(F.substr(F.get(parts, i), a % _CHARS + 1, F.lit(_CHARS)), F.array_join(F.slice(parts, i + 2, j - i - 1), ""),
                    F.substr(F.get(parts, j), F.lit(1), (b - 1) % _CHARS + 1))
    return F.when(b <= a, "").when(i == j, one).otherwise(more)


def mask(df: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``df`` with every span in ``text_col`` replaced by ``<KIND>``; where spans
    overlap, their union by the kind of the first. A span looks at the ends of
    its own ``_SPANS`` neighbours and at one number for all before them, and is
    cut out of a part of the text, so work grows with the text and its spans."""
    spans, cut, parts = free_name(df, "_spans"), free_name(df, "_cut"), free_name(df, "_parts")
    step = find_spans(df, text_col, spans, **how)
    text, found = F.col(text_col), F.size(spans) > 0
    in_order = F.array_sort(F.transform(F.col(spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    step = step.withColumns({cut: F.when(found, in_order), parts: F.when(found, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHARS}}}"), F.lit(0)))})
    numbers = F.sequence(F.lit(0), F.floor((F.size(cut) - 1) / _SPANS).cast("int"))
    step = step.withColumn(cut, F.when(F.col(cut).isNotNull(), F.transform(numbers, lambda k: F.slice(F.col(cut), k * _SPANS + 1, F.lit(_SPANS)))))
    step = step.withColumn(cut, F.when(F.col(cut).isNotNull(), _reach(F.col(cut))))

    def shown(chunk: Column) -> Column:
        def one(s: Column, i: Column) -> Column:
            own = F.array_max(F.transform(F.slice(chunk["c"], F.lit(1), i), lambda x: x["end"]))
            before = F.greatest(chunk["reach"], own)  # a null is passed over
            return F.when(s["start"] >= before, F.concat(_between(F.col(parts), before, s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise("")
        return F.array_join(F.transform(chunk["c"], one), "")

    last = F.element_at(cut, -1)
    end = F.greatest(last["reach"], F.array_max(F.transform(last["c"], lambda s: s["end"])))
    masked = F.concat(F.array_join(F.transform(F.col(cut), shown), ""), _between(F.col(parts), end, F.length(text)))
    step = step.withColumn(text_col, F.when(F.col(cut).isNull(), text).otherwise(masked))
    return step.select(*[F.col(f"`{x}`") for x in df.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id", *[count_of(F.col("spans"), k.name).alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.round(s["score"], 2).cast("string")), ",").alias("scores"),
        *[count_of(F.col("spans"), k.name).alias(f"n_{k.name}") for k in KINDS if not k.base])
