"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

For each kind a regular expression proposes spans (leftmost, non-overlapping)
and a validator confirms or drops them: card numbers by Luhn, IBANs by mod-97,
addresses by the size of their parts, phone numbers by their digits. A span
starts with the score of its kind; context words within ``NEAR`` characters
raise it. Kinds marked ``base`` stay whatever their score; the others need
``MIN_SCORE``.

Positions are code points, end exclusive. They come from the lengths of the
matches and of the text between them (``split`` by the same pattern). Time is
in proportion to a text and its spans (times the logarithm of their number).

Defined cases: a null or empty text has no spans (an empty array); spans of
different kinds may overlap; equal texts give equal spans. Only the text
column is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscan.llm.common import documents, let

NEAR = 48
MIN_SCORE = 0.5
CONTEXT_BONUS = 0.3


@dataclass(frozen=True)
class Kind:
    """``pattern`` never matches empty text. Where a run of characters could be
    tried from each of its positions, the pattern only starts at the run's
    first character or where the match before it ended (``\\G``): the matches
    are the same and the scan stays linear on very long runs. Repeated groups
    are possessive, so the regex engine needs no stack for them."""
    name: str
    pattern: str
    hint: str          # a text without this substring has no match ("" for none)
    score: float
    context: str       # words that make the kind likelier
    base: bool


KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "@", 0.6, r"(?i)e-?mail|contact|write to|correo|courriel", True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", ".", 0.5,
         r"(?i)\bip\b|address|host|server|adresse", True),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9]){11,}+", "", 0.6,
         r"(?i)card|visa|credit|debit|payment|karte|tarjeta|carte", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.5,
         r"(?i)phone|\btel|call|mobile|fax|telefon|tel[eé]fono", True),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         "", 0.6, r"(?i)iban|bank|konto|cuenta|compte|account", False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "-", 0.3,
         r"(?i)\bssn\b|social security|taxpayer", False),
]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    def step(total: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step)
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Does a string of letters and digits, its first four characters moved to
    the end and letters read as 10 to 35, leave 1 when divided by 97?"""
    moved = F.concat(F.substring(value, 5, 1000), F.substring(value, 1, 4))
    def step(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)
    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def valid(kind: str, value: Column) -> Column:
    """The validator of a kind, for a proposed value."""
    if kind == "ip":
        def small(part: Column) -> Column:
            significant = F.ltrim(part, F.lit("0"))
            return (F.length(significant) <= 3) & (F.coalesce(significant.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    if kind == "iban":
        return let(F.replace(value, F.lit(" "), F.lit("")),
                   lambda v: F.when(F.length(v).between(15, 34), mod97(v)).otherwise(False))
    return F.lit(True)


def running_totals(numbers: Column) -> Column:
    """Totals up to each element of an array, by doubling: after the step of 2^k
    an element holds the sum of the last 2^(k + 1). The work is n log n."""
    def total(ns: Column) -> Column:
        def added(s: Column, k: Column) -> Column:
            step = F.pow(F.lit(2), k).cast("int")
            return F.transform(s, lambda x, i: x + F.when(i >= step, F.get(s, i - step)).otherwise(0))
        rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(ns))).cast("int") - 1)
        return F.when(F.size(ns) > 1, F.aggregate(rounds, ns, added)).otherwise(ns)
    return let(numbers, total)


# The least length of a match of any pattern: so many matches fill NEAR characters.
LEAST_MATCH = 4
NEIGHBOURS = NEAR // LEAST_MATCH


def spans_of(text: Column, kind: Kind, rank: int) -> Column:
    """Confirmed and scored spans of one kind: (start, rank, kind, end, value, score).

    The text falls into gaps and matches in turn. Places are running totals of
    their lengths. The NEAR characters on either side of a span are the ends of
    the gaps and matches beside it, at most ``NEIGHBOURS`` of each, so no span
    looks at the whole text and the time follows the number of spans.
    """
    none = F.expr("cast(array() as array<struct<start:bigint,rank:int,kind:string,"
                  "end:bigint,value:string,score:double>>)")
    tail = lambda c: F.right(c, F.lit(NEAR))
    head = lambda c: F.left(c, F.lit(NEAR))

    def place(parts: Column) -> Column:
        ms, gaps = parts["matches"], parts["gaps"]
        # gap, match, gap, match, ...: as they end, and as they begin after a match
        ending = F.flatten(F.zip_with(F.slice(gaps, F.lit(1), F.size(ms)), ms, lambda g, m: F.array(tail(g), tail(m))))
        beginning = F.flatten(F.zip_with(
            F.slice(gaps, F.lit(2), F.size(ms)), F.concat(F.slice(ms, F.lit(2), F.size(ms)), F.array(F.lit(""))),
            lambda g, m: F.array(head(g), head(m))))
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(ms)), ms,
                             lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        known = F.struct(ms.alias("matches"), running_totals(lengths).alias("ends"),
                         ending.alias("ending"), beginning.alias("beginning"))
        return let(known, confirmed)

    def confirmed(k: Column) -> Column:
        def scored(value: Column, i: Column) -> Column:
            # up to the gap before span i, and from the gap after it
            first = F.greatest(2 * i - 2 * NEIGHBOURS, F.lit(0))
            left = tail(F.array_join(F.slice(k["ending"], first + 1, 2 * i + 1 - first), ""))
            right = head(F.array_join(F.slice(k["beginning"], 2 * i + 1, F.lit(2 * NEIGHBOURS + 1)), ""))
            bonus = F.when(left.rlike(kind.context) | right.rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
            end = F.get(k["ends"], i)
            return F.struct((end - F.length(value)).alias("start"), F.lit(rank).alias("rank"),
                            F.lit(kind.name).alias("kind"), end.alias("end"), value.alias("value"),
                            (F.lit(kind.score) + bonus).alias("score"))
        spans = F.transform(k["matches"], lambda m, i: F.when(valid(kind.name, m), scored(m, i)))
        least = 0.0 if kind.base else MIN_SCORE
        return F.filter(spans, lambda s: s.isNotNull() & (s["score"] >= least))

    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    spans = let(found, lambda ms: F.when(F.size(ms) > 0, let(
        F.struct(ms.alias("matches"), F.split(text, kind.pattern, -1).alias("gaps")), place)).otherwise(none))
    return F.when(F.contains(text, F.lit(kind.hint)), spans).otherwise(none) if kind.hint else spans


def find_pii(df: DataFrame, text: str = "text", out: str = "pii", kinds: list[Kind] = KINDS) -> DataFrame:
    """Add ``out``: all spans by start, then by the order of ``kinds``."""
    t = F.coalesce(F.col(text), F.lit(""))
    return df.withColumn(out, F.sort_array(F.concat(*[spans_of(t, k, i) for i, k in enumerate(kinds)])))


def op2_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document, one row per row of ``documents``."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = find_pii(docs).select("doc_id", "pii")
    count = lambda name: F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long")
    joined = lambda c: F.array_join(F.transform(
        c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = [k.name for k in KINDS if k.base]
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in base],
                        F.sha2(joined(F.filter("pii", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
                        joined(F.col("pii")).alias("spans"),
                        F.array_join(F.transform("pii", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"))
