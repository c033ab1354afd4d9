"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each document gets a few counts (``text_stats``). Every measure built from
them is an integer, and a sketch of a group (language, source) is its number
of documents per value of each measure: an equi-width quantile sketch with at
most ``TOP + 1`` cells, merged by adding counts, the same on every rerun and
independent of the order of rows. The quartiles of each group give its upper
fence ``q3 + SPREAD * max(q3 - q1, slack)``; a document beyond a fence of its
own group fails. Fences are upper ones: a document far below its group (words
shorter than usual) passes. The slack is a fixed floor of the spread, so in a
group of very even documents it acts like a fixed cutoff. A fixed base rule (too few words, mostly repeated words)
fails documents before they enter a sketch, so junk does not widen a fence.

Defined cases: a null or blank text has no words and fails the base rule;
null languages and sources are groups of their own; a group whose documents
all fail the base rule needs no fence; repeated rows count as often as they
occur. Joins are on (lang, source) only and move counts, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscan.llm.common import SPACES, documents, let, words
from gapscan.staging import stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
GRAM = 3
SPREAD = 3
TOP = 4000

# Measure -> (numerator, denominator, scale, slack): floor(scale * n / d), at
# most TOP. The slack is the least spread a fence allows for, so that a very
# even group does not reject its ordinary documents.
MEASURES = {
    "symbols": ("n_symbols", "word_chars", 1000, 15),
    "dup_lines": ("n_dup_lines", "n_lines", 1000, 80),
    "repeats": ("n_repeat_words", "n_words", 1000, 80),
    "word_length": ("word_chars", "n_words", 100, 60),
}


def repeated_words(ws: Column) -> Column:
    """Number of words inside a 3-word window that occurs at least twice.

    Windows are compared by their whole 64-bit hash; one sort of (hash,
    position) brings equal windows side by side.
    """
    def count(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def places(s: Column) -> Column:
            same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
            hit = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                           lambda j: same(F.get(s, j), F.get(s, j - 1)) | same(F.get(s, j), F.get(s, j + 1)))
            return F.flatten(F.transform(hit, lambda j: let(
                F.get(s, j)["i"], lambda p: F.array(*[p + k for k in range(GRAM)]))))
        covered = F.size(F.array_distinct(let(F.sort_array(placed), places)))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered).otherwise(F.lit(0))
    grams = F.transform(F.sequence(F.lit(0), F.size(ws) - GRAM),
                        lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(GRAM)]))
    return F.when(F.size(ws) > GRAM, let(grams, count)).otherwise(F.lit(0))


def text_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines (lines with a word),
    n_dup_lines and n_repeat_words, all long."""
    t = F.coalesce(F.col(text), F.lit(""))
    without = lambda chars: F.length(F.translate(t, chars, ""))
    lines = F.filter(F.split(t, "\n"), lambda s: F.btrim(s, F.lit(SPACES)) != "")
    n_words_repeats = let(words(t), lambda ws: F.struct(F.size(ws).alias("n"), repeated_words(ws).alias("r")))
    n_lines_dups = let(lines, lambda ls: F.struct(
        F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("d")))
    return (df.withColumns({"_w": n_words_repeats, "_l": n_lines_dups})
              .withColumns({"n_words": F.col("_w.n").cast("long"),
                            "word_chars": without(SPACES).cast("long"),
                            "n_symbols": (F.length(t) - without(SYMBOLS)).cast("long"),
                            "n_lines": F.col("_l.n").cast("long"),
                            "n_dup_lines": F.col("_l.d").cast("long"),
                            "n_repeat_words": F.col("_w.r").cast("long")})
              .drop("_w", "_l"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def measure(name: str) -> Column:
    num, den, scale, _ = MEASURES[name]
    value = F.expr(f"({scale} * {num}) div nullif({den}, 0)")
    return F.least(F.coalesce(value, F.lit(0)), F.lit(TOP)).cast("int")


def group_sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, measure, value, n): the sketches of all groups, from the
    documents that pass the base rule. Sketches of parts merge by adding n."""
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), measure(m).alias("value"))
                                for m in MEASURES]))
    return (stats.where(~base_failed()).select("lang", "source", cells.alias("c"))
                 .groupBy("lang", "source", "c.measure", "c.value").agg(F.count(F.lit(1)).alias("n")))


def fences(sketches: DataFrame) -> DataFrame:
    """(lang, source, fence_<measure>...): upper fences of every group."""
    group = Window.partitionBy("lang", "source", "measure")
    below = F.sum("n").over(group.orderBy("value"))
    total = F.sum("n").over(group)
    quartile = lambda q: F.min(F.when(4 * F.col("below") >= q * F.col("total"), F.col("value")))
    slack = F.create_map(*[F.lit(x) for m, v in MEASURES.items() for x in (m, v[3])])
    upper = F.col("q3") + SPREAD * F.greatest(F.col("q3") - F.col("q1"), slack[F.col("measure")])
    per = (sketches.withColumn("below", below).withColumn("total", total)
           .groupBy("lang", "source", "measure").agg(quartile(1).alias("q1"), quartile(3).alias("q3")))
    return per.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == m, upper)).alias(f"fence_{m}") for m in MEASURES])


def quality(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts..., base_failed, kept) for every row of ``docs``.

    The counts are staged once; the sketches and the verdicts both read them.
    """
    stats = stage(text_stats(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality")
    stats = stats.withColumn("base_failed", base_failed())
    limits = fences(group_sketches(stats)).withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    same_group = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    inside = F.lit(True)
    for m in MEASURES:
        inside = inside & (measure(m) <= F.col(f"fence_{m}"))
    return (stats.join(limits, same_group, "left")
                 .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
                 .drop("g_lang", "g_source", *[f"fence_{m}" for m in MEASURES]))


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document, one row per row of ``documents``."""
    return quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
