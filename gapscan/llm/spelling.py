"""Spelling variants: words one edit apart, grouped under their frequent form.

Two words are near if one inserted, deleted or replaced code point turns one
into the other. Near pairs come from asymmetric q-chunks. The word that is not
longer gives two disjoint chunks, its halves; the other gives its positional
grams of the same lengths. One edit touches one half at most, so a chunk is
preserved: the first at its place, the second moved by the difference of the
lengths (0 or 1). Of all positional grams only those at such a place can meet
a chunk, and only they are made, so that the shift condition is part of the
equality join.

Common halves are shared by thousands of words, and a group must not be paired
with itself. What remains beside a preserved chunk is again a pair within one
edit, so the method is applied to the rest as well: its halves are chunks, and
the key of the join is the preserved chunk with a preserved chunk of the rest.
A key leaves open only a quarter of a word. Where that is still shared by more
than ``HOT`` rows, the halves of the quarter refine the key once more, and so on
down to a single open place, at which all words of a group are near.
Every candidate pair is verified by its edit distance.

Counting. ``word_counts`` counts runs of letters over whole texts; partial
aggregation reduces a frequent word to one row a task before the shuffle.

Forms. A word's form is its near word of the largest n (ties: the smallest in
code-point order) if that n is at least ``RATIO`` times its own. Following forms
multiplies n by ``RATIO`` each time, so chains have at most 19 steps; roots come
from pointer doubling in at most 5 joins.

Defined cases: a null or empty text has no words; a null doc_id is the empty
string where occurrences are altered; repeated rows count each time; very long
runs are words like others; an empty table gives no rows. Only doc_id and text
are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscan.llm.common import documents, let
from gapscan.staging import stage

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
HOT = 256
ALTERED = 31

# The letters of a word after lower-casing A-Z.
LETTERS = r"[a-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def altered(doc_id: Column, run: Column, every: int) -> Column:
    """The run without one code point where ``every`` divides the checksum of
    its document and itself: planted misspellings, the same on each run."""
    h = F.crc32(F.encode(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run), "UTF-8"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, cut).otherwise(run)


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                every: int | None = None) -> DataFrame:
    """(word, n): lower-cased runs of letters of at least ``min_length`` code
    points that occur at least ``min_count`` times. With ``every``, runs are
    altered first (see ``altered``); a run of the least length that loses a
    code point is no word."""
    lower = F.translate(F.col("text"), UPPER, LOWER)
    runs = F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{min_length},}}"), F.lit(0))
    rows = docs.select("doc_id", F.explode(runs).alias("word"))
    if every:
        rows = rows.select(altered(F.col("doc_id"), F.col("word"), every).alias("word"))
    counted = rows.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _halves(start: Column, end: Column) -> list[tuple[Column, Column]]:
    """The two disjoint chunks (from, to) of the stretch from ``start`` to ``end``."""
    middle = F.floor((start + end) / 2).cast("int")
    return [(start, middle), (middle, end)]


def _key(size: Column, start: Column, end: Column, word: Column, shift: int) -> Column:
    """Hash of what a word shares when its stretch (start, end), in places of
    the chunk side, is open: everything before it in place, everything after
    it moved by ``shift``. Equal hashes of unlike words are sorted out by the
    verification."""
    return F.xxhash64(size, start, end, F.substring(word, F.lit(1), start),
                      F.substring(word, end + shift + 1, F.length(word)))


def _keyed(words: DataFrame, shift: int, levels: int = 2) -> DataFrame:
    """(key, start, end, size, word, n, shift): a word with each stretch that is
    left open by a preserved chunk of it and, for ``levels`` times, of the rest.
    ``shift`` 0: as the chunk side, or as the grams for words of its own length;
    1: as the grams for words one shorter, whose places decide the halves."""
    size = (F.length("word") - shift).cast("int")
    open_ = [(F.lit(0), size)]
    for _ in range(levels):
        # beside one preserved half the other one stays open
        open_ = [half for s, e in open_ for half in _halves(s, e)]
    stretches = F.array(*[F.struct(s.alias("start"), e.alias("end")) for s, e in open_])
    rows = words.select("word", "n", size.alias("size"), F.explode(stretches).alias("at"))
    return rows.select("word", "n", "size", "at.start", "at.end", F.lit(shift).alias("shift"),
                       _key(F.col("size"), F.col("at.start"), F.col("at.end"), F.col("word"), shift).alias("key"))


def _refined(rows: DataFrame) -> DataFrame:
    """The rows once more, each open stretch cut to its halves."""
    halves = F.array(*[F.struct(s.alias("start"), e.alias("end")) for s, e in _halves(F.col("start"), F.col("end"))])
    cut = rows.select("word", "n", "size", "shift", F.explode(halves).alias("at"))
    moved = let(F.col("shift"), lambda s: F.xxhash64(
        F.col("size"), F.col("at.start"), F.col("at.end"), F.substring(F.col("word"), F.lit(1), F.col("at.start")),
        F.substring(F.col("word"), F.col("at.end") + s + 1, F.length("word"))))
    return cut.select("word", "n", "size", "at.start", "at.end", "shift", moved.alias("key"))


def _one_edit(x: str, y: str) -> Column:
    """Do two rows of a key agree outside their open stretch, and are they one
    edit apart within it? (The distance is taken of the stretches: its cost
    grows with the square of their length.)"""
    a, b, start, end = F.col(f"{x}.word"), F.col(f"{y}.word"), F.col(f"{x}.start"), F.col(f"{x}.end")
    shift = F.col(f"{y}.shift")
    outside = ((F.substring(a, F.lit(1), start) == F.substring(b, F.lit(1), start))
               & (F.substring(a, end + 1, F.length(a)) == F.substring(b, end + shift + 1, F.length(b))))
    inside = F.levenshtein(F.substring(a, start + 1, end - start), F.substring(b, start + 1, end + shift - start), 1)
    return outside & (inside == 1)


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words once, for distinct ``words`` (word, n)."""
    found = []
    level = stage(_keyed(words, 0).unionByName(_keyed(words, 1)), "chunks")
    while True:
        # rows of a key, counted before any pair is made; keys of one row meet nobody
        sizes = level.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("end") - F.col("start")).alias("open"))
        sizes = stage(sizes.where("rows > 1"), "chunk_sizes")
        # the halves of one open place are that place and nothing, which refines nothing
        is_hot = (F.col("rows") > hot) & (F.col("open") > 1)
        rows = level.join(sizes.where(~is_hot).select("key"), "key", "left_semi")
        chunk, gram = rows.where("shift = 0").alias("x"), rows.alias("y")
        longer = F.col("y.shift") == 1
        pairs = (chunk.join(gram, F.col("x.key") == F.col("y.key"))
                 .where((F.col("x.size") == F.col("y.size")) & (F.col("x.start") == F.col("y.start"))
                        & (longer | (F.col("x.word") < F.col("y.word"))))
                 .where(_one_edit("x", "y"))
                 .select(F.col("x.word").alias("a"), F.col("x.n").alias("a_n"),
                         F.col("y.word").alias("b"), F.col("y.n").alias("b_n")))
        found.append(pairs)
        large = sizes.where(is_hot).select("key")
        if large.isEmpty():
            break
        level = stage(_refined(level.join(large, "key", "left_semi")), "chunks")
    out = found[0]
    for pairs in found[1:]:
        out = out.unionByName(pairs)
    # an insertion between two stretches is found through both
    return out.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form), form never null: the last form reached by
    following forms, by pointer doubling."""
    up = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if up.join(further, "root", "left_semi").isEmpty():
            return up
        up = stage(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(words: DataFrame, ratio: int = RATIO, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct ``words`` (word, n)."""
    pairs = stage(near_pairs(words, hot), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct(-F.col("other_n"), F.col("other"))).alias("best"))
    best = best.select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.col1")).alias("other_n"))
    taken = F.col("other_n") >= ratio * F.col("n")
    rows = stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("other")).alias("form"), F.when(taken, F.col("other_n")).alias("form_n")), "forms")
    root = roots(rows.where("form is not null"))
    return rows.join(root, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark, sf_dir: str) -> DataFrame:
    """Every word of all ``documents`` (some occurrences altered as agreed) with its form and root."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return variants(stage(word_counts(docs, every=ALTERED), "words"))
