"""Document fingerprints: bottom-k sketches of word shingles.

A fingerprint is the ascending array of the ``k`` smallest distinct 64-bit
hashes (XXH64) of a text's shingles of ``width`` consecutive words. Sketches
of parts merge into the sketch of the whole, and two sketches estimate
resemblance, containment and the number of distinct shingles; a set of fewer
than ``k`` shingles is kept whole, so its estimates are exact.

Defined cases: a text of one to ``width - 1`` words is one shingle; a null,
empty or blank text has the empty sketch; two empty sketches resemble each
other fully (1.0), an empty and a non-empty one not at all (0.0). Only the
text column is read, so other columns pass through under their own names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscan.llm.common import Segments, default_pieces, documents, let, order_key, segment_starts, words

WIDTH = 5
SIZE = 256


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all shingles of a text, in order, repeats included."""
    def hashes(ws: Column) -> Column:
        last = F.greatest(F.size(ws) - width, F.lit(0))
        shingles = F.transform(F.sequence(F.lit(0), last),
                               lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(width)]))
        return F.when(F.size(ws) > 0, shingles).otherwise(F.expr("cast(array() as array<bigint>)"))
    return let(words(text), hashes)


def bottom_k(hashes: Column, k: int = SIZE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def fingerprint(text: Column, width: int = WIDTH, k: int = SIZE) -> Column:
    """Bottom-k sketch of a text."""
    return bottom_k(shingle_hashes(text, width), k)


def merged(a: Column, b: Column, k: int = SIZE) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated Jaccard similarity: the share of the union's bottom-k that lies in both."""
    u = merged(a, b, k)
    both = F.size(F.array_intersect(u, F.array_intersect(a, b)))
    return (F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
             .otherwise(both / F.size(u)))


def containment(a: Column, b: Column, k: int = SIZE) -> Column:
    """Estimated share of a's shingles that b has too (1.0 when a is empty)."""
    u = merged(a, b, k)
    in_a = F.size(F.array_intersect(u, a))
    both = F.size(F.array_intersect(u, F.array_intersect(a, b)))
    return F.when(F.size(a) == 0, F.lit(1.0)).when(in_a == 0, F.lit(0.0)).otherwise(both / in_a)


def distinct_shingles(sketch: Column, k: int = SIZE) -> Column:
    """Number of distinct shingles: exact below k, else (k - 1) / position of the k-th hash."""
    share = (F.element_at(sketch, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def merge_sketches(df: DataFrame, keys: Sequence[str], sketch: str, k: int = SIZE) -> DataFrame:
    """One sketch for each value of ``keys`` from the sketches of its parts.

    Null sketches count as empty. Repeated hashes are dropped before and
    after the shuffle, and the rank limit keeps k rows per key and task on
    the map side, so a hot key sends k hashes from each task.
    """
    hashes = df.select(*keys, F.explode(F.col(sketch)).alias("_hash")).distinct()
    w = Window.partitionBy(*keys).orderBy("_hash")
    best = (hashes.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
            .groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch)))
    empty = F.expr("cast(array() as array<bigint>)")
    every = df.select(*keys).distinct()
    on = [every[c].eqNullSafe(best[c]) for c in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return every.join(best, cond, "left").select(*[every[c] for c in keys],
                                                 F.coalesce(best[sketch], empty).alias(sketch))


def beside_next(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """(segment, sentinel, doc_id, text, tie, next_text): every document beside its
    successor in ascending doc_id order, the first one following the last.

    The table is cut into segments of the order of doc_id and a hash of the text,
    moved once by segment and read with ``lead``. The first document of each
    segment is also sent to the segment before it (of the first one, to the
    last) as a sentinel row, so no segment needs another. Documents with equal
    doc_id are spread by the hash; only rows equal in both share a segment.
    Rows without doc_id come last. Sentinel rows remain (later windows need
    them); drop them in the end.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"place": order_key(F.col("doc_id")), "tie": F.xxhash64("text")})
    starts = segment_starts(docs, "place", "tie", pieces or default_pieces(docs))
    cut = Segments(starts)
    rows = docs.withColumn("segment", cut.of(F.col("place"), F.col("tie")))
    here = F.struct(F.col("segment"), F.lit(False).alias("sentinel"))
    there = F.struct(F.pmod(F.col("segment") - 1, F.lit(max(cut.n, 1))).alias("segment"), F.lit(True).alias("sentinel"))
    is_start = cut.start_is(F.col("segment"), F.col("place"), F.col("tie"))
    rows = (rows.withColumn("at", F.explode(F.when(is_start, F.array(here, there)).otherwise(F.array(here))))
                .select("at.segment", "at.sentinel", "doc_id", "text", "tie"))
    return rows.withColumn("next_text", F.coalesce(F.lead("text").over(in_order()), F.lit("")))


def in_order():
    return Window.partitionBy("segment").orderBy(
        "sentinel", F.col("doc_id").asc_nulls_last(), "tie")


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, with their likeness.

    Edited: the last floor(n/2) code points give way to the first as many (or
    all) of the next document. One row per row of ``documents``.
    """
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = (beside_next(documents(spark, sf_dir))
            .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                                           F.substring(F.col("next_text"), F.lit(1), half)))
            .select("segment", "sentinel", "doc_id", "tie",
                    n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                    fingerprint(F.col("text")).alias("sketch"),
                    fingerprint(F.col("edited")).alias("edited_sketch")))
    rows = (rows.withColumn("next_sketch", F.coalesce(F.lead("sketch").over(in_order()),
                                                      F.expr("cast(array() as array<bigint>)")))
                .where(~F.col("sentinel")))
    as_text = lambda c: F.array_join(F.transform(c, lambda h: F.lpad(F.hex(h), 16, "0")), "")
    return rows.select("doc_id", "n_chars", "edited_sha256",
                       as_text("sketch").alias("fingerprint"),
                       as_text("edited_sketch").alias("edited_fingerprint"),
                       resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
                       distinct_shingles(F.col("sketch")).alias("n_shingles"))
