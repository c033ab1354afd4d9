"""Line dedup by pairwise alignment.

Documents that share lines are found through line hashes, each pair is
aligned by patience diff, and common blocks of at least ``MIN_WORDS`` words
are deleted from the later document (the one with the larger doc_id).

Finding pairs. Lines are compared trimmed, blank lines do not count. A line
that several documents hold is *shared*. A block can only lie in a run of
consecutive shared lines of its document, so lines in runs of fewer than
``MIN_WORDS`` words are set aside first; this loses no block. What is left is cut
into *windows*: the shortest stretches of consecutive lines from each line on, and
up to each line, that have ``MIN_WORDS`` words. Every common block is covered by
windows that lie in it: those from its lines on reach the last place where a
window can start, and the one up to its last line starts there. Documents meet
at the rarest line of each window, where those that hold the whole window are
linked to the first of them. A window of n documents makes n - 1 links, never
all pairs, none is skipped for being frequent, and no block is missed.

Aligning. A pair needs only the windows that it shares, their places in the
later document and where they begin in the earlier one; an earlier document that
many others link to is not copied beyond that, and texts do not move. Patience
diff over the windows in order anchors on those that occur once on either side
(where there are none, on the k-th occurrence of each), takes the longest
increasing chain, grows it over equal neighbours, and repeats between anchors.
Lines of matched windows are common blocks in order; lines of the windows that
are left stand in another order or are repeated (*moved*). Both are deleted, so
what goes is all lines of all maximal common runs of at least ``MIN_WORDS``
words.

Lines are told apart by a 64-bit hash. Two unlike lines of n distinct ones agree
with a chance of about n^2 / 2^65; a deletion needs all lines of a window to
agree, for windows of two lines a chance of the square of that.
The lines to delete are gathered per document and applied in one join with the
texts.

Defined cases: a null, empty or blank text has no lines and stays as it is;
rows without doc_id take no part and stay as they are; rows with equal doc_id
are ordered by a hash of their text, and rows equal in both are one document
whose copies are treated alike; a document whose lines all go keeps its row
with an empty text. Only doc_id and text are read; other columns pass through
(n_chars, where it exists, follows the new text).
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapscan.llm.common import SPACE_RUN, SPACES, documents
from gapscan.staging import stage

MIN_WORDS = 30

KEY = ["doc_id", "tie"]


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, nth, at, h, words): the lines with a word of every
    document, numbered among themselves (nth) and among all its lines (at)."""
    lines = F.transform(F.split(F.col("text"), "\n"),
                        lambda s, i: F.struct(i.alias("at"), F.btrim(s, F.lit(SPACES)).alias("line")))
    lines = F.filter(lines, lambda x: x["line"] != "")
    hashed = F.transform(lines, lambda x: F.struct(
        x["at"].alias("at"), F.xxhash64(x["line"]).alias("h"),
        F.size(F.split(x["line"], SPACE_RUN)).alias("words")))
    return (docs.where("doc_id is not null and text is not null")
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"),
                    F.posexplode(hashed).alias("nth", "x"))
            .select(*KEY, "nth", "x.at", "x.h", "x.words"))


def shared_lines(lines: DataFrame, min_words: int) -> DataFrame:
    """The lines that lie in a run of at least ``min_words`` words of shared
    lines, with the number of their occurrences and their first document."""
    doc = F.struct(*KEY)
    shared = (lines.groupBy("h").agg(F.min(doc).alias("first"), F.max(doc).alias("last"),
                                     F.count(F.lit(1)).alias("n"))
              .where("first <> last").select("h", "first", "n"))
    # staged, so that both sides of the join come from plain shuffles and a
    # very common line can be split over tasks
    held = lines.join(stage(shared, "common"), "h")
    in_doc = Window.partitionBy(*KEY)
    run = F.col("nth") - F.dense_rank().over(in_doc.orderBy("nth"))
    # rows equal in doc_id and text are one document
    held = held.dropDuplicates([*KEY, "nth"]).withColumn("run", run)
    words = F.sum("words").over(Window.partitionBy(*KEY, "run"))
    return held.withColumn("run_words", words).where(F.col("run_words") >= min_words).drop("run", "run_words")


def _spans(lines: list[tuple], min_words: int) -> list[tuple[int, int]]:
    """(from, to) of the shortest stretch of at least ``min_words`` words from
    each line on; a stretch has no gap in nth, which may also descend."""
    out, end, total = [], 0, 0
    for i, line in enumerate(lines):
        while total < min_words and end < len(lines) and (end == i or abs(lines[end][0] - lines[end - 1][0]) == 1):
            total += lines[end][3]
            end += 1
        if total >= min_words:
            out.append((i, end))
        total -= line[3]
    return out


def windows(lines: list[tuple], min_words: int) -> list[tuple[int, int, tuple]]:
    """(from, to, hashes) of the shortest stretches of at least ``min_words``
    words from each line on and up to each line, once each; lines are
    (nth, at, h, words), and a stretch has no gap in nth."""
    n = len(lines)
    up_to = {(n - end, n - i) for i, end in _spans(lines[::-1], min_words)}
    return [(i, end, tuple(x[2] for x in lines[i:end]))
            for i, end in sorted(up_to.union(_spans(lines, min_words)))]


def _places(min_words: int):
    """Arrow task: a document a row -> a row for each of its windows: its rarest
    line, its hash, where it begins each time, and the places of its lines."""
    def run(batches):
        for b in batches:
            rows = []
            for doc_id, tie, lines in zip(*(b.column(i).to_pylist() for i in range(3))):
                lines = [(x["nth"], x["at"], x["h"], x["words"], x["n"]) for x in lines]
                own: dict[int, tuple] = {}
                for i, end, hs in windows(lines, min_words):
                    w = xxhash.xxh64_intdigest(np.array(hs, dtype="<i8").tobytes())
                    if w not in own:
                        own[w] = (min((x[4], x[2]) for x in lines[i:end])[1], [], [])
                    own[w][1].append(lines[i][0])
                    own[w][2].append([x[1] for x in lines[i:end]])
                rows += [(rare, w, doc_id, tie, froms, ats) for w, (rare, froms, ats) in own.items()]
            if not rows:
                continue
            rare, ws, ids, ties, froms, ats = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rare, pa.int64()), pa.array(np.array(ws, dtype=np.uint64).view(np.int64)),
                 pa.array(ids, pa.int64()), pa.array(ties, pa.int64()), pa.array(froms, pa.list_(pa.int32())),
                 pa.array(ats, pa.list_(pa.list_(pa.int32())))], ["rare", "w", *KEY, "froms", "ats"])
    return run


def shared_windows(viable: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, tie, earlier, windows): for each document and each first holder of
    any of its windows, those windows (w, froms, ats, begins)."""
    line = F.struct("nth", "at", "h", "words", "n")
    held = viable.groupBy(*KEY).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    found = stage(held.select(*KEY, "lines").mapInArrow(
        _places(min_words), "rare bigint, w bigint, doc_id bigint, tie bigint, froms array<int>, ats array<array<int>>"),
        "windows")
    doc = F.struct(*KEY)
    # staged, so that a very common window can be split over tasks
    first = stage(found.groupBy("rare", "w").agg(F.min(F.struct(*KEY, "froms")).alias("first"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("rare", "w", F.struct("first.doc_id", "first.tie").alias("earlier"),
                                         F.col("first.froms").alias("begins")), "first")
    later = found.join(first, ["rare", "w"]).where(doc != F.col("earlier"))
    return later.groupBy(*KEY, "earlier").agg(F.collect_list(F.struct("w", "froms", "ats", "begins")).alias("windows"))


def _chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain of (i, j), i ascending in the input, with increasing j."""
    tails, at, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tails, j)
        back.append(at[p - 1] if p else -1)
        if p == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[p], at[p] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def _anchors(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Index pairs of lines unique on both sides of a region; where there are
    none, of the k-th occurrences of each line."""
    def places(x, lo, hi):
        found = {}
        for i in range(lo, hi):
            found.setdefault(x[i], []).append(i)
        return found
    pa_, pb = places(a, a0, a1), places(b, b0, b1)
    common = [h for h in pa_ if h in pb]
    single = [(pa_[h][0], pb[h][0]) for h in common if len(pa_[h]) == len(pb[h]) == 1]
    return sorted(single or [ij for h in common for ij in zip(pa_[h], pb[h])])


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched index pairs of two sequences by patience diff, ascending."""
    matched, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        chain = _chain(_anchors(a, b, a0, a1, b0, b1))
        if not chain:
            continue
        # between two anchors the region's own ends grow; the anchors start the next one
        for (i, j), (i2, j2) in zip([*chain], [*chain[1:], (a1, b1)]):
            todo.append((i, i2, j, j2))
        todo.append((a0, chain[0][0], b0, chain[0][1]))
    return sorted(matched)


def aligned(shared: list[tuple[int, list, list, list]]) -> tuple[set[int], set[int]]:
    """Places of the later document's lines in common blocks: those of windows
    that the alignment matches, and the others. ``shared`` holds (window, where it
    begins in the later document, the places of its lines each time, where it
    begins in the earlier document)."""
    mine = sorted((begin, w, ats) for w, froms, lines, _ in shared for begin, ats in zip(froms, lines))
    theirs = sorted((begin, w) for w, _, _, begins in shared for begin in begins)
    matched = {i for i, _ in patience([w for _, w, _ in mine], [w for _, w in theirs])}
    in_order = {at for i in matched for at in mine[i][2]}
    return in_order, {at for _, _, ats in mine for at in ats} - in_order


def common_blocks(a: list[tuple], b: list[tuple], min_words: int) -> tuple[set[int], set[int]]:
    """``aligned`` for two documents given by their lines (nth, at, hash, words)."""
    begins: dict[tuple, list[int]] = {}
    for i, _, hs in windows(b, min_words):
        begins.setdefault(hs, []).append(b[i][0])
    own: dict[tuple, tuple[list, list]] = {}
    for i, end, hs in windows(a, min_words):
        if hs in begins:
            froms, ats = own.setdefault(hs, ([], []))
            froms.append(a[i][0])
            ats.append([x[1] for x in a[i:end]])
    number = {hs: k for k, hs in enumerate(own)}
    return aligned([(number[hs], froms, ats, begins[hs]) for hs, (froms, ats) in own.items()])


def _align(batches):
    """Arrow task: a pair of documents a row -> (doc_id, tie, at, moved) to delete."""
    for b in batches:
        rows = []
        for doc_id, tie, shared in zip(*(b.column(i).to_pylist() for i in range(3))):
            found = aligned([(x["w"], x["froms"], x["ats"], x["begins"]) for x in shared])
            rows += [(doc_id, tie, at, moved) for ats, moved in zip(found, (False, True)) for at in ats]
        if rows:
            ids, ties, ats, moved = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ties, pa.int64()),
                                              pa.array(ats, pa.int32()), pa.array(moved)], [*KEY, "at", "moved"])


def lines_to_delete(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tie, deleted, n_moved): the places of the lines that go, for each
    document that loses any, and how many of them no alignment has in order."""
    lines = stage(lines_of(docs), "lines")
    pairs = shared_windows(shared_lines(lines, min_words), min_words)
    gone = pairs.select(*KEY, "windows").mapInArrow(_align, "doc_id bigint, tie bigint, at int, moved boolean")
    lost = gone.groupBy(*KEY, "at").agg(F.min("moved").alias("moved"))
    return lost.groupBy(*KEY).agg(F.sort_array(F.collect_list("at")).alias("deleted"),
                                  F.count_if("moved").alias("n_moved"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(row, text, deleted, n_moved, n_words): every input row as a struct, its
    text without the deleted lines, their places (null: none), how many of them
    moved, and their words."""
    gone = lines_to_delete(docs, min_words).select(
        F.col("doc_id").alias("g_id"), F.col("tie").alias("g_tie"), "deleted", "n_moved")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.xxhash64("text").alias("tie"))
    rows = rows.join(gone, (F.col("id") == F.col("g_id")) & (F.col("tie") == F.col("g_tie")), "left")
    text = F.col("row.text")
    # both arrays ascend; a set difference of places keeps this linear
    places = F.array_except(F.sequence(F.lit(0), F.size(F.split(text, "\n")) - 1), F.col("deleted"))
    left = F.transform(F.array_sort(places), lambda i: F.get(F.col("parts"), i))
    lost = F.transform(F.col("deleted"), lambda i: F.get(F.col("parts"), i))
    rows = rows.withColumn("parts", F.when(F.col("deleted").isNotNull(), F.split(text, "\n")))
    return rows.select(
        "row", F.when(F.col("deleted").isNull(), text).otherwise(F.array_join(left, "\n")).alias("text"),
        "deleted", F.coalesce("n_moved", F.lit(0).cast("long")).alias("n_moved"), F.coalesce(F.regexp_count(F.array_join(lost, "\n"), F.lit(r"[^\x20\x09-\x0D]+")),
                              F.lit(0)).cast("long").alias("n_words"))


def without_common_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, texts without the lines that go."""
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    out = dedup_lines(docs)
    return out.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of ``documents`` with its remaining text and what it lost."""
    out = dedup_lines(documents(spark, sf_dir))
    return out.select("row.doc_id", F.when(F.col("deleted").isNull(), 0).otherwise(F.size("deleted")).cast("long").alias("n_deleted_lines"),
                      F.col("n_words").alias("n_deleted_words"), F.col("n_moved").alias("n_moved_lines"),
                      F.coalesce(F.array_join(F.col("deleted").cast("array<string>"), ","), F.lit("")).alias("deleted_lines"),
                      "text")
