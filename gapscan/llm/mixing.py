"""Mixing sources to target weights as a time-varying curriculum.

Targets. The mix takes ``SHARE`` times all words. Sources share it by weight;
a source's target stops at ``CAP`` times its size, and the excess is shared
again by weight until no target is above its cap.

Curriculum. A source is read pass after pass in a fixed random order (a hash
of doc_id and text). Its demand over training time t in [0, 1] is the integral of
a linear weight schedule from ``START`` to ``END`` per weight; a document whose
words begin after c words of its source gets the position t at which the
cumulative demand reaches c (the quadratic is inverted in closed form).
Documents are then range-sorted by position. The last document of a source's
demand is taken in part, so the words taken meet the target.

Scale. Running totals per source never gather a source in one task: the hash
order is cut into cells, totals run inside (source, cell), and the cells'
offsets come from a table of sums. The number of cells follows the number of
shuffle partitions and of documents; rows with equal doc_id are spread by their
texts.

Defined cases: a null text has size 0 and takes nothing; the null source is a
source of its own and comes last; repeated rows are documents of their own;
an empty table gives an empty mix. Ties of the hash are ordered by doc_id,
then by a hash of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscan.llm.common import SPACE_RUN, SPACES, WORD, default_pieces, documents
from gapscan.staging import stage

SHARE = 1.5
CAP = 2.0
PASSES = 2                   # enough for the cap
WEIGHTS = (3, 1, 2)          # by rank of the source, repeating
ROWS_PER_CELL = 20_000
# Relative weight at the start and at the end of training, by the source's
# weight: heavy sources lead, light ones come in late.
SCHEDULE = {3: (1.5, 0.5), 2: (1.0, 1.0), 1: (0.5, 1.5)}
HASH_BITS = 40


def size_of(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_weights(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight) from (source, source_size).

    The rank by code point gives the weight. Sources are counted per leading
    cell of a range-partitioned table, so ranking needs no single task.
    """
    ordered = stage(sizes.repartitionByRange(F.col("source").asc_nulls_last())
                         .withColumn("part", F.spark_partition_id()), "sources")
    local = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    rank = F.col("before") + F.row_number().over(local) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("r") % len(WEIGHTS) + 1).cast("int"))
    return (ordered.join(before, "part").withColumn("r", rank)
                   .select("source", "source_size", weight.alias("weight")))


def targets(sources: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Add ``target``: water filling. Each round shares what is left among the
    sources below their cap; a round that caps no further source is the last
    (the driver sees one row of sums a round)."""
    sources = stage(sources, "weights")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    ceiling = F.col("source_size") * F.lit(cap)
    level = 0.0  # words per unit of weight; a source is capped when its share reaches its ceiling
    while True:
        capped = ceiling <= F.col("weight") * F.lit(level)
        row = sources.agg(F.sum(F.when(capped, ceiling)).alias("full"),
                          F.sum(F.when(~capped, F.col("weight"))).alias("open")).first()
        if not row["open"]:
            break
        new = (share * total - (row["full"] or 0.0)) / row["open"]
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(ceiling, F.col("weight") * F.lit(level)))


def demand_time(weight: Column, target: Column, c: Column) -> Column:
    """Time in [0, 1] at which a source's cumulative demand reaches ``c`` words.

    Demand density a + (b - a) t, scaled to ``target`` words at t = 1:
    D(t) = target * (a t + (b - a) t^2 / 2) / ((a + b) / 2).
    """
    a, b = (F.element_at(F.create_map(*[F.lit(x) for w, ab in SCHEDULE.items() for x in (w, ab[i])]), weight)
            for i in (0, 1))
    need = F.try_divide(c, target) * (a + b) / 2
    slope = (b - a) / 2
    root = (-a + F.sqrt(F.greatest(a * a + 4 * slope * need, F.lit(0.0)))) / (2 * slope)
    return F.when(slope == 0, need / a).otherwise(root) + F.lit(0.0)  # no negative zero


def plan(docs: DataFrame) -> DataFrame:
    """(doc_id, tie, source, size, weight, source_size, target, first_at, taken, position).

    One row per input row; ``first_at`` is the number of words of its source
    before it in a pass, ``taken`` the words taken over all passes, ``position``
    the time of its first words (null when nothing is taken).
    """
    tie = F.xxhash64("text")
    base = stage(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"),
                             F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "doc_id", tie), 64 - HASH_BITS).alias("h"),
                             tie.alias("tie")), "sizes")
    # a few cells for every task, so that a hot source keeps all of them busy
    cells = max(default_pieces(docs), -(-base.count() // ROWS_PER_CELL))
    base = base.withColumn("cell", F.expr(f"cast((h * {cells}L) div {1 << HASH_BITS}L as int)"))
    per_cell = base.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    offset = F.sum("cell_size").over(Window.partitionBy("source").orderBy("cell")
                                     .rowsBetween(Window.unboundedPreceding, -1))
    per_cell = stage(per_cell.withColumn("offset", F.coalesce(offset, F.lit(0))), "cells")
    sources = targets(source_weights(per_cell.groupBy("source").agg(F.sum("cell_size").alias("source_size"))))
    cell_info = (per_cell.join(sources.withColumnRenamed("source", "s"),
                               F.col("source").eqNullSafe(F.col("s")))
                 .select(F.col("source").alias("c_source"), F.col("cell").alias("c_cell"),
                         "offset", "source_size", "weight", "target"))
    inside = F.sum("size").over(Window.partitionBy("source", "cell").orderBy("h", "doc_id", "tie")
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    rows = (base.withColumn("inside", inside)
                .join(cell_info, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("cell") == F.col("c_cell")))
                .withColumn("first_at", F.col("offset") + F.col("inside")))
    return rows.withColumns({"taken": taken(F.col("first_at"), F.col("size"), F.col("source_size"), F.col("target")),
                             "position": F.when(
                                 (F.col("size") > 0) & (F.col("first_at") < F.floor("target")),
                                 demand_time(F.col("weight"), F.col("target"), F.col("first_at")))}).select(
        "doc_id", "tie", "source", "size", "weight", "source_size", "target", "first_at", "taken", "position")


def taken_in_pass(p: int, first_at: Column, size: Column, source_size: Column, target: Column) -> Column:
    """Words taken in pass ``p`` (from 0): the part of the document's interval below the target."""
    left = F.floor(target) - (first_at + p * source_size)
    return F.greatest(F.least(left, size), F.lit(0)).cast("long")


def taken(first_at: Column, size: Column, source_size: Column, target: Column) -> Column:
    parts = [taken_in_pass(p, first_at, size, source_size, target) for p in range(PASSES)]
    return sum(parts[1:], parts[0])


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word (it must have more words than n)."""
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    rest = F.element_at(F.split(text, SPACE_RUN, (n + 1 + lead).cast("int")), -1)
    return F.rtrim(F.substring(text, F.lit(1), F.length(text) - F.length(rest)), F.lit(SPACES))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: the input's columns, one row per taken copy of a
    document, range-sorted by training position. A copy taken in part keeps
    its first words, with the white space between them."""
    # rows equal in all three have the same plan, so they may be told apart in any order
    key = ["doc_id", "tie", "source"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))
    info = plan(docs).withColumn("nth", nth)
    passes = F.array(*[F.struct(F.lit(p).alias("p"), taken_in_pass(
        p, F.col("first_at"), F.col("size"), F.col("source_size"), F.col("target")).alias("n"))
        for p in range(PASSES)])
    copies = (info.withColumn("c", F.explode(passes)).where(F.col("c.n") > 0)
              .withColumn("at", demand_time(F.col("weight"), F.col("target"),
                                            F.col("first_at") + F.col("c.p") * F.col("source_size")))
              .select(*[F.col(k).alias(f"k_{k}") for k in key], F.col("nth").alias("k_nth"), "at",
                      F.col("c.n").alias("n"), "size"))
    left = (docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("tie"), "source")
                .withColumn("nth", nth))
    same = (F.col("doc_id").eqNullSafe(F.col("k_doc_id")) & F.col("source").eqNullSafe(F.col("k_source"))
            & (F.col("tie") == F.col("k_tie")) & (F.col("nth") == F.col("k_nth")))
    text = F.col("row.text")
    out = left.join(copies, same).select(
        "row", "doc_id", "at",
        F.when(F.col("n") < F.col("size"), first_words(text, F.col("n"))).otherwise(text).alias("part"))
    ranged = out.repartitionByRange("at", "doc_id").sortWithinPartitions("at", "doc_id")
    return ranged.select(*[F.col("part").alias("text") if c == "text" else F.col("row")[c].alias(c)
                           for c in docs.columns])


def op5_mix(spark, sf_dir: str) -> DataFrame:
    """Words taken of every document and its training position, one row per
    row of ``documents``, range-sorted by position."""
    rows = plan(documents(spark, sf_dir))
    return (rows.select("doc_id", "size", "source_size", "target", "taken", "position")
                .repartitionByRange(F.col("position").asc_nulls_last(), "doc_id")
                .sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id"))
