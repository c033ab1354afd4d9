"""SimHash near-duplicates: pigeonhole blocks, Hamming verification, components.

Fingerprint: ASCII letters are lower-cased, words are joined to shingles of
``WIDTH`` words, every shingle (repeats included) is hashed by XXH64 with seed
42, and a bit is 1 when more than half of the hashes have it.

Links: two fingerprints link when at most ``DISTANCE`` bits differ. Equal
fingerprints are folded first. The 64 bits are split into ``BLOCKS`` blocks;
two linked fingerprints agree in at least ``BLOCKS - DISTANCE`` of them, so
each fingerprint is sent under every choice of that many blocks and meets all
its partners. A group of at most ``GROUP`` fingerprints that share their
chosen blocks is compared inside one task, which returns a spanning forest of
its links (fewer rows than fingerprints, the same components). A larger group
is split again the same way over its other bits, at most twice; then at most
256 distinct fingerprints can share a key. No link is lost and no group
emits its pairs.

Components of the links are found by rounds of star contraction on staged
tables.

Defined cases: a null, empty or blank text has fingerprint 0, which links like
any other; a text of fewer than ``WIDTH`` words is one shingle; rows without
doc_id belong to their component, whose id is the least doc_id in it (null
when there is none); repeated rows are members of the same component.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapscan.llm.common import documents
from gapscan.staging import stage

WIDTH = 3
DISTANCE = 3
BLOCKS = 6
GROUP = 2048
SEED = 42


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """SimHash of one text, unsigned."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII letters, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - width + 1, 1)
    last = ends[width - 1:] if len(words) >= width else ends[-1:]
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 8192):
        hashes = np.array([digest(view[a:z], SEED) for a, z in
                           zip(starts[lo:lo + 8192].tolist(), last[lo:lo + 8192].tolist())], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n)
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = WIDTH, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys..., fp): the long columns ``keys`` and the fingerprint as a signed long."""
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, width) for t in b.column(len(keys)).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keys)], pa.array(fps.view(np.int64))], [*keys, "fp"])
    return docs.select(*[F.col(k).cast("long").alias(k) for k in keys], "text").mapInArrow(
        run, ", ".join(f"{k} bigint" for k in [*keys, "fp"]))


def block_masks(free: int, blocks: int, distance: int) -> list[tuple[int, int]]:
    """(kept, other) bit masks for every choice of ``blocks - distance`` of the
    blocks into which the bits of ``free`` are split."""
    bits = [i for i in range(64) if free >> i & 1]
    parts = [sum(1 << i for i in p.tolist()) for p in np.array_split(np.array(bits, dtype=object), blocks)]
    out = []
    for choice in combinations(range(blocks), blocks - distance):
        kept = sum(parts[i] for i in choice)
        out.append((kept, free & ~kept))
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Spanning forest, as index pairs, of the links between distinct unsigned fingerprints."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    links = []
    for i in range(len(fps) - 1):
        near = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= distance) + i + 1
        for j in near.tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[b] = a
                links.append((i, j))
    return links


def _forests(distance: int):
    """Arrow task: one group of fingerprints a row -> links."""
    def run(batches):
        for b in batches:
            groups = b.column(0)
            at, values = groups.offsets.to_numpy(), groups.values.to_numpy().view(np.uint64)
            out = [np.empty((0, 2), dtype=np.uint64)]
            for lo, hi in zip(at, at[1:]):
                if pairs := forest(values[lo:hi], distance):
                    out.append(values[lo:hi][np.array(pairs)])
            links = np.concatenate(out).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])
    return run


def near_links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, group: int = GROUP) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` whose components
    are those of all pairs within ``distance`` bits."""
    spark, found, frees = fps.sparkSession, None, [(1 << 64) - 1]
    for depth in range(3):
        # how each set of free bits is split: 20, 400 or 8000 fixed rows
        masks = [(_signed(f), _signed(kept), _signed(other)) for f in frees
                 for kept, other in block_masks(f, blocks, distance)]
        frees = sorted({other for f in frees for _, other in block_masks(f, blocks, distance)})
        if depth == 0:  # all bits are free: the same 20 masks for every fingerprint
            choices = F.array(*[F.struct(F.lit(kept).cast("long").alias("kept"), F.lit(other).cast("long").alias("other"))
                                for _, kept, other in masks])
            masked = fps.select("fp", F.lit("").alias("table"), F.lit(0).cast("long").alias("key"),
                                F.inline(choices))
        else:
            masked = level.join(F.broadcast(spark.createDataFrame(masks, "free bigint, kept bigint, other bigint")), "free")
        rows = masked.select(
            "fp", F.concat_ws("/", "table", F.hex("kept")).alias("table"),
            F.xxhash64("key", F.col("fp").bitwiseAND(F.col("kept"))).alias("key"), F.col("other").alias("free"))
        rows = stage(rows, "blocks")
        keys = ["table", "key"]
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        big = None if depth == 2 else stage(sizes.where(F.col("n") > group).drop("n"), "large")
        small = sizes.where(F.col("n") <= group) if big is not None else sizes
        # the copies of a text meet in many tables: equal groups are compared once
        groups = (rows.join(small.drop("n"), keys).groupBy(*keys)
                  .agg(F.sort_array(F.collect_list("fp")).alias("fps")).select("fps").distinct())
        within = groups.mapInArrow(_forests(distance), "a bigint, b bigint")
        found = within if found is None else found.unionByName(within)
        if big is None or big.isEmpty():
            break
        level = rows.join(big, keys)
    return found.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``links`` (a, b): the
    least node reachable. Alternating large-star and small-star rounds; the
    driver sees two numbers a round."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        if large:
            sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
                edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            sides = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = sides.join(least, "u")
        if large:
            out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def state(edges: DataFrame) -> tuple:
        r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)
    edges = stage(links.where("a <> b"), "links")
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = stage(star(star(edges, True), False), "star")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def near_duplicates(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE,
                    keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys..., fp, component_id) for every row of ``docs``; component_id is the
    least key of the component, a struct when ``keys`` are several."""
    own = stage(fingerprints(docs, width, keys), "fingerprints")
    key = F.col(keys[0]) if len(keys) == 1 else F.struct(*keys)
    distinct = own.groupBy("fp").agg(F.min(key).alias("least"))
    group = components(near_links(distinct.select("fp"), distance))
    labelled = distinct.join(group, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    labelled = stage(labelled, "labelled")
    ids = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = labelled.join(ids, "component").select(F.col("fp").alias("l_fp"), "component_id")
    return own.join(by_fp, F.col("fp") == F.col("l_fp")).select(*keys, "fp", "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the least
    doc_id and, among rows that share it, the least text hash. Unlike texts
    with one doc_id stand for their own components. Rows without doc_id rank
    after all others, by their text hash."""
    tie = F.xxhash64("text")
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(tie, 2))
    row = docs.select(F.struct("*").alias("row"), rank.alias("id"), tie.alias("tie"))
    groups = near_duplicates(docs.select(rank.alias("doc_id"), tie.alias("tie"), "text"), width, distance,
                             ("doc_id", "tie"))
    named = (groups.where(F.struct("doc_id", "tie") == F.col("component_id"))
                   .select(F.col("doc_id").alias("kept_id"), F.col("tie").alias("kept_tie")).distinct())
    # rows equal in both are copies of one text
    first = Window.partitionBy("id", "tie").orderBy("tie")
    kept = (F.col("id") == F.col("kept_id")) & (F.col("tie") == F.col("kept_tie"))
    return (row.join(named, kept, "left_semi")
               .withColumn("nth", F.row_number().over(first)).where("nth = 1").select("row.*"))


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, one row per row of ``documents``."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
