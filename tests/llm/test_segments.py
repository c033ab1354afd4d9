"""Document order cut into segments: many starts, equal ids, files in order."""

import bisect
import glob
import random
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gapscan.llm import fingerprints, token_files, tokens
from gapscan.llm.common import LAST, Segments, order_key, segment_starts


@pytest.mark.parametrize("n", [0, 1, 2, 3, 1000, 80_000])
def test_many_starts_plan_in_seconds(spark, n):
    rnd = random.Random(n)
    starts = sorted({(rnd.randrange(-n, n), rnd.randrange(-2 ** 63, 2 ** 63)) for _ in range(n)} | {(-n - 1, -2 ** 63)}) if n else []
    keys = [(rnd.randrange(-n - 1, n + 1), rnd.randrange(-2 ** 63, 2 ** 63)) for _ in range(300)] + starts[:200]
    cut = Segments(starts)
    t = time.perf_counter()
    rows = spark.createDataFrame(keys, "a long, b long").select(
        "a", "b", cut.of(F.col("a"), F.col("b")).alias("s")).withColumn("is", cut.start_is(F.col("s"), F.col("a"), F.col("b"))).collect()
    took = time.perf_counter() - t
    for r in rows:
        assert r["s"] == max(bisect.bisect_right(starts, (r["a"], r["b"])) - 1, 0)
        assert bool(r["is"]) == ((r["a"], r["b"]) in set(starts))
    assert took < 15


def test_equal_and_missing_ids_are_spread(spark):
    docs = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 4 == 1, F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("text "), F.col("id")).alias("text"))
    keyed = docs.select(order_key(F.col("doc_id")).alias("place"), F.xxhash64("text").alias("tie"))
    starts = segment_starts(keyed, "place", "tie", 16)
    cut = Segments(starts)
    sizes = {r["s"]: r["count"] for r in keyed.select(cut.of(F.col("place"), F.col("tie")).alias("s")).groupBy("s").count().collect()}
    assert len(sizes) == 16 and max(sizes.values()) < 3 * 4000 / 16
    assert sum(a == 7 for a, _ in starts) > 4 and sum(a == LAST for a, _ in starts) > 2


def test_next_document_over_segments(spark):
    """Every document stands beside the next one, wherever the order is cut."""
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 5, rnd.randrange(100)]), f"text {i}" if i % 9 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = fingerprints.beside_next(docs, pieces=23).where("not sentinel").select("doc_id", "text", "next_text").collect()
    ties = {r["text"]: r["tie"] for r in docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "tie", F.xxhash64("text")).distinct().collect()}
    order = sorted(((LAST if d is None else d, ties[t or ""], t or "", d) for d, t in rows), key=lambda x: x[:3])
    want = sorted(((str(d), t, n[2]) for (_, _, t, d), n in zip(order, order[1:] + order[:1])))
    assert sorted((str(r["doc_id"]), r["text"], r["next_text"]) for r in got) == want


def test_files_are_in_document_order(spark, tmp_path):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 != 0, 3000 - F.col("id")).otherwise(50).alias("doc_id"),
                                    F.lit("a few words of text").alias("text")).repartition(5)
    path = str(tmp_path / "files")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        token_files.write_token_files(docs, path, tokens.default_tokenizer(), pieces=12)
    finally:
        spark.conf.unset(coalesce)
    files = sorted(glob.glob(f"{path}/blocks/segment=*/part-*.parquet"))
    assert len(files) > 1
    ids, starts = [], []
    for f in files:
        table = pq.read_table(f, partitioning=None).to_pydict()
        starts += table["start"]
        ids += [i for block in table["doc_id"] for i in block]
    assert starts == sorted(starts) and len(ids) == 3000 and ids == sorted(ids)
    # the documents with the same id lie in several segments
    segments = [f for f in files if any(50 in block for block in pq.read_table(f, partitioning=None).to_pydict()["doc_id"])]
    assert len(segments) > 1
    from tokenizers import Tokenizer
    want = Tokenizer.from_file(tokens.default_tokenizer()).encode("a few words of text", add_special_tokens=False).ids + [2]
    back = token_files.read_token_files(spark, path).collect()
    assert len(back) == 3000 and all(list(r["ids"]) == want for r in back)
