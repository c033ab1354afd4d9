"""Token-id files: canonical length-limited Huffman blocks in document order.

Format. A dataset is a folder with two Parquet tables.
``codebook``: (id int, length int), one row for each id in use; the lengths
define the canonical code. ``blocks``: one row per block, in ascending document
order, in folders by segment: block int (in the segment), start long (ids of
all documents before the block), doc_id array<long>, n_tokens array<long>,
checkpoints array<long> (bit offset of every 256th id), payload binary. Every
block decodes by itself.

Writing. Texts move once, range-partitioned by document order into segments,
are tokenized there in order and staged in blocks. Counts are summed by id (at
most one row per id of the vocabulary reaches the driver, which builds the
code), then every staged block is encoded where it lies and written to the
folder of its segment. Folders in name order are in document order, and so are
the blocks of each (a staged file of several row groups may give its folder
several files, which ``block`` orders). Spark's writers commit the files, so a
lost executor costs its own tasks.

Defined cases: a null text has only the end id; rows with equal doc_id keep
the order of a hash of their text (many of them, or many equal rows, are spread
over segments), rows without doc_id come last; an empty
table gives an empty codebook and no blocks; a text longer than a block gets
a block of its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapscan.llm import huffman
from gapscan.llm.common import documents
from gapscan.llm.tokens import default_tokenizer, encoder, groups_by_bytes
from gapscan.staging import stage, staging_path

END_ID = 2
BLOCK_IDS = 1 << 16
BLOCK = ("segment int, block int, before bigint, doc_id array<bigint>, n_tokens array<bigint>, ids binary")
FILE = ("segment int, block int, before bigint, doc_id array<bigint>, n_tokens array<bigint>, "
        "checkpoints array<bigint>, payload binary")
# What is read of a written block.
BLOCKS = ("start bigint, doc_id array<bigint>, n_tokens array<bigint>, checkpoints array<bigint>, payload binary")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _tokenize(path: str, end_id: int):
    """Arrow task: documents in segment order -> blocks of ids (zstd)."""
    names = ["segment", "block", "before", "doc_id", "n_tokens", "ids"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def run(batches):
        enc, packer = encoder(path), zstandard.ZstdCompressor(level=1)
        seg, block, before, docs, sizes, parts, held = None, 0, 0, [], [], [], 0

        def closed():
            ids = np.concatenate(parts).astype("<u4" if max(p.max() for p in parts) >= 1 << 16 else "<u2")
            # the first byte tells the width
            return _batch([(seg, block, before, docs, sizes,
                            bytes([ids.itemsize]) + packer.compress(ids.tobytes()))], names, types)
        for b in batches:
            segments, doc_ids, texts = (b.column(i).to_pylist() for i in range(3))
            for lo, hi in groups_by_bytes(texts):
                ids, at = enc.encode([t or "" for t in texts[lo:hi]])
                for i in range(lo, hi):
                    if docs and (segments[i] != seg or held >= BLOCK_IDS):
                        yield closed()
                        block, before = block + 1, before + held
                        docs, sizes, parts, held = [], [], [], 0
                    if segments[i] != seg:
                        seg, block, before = segments[i], 0, 0
                    own = np.append(ids[at[i - lo]:at[i - lo + 1]], np.uint32(end_id))
                    docs.append(doc_ids[i])
                    sizes.append(len(own))
                    parts.append(own)
                    held += len(own)
        if docs:
            yield closed()
    return run


def _unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), f"<u{blob[0]}").astype(np.uint32)


def _count(batches):
    total = np.zeros(0, dtype=np.int64)
    for b in batches:
        for blob in b.column(0).to_pylist():
            n = np.bincount(_unpack(blob))
            if len(n) > len(total):
                n, total = total, n
            total[:len(n)] += n
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["id", "n"])


def _encode(shared):
    def run(batches):
        lengths = shared.value
        codes = huffman.canonical_codes(lengths)
        for b in batches:
            rows = []
            for *key, blob in zip(*(b.column(i).to_pylist() for i in range(6))):
                payload, marks = huffman.encode(_unpack(blob), codes, lengths)
                rows.append((*key, marks, payload))
            if rows:
                yield _batch(rows, [f.split()[0] for f in FILE.split(", ")],
                             [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                              pa.list_(pa.int64()), pa.binary()])
    return run


def codebook(counts: DataFrame) -> np.ndarray:
    """Code lengths by id from (id, n): at most one row per id of the vocabulary."""
    rows = counts.groupBy("id").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(max((r["id"] for r in rows), default=-1) + 1, dtype=np.int64)
    for r in rows:
        n[r["id"]] = r["n"]
    return huffman.code_lengths(n)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                      pieces: int | None = None) -> None:
    """Write the ids of all texts as a dataset at ``path`` (which must not exist)."""
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie").asc(), F.col("uid").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"),
                       F.monotonically_increasing_id().alias("uid"))
    ordered = ((rows.repartitionByRange(pieces, *order) if pieces else rows.repartitionByRange(*order))
               .sortWithinPartitions(*order)
               .select(F.spark_partition_id().alias("segment"), "doc_id", "text"))
    blocks = stage(ordered.mapInArrow(_tokenize(tokenizer, end_id), BLOCK), "ids")
    lengths = codebook(blocks.select("ids").mapInArrow(_count, "id int, n bigint"))
    used = [(int(i), int(n)) for i, n in enumerate(lengths) if n]
    spark.createDataFrame(used, "id int, length int").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast(lengths)  # one byte per id of the vocabulary
    coded = blocks.mapInArrow(_encode(shared), FILE)
    # ids of all segments before each: a table of as many rows as there are segments
    sizes = (blocks.select("segment", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
             .groupBy("segment").agg(F.sum("n").alias("n")))
    before = F.sum("n").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("segment", F.coalesce(before, F.lit(0)).alias("first"))
    # the staged blocks are read in any order; folders are named in that of the documents
    (coded.join(F.broadcast(first), "segment")
          .select(F.format_string("%06d", "segment").alias("segment"), "block",
                  (F.col("before") + F.col("first")).alias("start"), "doc_id", "n_tokens", "checkpoints", "payload")
          .sortWithinPartitions("segment", "block").write.partitionBy("segment").parquet(f"{path}/blocks"))


def _decode(shared):
    names = ["doc_id", "start", "n_tokens", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]

    def run(batches, digest):
        table = huffman.decode_table(shared.value)
        for b in batches:
            for start, docs, sizes, marks, payload in zip(*(b.column(i).to_pylist() for i in range(5))):
                ids = huffman.decode(payload, np.array(marks, dtype=np.int64), sum(sizes), table)
                at = np.concatenate([[0], np.cumsum(sizes)])
                raw = ids.astype("<u4").tobytes()
                if digest:
                    last = [zlib.crc32(memoryview(raw)[4 * a:4 * z]) for a, z in zip(at, at[1:])]
                else:
                    last = [ids[a:z].astype(np.int64) for a, z in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, types[0]), pa.array(start + at[:-1], types[1]), pa.array(sizes, types[2]),
                     pa.array(last, pa.int64() if digest else types[3])], [*names[:3], "ids_crc32" if digest else "ids"])
    return run


def read_token_files(spark, path: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in a dataset, or with
    ``digest`` the CRC-32 of its ids (little-endian 32-bit) instead of the ids."""
    rows = spark.read.parquet(f"{path}/codebook").collect()  # at most the vocabulary
    lengths = np.zeros(max((r["id"] for r in rows), default=-1) + 1, dtype=np.uint8)
    for r in rows:
        lengths[r["id"]] = r["length"]
    shared = spark.sparkContext.broadcast(lengths)
    run = _decode(shared)
    # with its schema, as an empty table has no file
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    last = "ids_crc32 bigint" if digest else "ids array<bigint>"
    return blocks.mapInArrow(lambda it: run(it, digest), f"doc_id bigint, start bigint, n_tokens bigint, {last}")


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    """Write all documents as token files, read them back: one row per row of ``documents``."""
    path = staging_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), path, default_tokenizer())
    return read_token_files(spark, path, digest=True)
