"""Best-fit packing of token pieces into fixed-length sequences, in rounds.

A document is its ids and an end id; a longer one is cut into pieces of the
sequence length, its first piece being the shorter one. Full pieces are
sequences already. The others are dealt evenly over partitions by a hash of
their row, and each partition packs its own by best fit (largest first, into
the fullest bin with room). Nearly full bins are final. The underfull bins of a
partition go on as items: partitions merge ``FAN`` by ``FAN`` in a tree and
pack again by best fit until one is left.

Which bins go on. In a best-fit packing no two bins fit together, so at most one
of a partition is half empty or emptier. Bins over half full never fit each
other: a round of ``FAN`` partitions can only place their ``FAN`` small bins, and
so fills at most ``FAN`` of the others. Bins of equal fill are alike. So of each
fill ``FAN`` bins for every round still to come are carried, and the rest,
which no later round could use, are final: the result is that of carrying
all. A task holds at most ``PIECES`` pieces, or ``FAN`` times as many bins as
there are fills times bins carried of each, whatever the table's size.

Defined cases: a null text is one piece with the end id alone; rows repeated
or with equal doc_id are packed as documents of their own; an empty table
gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapscan.llm.common import documents
from gapscan.llm.tokens import default_tokenizer, encoder, groups_by_bytes
from gapscan.staging import stage

LENGTH = 2048
END_ID = 0
PIECES = 8192        # pieces packed together in the first round
FAN = 16             # partitions merged in a later round
NEARLY_FULL = 0.98

PIECE = "uid bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(path: str, length: int, end_id: int):
    """Arrow task: (doc_id, text) -> pieces. ``uid`` numbers the pieces of the
    task; it is made unique with the task's partition in the caller."""
    names = [f.split()[0] for f in PIECE.split(", ")]

    def run(batches):
        enc, uid = encoder(path), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for b in batches:
            doc_ids, texts = (b.column(i).to_pylist() for i in range(2))
            for lo, hi in groups_by_bytes(texts):
                ids, at = enc.encode([t or "" for t in texts[lo:hi]])
                raw = memoryview(ids.astype("<u4").tobytes())
                rows = []
                for i in range(lo, hi):
                    a, z = 4 * int(at[i - lo]), 4 * int(at[i - lo + 1])
                    n = (z - a) // 4 + 1
                    start, size = 0, (n - 1) % length + 1
                    for piece in range(-(-n // length)):
                        crc = zlib.crc32(raw[a + 4 * start:min(a + 4 * (start + size), z)])
                        if start + size == n:
                            crc = zlib.crc32(end, crc)
                        rows.append((uid, doc_ids[i], piece, start, size, crc))
                        uid += 1
                        start, size = start + size, length
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if n == "piece" else pa.int64()) for n, c in zip(names, zip(*rows))], names)
    return run


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One staged row per piece: uid, doc_id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_cut(tokenizer, length, end_id), PIECE)
    # the table is staged at once, so a uid is given once and for all
    uid = F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("uid")
    return stage(rows.withColumn("uid", uid), "pieces")


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset) of each item in the given order, and the fill of each bin."""
    bins, offsets, fill = [], [], []
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set when a bin has room r
    for size in sizes:
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, at = capacity, len(fill)
            fill.append(0)
        bins.append(at)
        offsets.append(fill[at])
        fill[at] += size
        if room > size:
            with_room[room - size].append(at)
            rooms |= 1 << (room - size)
    return bins, offsets, fill


def _pack(capacity: int, of_each_fill: int | None, nearly_full: float):
    """Grouped task: the items of a part -> their bins. ``of_each_fill``: how many
    underfull bins of the same fill go on (None: all)."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "uid"], ascending=[False, True], kind="stable")
        bins, offsets, fill = best_fit(group["length"].tolist(), capacity)
        first = group["uid"].to_numpy()[np.unique(bins, return_index=True)[1]]  # a bin is named by its first item
        bins, fill = np.array(bins), np.array(fill)
        by_fill = np.argsort(fill, kind="stable")
        place = np.arange(len(fill)) - np.searchsorted(fill[by_fill], fill[by_fill])
        goes_on = np.zeros(len(fill), dtype=bool)
        goes_on[by_fill] = place < (len(fill) if of_each_fill is None else of_each_fill)
        goes_on &= fill < nearly_full * capacity
        return pd.DataFrame({"part": group["part"].to_numpy(), "uid": group["uid"].to_numpy(), "bin": first[bins],
                             "place": offsets, "fill": fill[bins], "goes_on": goes_on[bins]})
    return run


PACKED = "part bigint, uid bigint, bin bigint, place bigint, fill bigint, goes_on boolean"


def pack(items: DataFrame, capacity: int = LENGTH, pieces_a_part: int | None = None,
         fan: int | None = None, carry_all: bool = False) -> DataFrame:
    """(uid, sequence_id, offset) for items (uid, length), uid unique, length 1 to
    ``capacity``. ``carry_all`` carries every underfull bin to the end, for comparison."""
    size, fan = F.col("length"), fan or FAN
    alone = items.where(size == capacity).select("uid", F.col("uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.where(size < capacity).select("uid", size.cast("long").alias("length"))
    parts = max(1, -(-rest.count() // (pieces_a_part or PIECES)))
    to_come = 0      # rounds after the first
    while fan ** to_come < parts:
        to_come += 1
    level = rest.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("long"))
    rounds = []
    while True:
        carried = None if carry_all and to_come else fan * to_come
        packed = stage(level.groupBy("part").applyInPandas(_pack(capacity, carried, NEARLY_FULL), PACKED), "round")
        rounds.append(packed)
        if not to_come:
            break
        to_come -= 1
        level = (packed.where("goes_on").select("bin", "fill", "part").distinct()
                 .select(F.col("bin").alias("uid"), F.col("fill").alias("length"),
                         F.expr(f"part div {fan}").alias("part")))
    # from the last round down: where each bin of the round before lies
    final = rounds[-1].select("uid", F.col("bin").alias("sequence_id"), F.col("place").alias("offset"))
    for r in reversed(rounds[:-1]):
        up = final.select(F.col("uid").alias("up"), F.col("sequence_id").alias("up_id"), F.col("offset").alias("up_at"))
        final = r.join(up, (F.col("bin") == F.col("up")) & F.col("goes_on"), "left").select(
            "uid", F.coalesce("up_id", "bin").alias("sequence_id"),
            (F.coalesce("up_at", F.lit(0)) + F.col("place")).alias("offset"))
    return alone.unionByName(final)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH,
                   end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of ``docs``."""
    cut = pieces(docs, tokenizer or default_tokenizer(), length, end_id)
    return cut.join(pack(cut, length), "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_pack(spark, sf_dir: str) -> DataFrame:
    """Pieces of all ``documents`` with their sequence and place."""
    return pack_documents(documents(spark, sf_dir))
