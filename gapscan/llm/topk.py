"""Exact top-k search by inner product: Fagin's threshold algorithm over sorted lists.

Components are quantised to integers (``floor(SCALE * x)``), so scores are
exact. Candidates stay where they are: every task cuts its rows into blocks of
``BLOCK`` and sorts a list of the rows for each dimension of a block. A query
reads the lists of its dimensions from the end that its sign prefers, all to
the same depth, and looks up the whole vector of each row it meets (random
access). No unseen row of the block can score more than the *bound*, the score
of a vector made of the values where the lists stand. A query stops once its
bound is below its kth best score so far, which a task carries from block to
block; a row that ties with the kth may still win by its id, so an equal bound
goes on. Depths grow by ``GROWTH`` and a block of queries moves together, so
that list access, look-up and bounds are matrix products. On vectors without
structure the lists are read deeply before the bound falls; the worst case is
one look-up of every row, never more.

Queries come in blocks of at most ``QUERIES`` rows, one pass over the candidates
for each: a block is all that is broadcast, whatever the number of queries.
Tasks give at most k rows a query, and a window keeps the best k of those.

Exactness: products are added in 32-bit floats while no sum can reach 2^24,
in 64-bit floats up to 2^53, else as Python integers (scores are cut to 64 bits,
and tie there).

Defined cases: vectors that are null or hold null or non-finite components take
no part; an empty vector scores 0; shorter vectors count as filled up with
zeros; a row without an id is a candidate (after all ids among ties) and no
query; rows with equal ids or vectors are rows of their own, each a candidate
for the others; an empty table, or none but the query, gives no rows. Only the
id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapscan.staging import stage

K = 5
SCALE = 256
EVERY = 50
BLOCK = 4096        # candidates whose lists are sorted together
BATCH = 256         # queries that read the lists together
QUERIES = 16_384    # queries of one pass, the broadcast block
DEPTH, GROWTH = 64, 4
NO_ID = np.iinfo(np.int64).max

FOUND = "query bigint, query_id bigint, uid bigint, vec_id bigint, score bigint"


def quantised(table: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """Staged (uid, vec_id, v): the vectors that take part, as integers."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    ints = F.transform(x, lambda c: F.floor(F.lit(scale).cast("double") * c.cast("double")))
    rows = table.where(x.isNotNull() & finite).select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))
    # staged at once, so a row keeps its uid
    return stage(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")


def _matrix(column: pa.Array, dims: int, dtype) -> np.ndarray:
    """A list column as rows of ``dims`` numbers, shorter ones filled with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out.astype(object) if dtype is object else out.astype(dtype)


def _exact_type(largest: int, dims: int):
    total = largest * largest * max(dims, 1)
    return np.float32 if total < 2 ** 24 else np.float64 if total < 2 ** 53 else object


class Best:
    """The best k (score, id) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.n = k, queries
        self.query, self.score, self.ids, self.uid = (np.zeros(0, dtype=np.int64) for _ in range(4))

    def kth(self, dtype) -> np.ndarray:
        """Score of the kth row of each query; -inf where there are fewer."""
        out = np.full(self.n, -np.inf, dtype=object if dtype is object else np.float64)
        place = np.arange(len(self.query)) - np.searchsorted(self.query, self.query)
        last = place == self.k - 1
        out[self.query[last]] = self.score[last]
        return out

    def add(self, query, score, ids, uid) -> None:
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, score])
        ids, uid = np.concatenate([self.ids, ids]), np.concatenate([self.uid, uid])
        order = np.lexsort((uid, ids, -score, query))
        query = query[order]
        keep = np.arange(len(query)) - np.searchsorted(query, query) < self.k
        order = order[keep]
        self.query, self.score, self.ids, self.uid = query[keep], score[order], ids[order], uid[order]


def _clip(scores: np.ndarray) -> np.ndarray:
    """Integer scores cut to 64 bits; sums in floats are below that."""
    return np.clip(scores, -2 ** 63 + 1, 2 ** 63 - 1) if scores.dtype == object else scores


def threshold_search(rows: np.ndarray, uids: np.ndarray, queries: np.ndarray, query_uids: np.ndarray,
                     kth: np.ndarray, k: int):
    """(query, row, score) of a block's rows that may be among the best k, by the
    threshold algorithm; ``kth`` holds scores that k rows met before reach."""
    n, none = len(rows), -np.inf
    order = np.argsort(rows, axis=0, kind="stable")
    lists = np.take_along_axis(rows, order, axis=0)            # ascending, a column a dimension
    from_low = np.empty_like(order)
    np.put_along_axis(from_low, order, np.arange(n)[:, None], axis=0)
    mask = np.float32
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    likes_high, likes_low = (up > 0).astype(mask), (down < 0).astype(mask)
    own_at = np.minimum(np.searchsorted(uids, query_uids), n - 1)
    own = uids[own_at] == query_uids

    scores = np.full((len(queries), n), none, dtype=object if rows.dtype == object else rows.dtype)
    looked_up = np.zeros(n, dtype=bool)
    active, kth, out, depth = np.arange(len(queries)), kth.copy(), [], 0
    while len(active):
        # no unseen row scores more than a vector of the lists' present values
        high, low = (lists[n - max(depth, 1)], lists[max(depth, 1) - 1])
        bound = _clip(up[active] @ high + down[active] @ low)
        if depth:
            if depth < n:
                met = (likes_high[active] @ (from_low >= n - depth).astype(mask).T
                       + likes_low[active] @ (from_low < depth).astype(mask).T) > 0
            else:
                met = np.ones((len(active), n), dtype=bool)
            new = met.any(axis=0) & ~looked_up
            if new.any():
                scores[:, new] = _clip(queries @ rows[new].T)
                looked_up |= new
            seen = np.where(met, scores[active], none)
            mine = own[active]
            seen[np.flatnonzero(mine), own_at[active][mine]] = none
            if n >= k:
                kth[active] = np.maximum(kth[active], np.partition(seen, n - k, axis=1)[:, n - k])
            done = (bound < kth[active]) | met.all(axis=1)
            at, row = np.nonzero((seen >= kth[active][:, None]) & (seen > none) & done[:, None])
            out.append((active[at], row, seen[at, row]))
        else:
            done = bound < kth[active]
        active = active[~done]
        depth = min(depth * GROWTH if depth else DEPTH, n)
    if not out:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*out))


def _search(block, dims: int, largest: int, k: int):
    """Arrow task: (uid, vec_id, v) -> the best k rows of the task for each query of the broadcast block."""
    def run(batches):
        query_uids, query_ids, raw = block.value
        dtype = _exact_type(largest, dims)
        queries = raw.astype(object) if dtype is object else raw.astype(dtype)
        cuts = range(0, len(queries), BATCH)
        best = [Best(len(queries[c:c + BATCH]), k) for c in cuts]

        def search(uids, ids, rows):
            by_uid = np.argsort(uids)
            uids, ids, rows = uids[by_uid], ids[by_uid], rows[by_uid]
            for c, b in zip(cuts, best):
                query, row, score = threshold_search(rows, uids, queries[c:c + BATCH], query_uids[c:c + BATCH],
                                                     b.kth(dtype), k)
                b.add(query, score.astype(np.int64), ids[row], uids[row])

        held: list = []
        for batch in batches:
            ids = batch.column(1).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            held.append((batch.column(0).to_numpy(zero_copy_only=False), ids, _matrix(batch.column(2), dims, dtype)))
            if sum(len(h[0]) for h in held) >= BLOCK:
                uids, ids, rows = (np.concatenate(x) for x in zip(*held))
                whole = len(uids) // BLOCK * BLOCK
                for a in range(0, whole, BLOCK):
                    search(uids[a:a + BLOCK], ids[a:a + BLOCK], rows[a:a + BLOCK])
                held = [(uids[whole:], ids[whole:], rows[whole:])] if whole < len(uids) else []
        if held:
            search(*(np.concatenate(x) for x in zip(*held)))
        for c, b in zip(cuts, best):
            at = b.query + c
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_uids[at]), pa.array(query_ids[at]), pa.array(b.uid),
                 pa.array(b.ids, pa.int64(), mask=b.ids == NO_ID), pa.array(b.score)],
                [f.split()[0] for f in FOUND.split(", ")])
    return run


def _packed(batches):
    """Arrow task: (uid, vec_id, v) -> the same rows, a batch packed into one row."""
    for b in batches:
        if len(b):
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.column(0).to_pylist()], pa.list_(pa.int64())),
                 pa.array([b.column(1).to_pylist()], pa.list_(pa.int64())),
                 pa.array([b.column(2).to_pylist()], pa.list_(pa.list_(pa.int64())))], ["uid", "vec_id", "v"])


def _blocks(queries: DataFrame, dims: int, limit: int):
    """The queries in blocks of at most ``limit`` rows: (uids, ids, matrix); one block at a time is held."""
    packed = queries.select("uid", "vec_id", "v").mapInArrow(
        _packed, "uid array<bigint>, vec_id array<bigint>, v array<array<bigint>>")
    held: list[tuple] = []

    def block(part):
        return (np.array([r[0] for r in part]), np.array([r[1] for r in part]),
                _matrix(pa.array([r[2] for r in part], pa.list_(pa.int64())), dims, np.int64))
    for row in packed.toLocalIterator():
        held += zip(row["uid"], row["vec_id"], row["v"])
        while len(held) >= limit:
            yield block(held[:limit])
            held = held[limit:]
    if held:
        yield block(held)


def top_k(table: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
          scale: int = SCALE, queries_a_pass: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``table`` that satisfies
    ``is_query`` (a condition on vec_id) the k best other rows."""
    spark = table.sparkSession
    vectors = quantised(table, id_col, vector_col, scale)
    size = vectors.agg(F.max(F.size("v")).alias("dims"), F.max(F.array_max(F.transform("v", F.abs))).alias("largest")).first()
    dims, largest = size["dims"] or 0, size["largest"] or 0
    dealt = vectors.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "uid").select("uid", "vec_id", "v")
    parts = []
    for block in _blocks(vectors.where(F.col("vec_id").isNotNull() & is_query), dims, queries_a_pass):
        shared = spark.sparkContext.broadcast(block)
        parts.append(stage(dealt.mapInArrow(_search(shared, dims, largest, k), FOUND), "found"))
        shared.destroy()
    if not parts:
        parts = [spark.createDataFrame([], FOUND)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "uid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op12_topk(spark, sf_dir: str) -> DataFrame:
    """The best five rows of all ``embeddings`` for every 50th vector."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


TAKES_PART = """v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)"""

OP12_SQL = f"""WITH {TAKES_PART},
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}"""
