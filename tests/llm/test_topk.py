"""Threshold search against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapscan.llm import topk as T


def brute(rows, every, k=5):
    """rows (vec_id, vector) -> sorted (query_id, rank, vec_id, score)."""
    kept = [(i, [math.floor(256.0 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(kept):
        if i is None or i % every:
            continue
        cut = lambda s: max(min(s, 2 ** 63 - 1), -2 ** 63 + 1)
        scored = [(-cut(sum(x * y for x, y in zip(q, v))), j is None, j or 0) for b, (j, v) in enumerate(kept) if b != a]
        for rank, (score, none, j) in enumerate(sorted(scored)[:k], 1):
            out.append((i, rank, None if none else j, -score))
    return sorted(out, key=str)


def found(spark, rows, every, **kw):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table = table.withColumns({"uid": F.lit(0), "v": F.lit("v"), "score": F.lit(9), "rank": F.lit("r")})
    return sorted((tuple(r) for r in T.top_k(table, F.col("vec_id") % every == 0, **kw).collect()), key=str)


def test_edges(spark):
    rnd = random.Random(3)
    f = lambda x: float(np.float32(x))
    rows = [(i, [f(rnd.gauss(0, 0.2)) for _ in range(6)]) for i in range(120)]
    rows += [(200 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]           # ties
    rows += rows[:25]                                                                # repeated rows
    rows += [(400, None), (405, []), (410, [0.5]), (415, [1.0, None, 1.0]), (420, [float("nan")] * 6),
             (425, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (430, [0.0] * 6), (435, [f(3.5)] * 6),
             (None, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0]), (None, [f(9)] * 6), (-5, [f(-0.4)] * 6)]
    assert found(spark, rows, 5) == brute(rows, 5)


@pytest.mark.parametrize("large", [40.0, 3e5, 3e6, 2e13])
def test_large_components_stay_exact(spark, large):
    """32-bit floats, 64-bit floats and integers as sums grow."""
    rnd = random.Random(4)
    rows = [(i, [float(np.float32(rnd.uniform(-large, large))) for _ in range(3)]) for i in range(40)]
    assert found(spark, rows, 4, k=3) == brute(rows, 4, k=3)


def test_blocks_passes_and_few_rows(spark, monkeypatch):
    """Several passes of queries, and fewer rows than k."""
    rnd = random.Random(5)
    rows = [(i, [float(np.float32(rnd.gauss(0, 1))) for _ in range(4)]) for i in range(300)]
    assert found(spark, rows, 3, queries_a_pass=30) == brute(rows, 3)
    assert found(spark, rows[:3], 1) == brute(rows[:3], 1)
    assert found(spark, rows[:1], 1) == [] and found(spark, [(0, None)], 1) == []


def test_search_stops_early_on_clustered_rows():
    """Where the lists separate the best rows, few rows are looked up."""
    rnd = np.random.default_rng(0)
    rows = rnd.integers(-5, 5, (4000, 8)).astype(np.float32)
    rows[:20] += 400
    queries = np.full((3, 8), 100, dtype=np.float32)
    looked = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.dtype == bool:
                looked.append(int(key.sum()))
            return super().__getitem__(key)
    uids = np.arange(4000)
    query, row, score = T.threshold_search(rows.view(Watched), uids, queries, np.full(3, -1), np.full(3, -np.inf), 5)
    assert set(row) <= set(range(20)) and sum(looked) < 800
    best = sorted((rows @ queries[0]).tolist(), reverse=True)[:5]
    assert sorted(score[query == 0].tolist(), reverse=True)[:5] == best


def test_blocks_agree_with_one_list():
    rnd = np.random.default_rng(1)
    rows = rnd.integers(-30, 30, (1000, 5)).astype(np.float32)
    queries = rows[::50].copy()
    expected = [sorted(((-int(s), j) for j, s in enumerate(rows @ q) if j != 50 * i))[:5] for i, q in enumerate(queries)]
    best = T.Best(len(queries), 5)
    for a in range(0, 1000, 130):
        uids = np.arange(a, min(a + 130, 1000))
        query, row, score = T.threshold_search(rows[uids], uids, queries, np.arange(0, 1000, 50), best.kth(np.float32), 5)
        best.add(query, score.astype(np.int64), uids[row], uids[row])
    got = [list(zip((-best.score[best.query == i]).tolist(), best.ids[best.query == i].tolist())) for i in range(len(queries))]
    assert got == expected


def test_whole_table_against_sql(spark):
    import duckdb
    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/embeddings.parquet')")
    expected = sorted(con.execute(T.OP12_SQL).fetchall())
    assert sorted(tuple(r) for r in T.op12_topk(spark, path).collect()) == expected
