"""Restartable runs, counters, bad rows, natural merges and sketches."""

import os
import tempfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gapscan.operators import quantiles as Q
from gapscan.operators.flags import natural_join
from gapscan.operators.segments import quantiles_disc
from gapscan.sources import runs as R
from gapscan.sources.quarantine import read_split


def _tmp():
    return tempfile.mkdtemp(prefix="gapscan-run-", dir="/tmp")


def _state(spark, path):
    return sorted((r.id, r.p) for r in R.read_run(spark, path).select("id", "p").collect())


def test_failed_run_is_refused_and_started_again(spark):
    path = f"{_tmp()}/table"
    first = spark.range(60).withColumn("p", (F.col("id") % 3).cast("int"))
    broken = first.withColumn("id", F.when(F.col("id") == 41, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        R.write_run(broken, path, ["p"], "one", {"n": F.count(F.lit(1))})
    assert not R.committed(spark, path)
    with pytest.raises(RuntimeError, match="did not finish"):
        R.read_run(spark, path)
    assert R.write_run(first, path, ["p"], "one", {"n": F.count(F.lit(1))}, mode="replace") == {"n": 60}
    assert _state(spark, path) == [(i, i % 3) for i in range(60)]
    # a later run for one partition fails: the rows are refused until it is run again
    with pytest.raises(Exception, match="lost"):
        R.write_run(broken.where("p = 2"), path, ["p"], "two", mode="replace")
    with pytest.raises(RuntimeError):
        R.read_run(spark, path)
    again = spark.range(3).withColumn("p", F.lit(2))
    R.write_run(again, path, ["p"], "two", mode="replace")
    assert _state(spark, path) == sorted([(i, i % 3) for i in range(60) if i % 3 < 2] + [(i, 2) for i in range(3)])


def test_the_default_fails_on_an_existing_path(spark):
    path = f"{_tmp()}/table"
    rows = spark.range(4).withColumn("p", F.lit("a"))
    R.write_run(rows, path, ["p"], "one")
    with pytest.raises(AnalysisException):
        R.write_run(rows, path, ["p"], "two")
    assert _state(spark, path) == [(i, "a") for i in range(4)]
    with pytest.raises(ValueError):
        R.write_run(rows, path, ["p"], "two", mode="append")


def test_counters_are_those_of_the_written_rows(spark):
    path = f"{_tmp()}/table"
    rows = spark.range(100).withColumn("p", F.col("id") % 2)
    counted = R.write_run(rows, path, ["p"], "x", {"n": F.count(F.lit(1)), "big": F.count_if(F.col("id") > 89)})
    assert counted == {"n": 100, "big": 10}
    assert [tuple(r) for r in R.read_counters(spark, path, ["n", "big"]).collect()] == [(100, 10)]


def test_bad_rows_are_set_aside(spark):
    d = _tmp()
    os.mkdir(f"{d}/in")
    with open(f"{d}/in/a.tsv", "w") as f:
        f.write("id\tname\tvalue\n1\ta\t2.5\nx\tb\t1\n2\tc\n3\td\t4\t5\n4\t\t\n\t\t\n5\te\tnan?\n")
    split = read_split(spark, f"{d}/in", "id long, name string, value double")
    # a line of white space alone is no row
    assert [tuple(r) for r in split.good.orderBy("id").collect()] == [(1, "a", 2.5), (4, None, None)]
    assert sorted(r.line for r in split.bad.collect()) == ["2\tc", "3\td\t4\t5", "5\te\tnan?", "x\tb\t1"]
    os.mkdir(f"{d}/none")
    with open(f"{d}/none/a.tsv", "w") as f:
        f.write("id\tname\n")
    split = read_split(spark, f"{d}/none", "id long, name string", out=f"{d}/out")
    assert split.good.count() == 0 and split.bad.count() == 0


def test_natural_join(spark):
    a = spark.createDataFrame([(1, "x", 10), (1, None, 11), (2, "y", 12)], "k int, s string, a int")
    b = spark.createDataFrame([("x", 1, 5), (None, 1, 6), ("z", 3, 7)], "s string, k int, b int")
    rows = lambda how: sorted((tuple(r) for r in natural_join(a, b, how).collect()), key=str)
    both = [(1, "x", 10, 5), (1, None, 11, 6)]
    assert natural_join(a, b).columns == ["k", "s", "a", "b"]
    assert rows("inner") == sorted(both, key=str)
    assert rows("left") == sorted([*both, (2, "y", 12, None)], key=str)
    assert rows("right") == sorted([*both, (3, "z", None, 7)], key=str)
    assert rows("full") == sorted([*both, (2, "y", 12, None), (3, "z", None, 7)], key=str)
    with pytest.raises(ValueError, match="share no"):
        natural_join(a.select("a"), b)
    with pytest.raises(ValueError, match="several columns named k"):
        natural_join(a.select("k", F.col("a").alias("k")), b)


def test_sketches_of_a_hot_key_against_exact_positions(spark):
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}
    hot = spark.range(60_000).select(F.lit(1).alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10 ** 9)) / 7).alias("v"))
    cold = spark.range(4000).select((F.col("id") % 40 + 2).cast("int").alias("k"), F.col("id").cast("double").alias("v"))
    odd = spark.createDataFrame([(1, None), (2, float("nan"))], "k int, v double")
    values = hot.unionByName(cold).unionByName(odd)
    error = 0.002
    approx = {r.k: r for r in Q.approx_quantiles(values, ["k"], "v", probs, error).collect()}
    exact = {r.k: r for r in quantiles_disc(values.where("v is not null and not isnan(v)").distinct(), ["k"], "v", probs).collect()}
    assert {k: r.n for k, r in approx.items()} == {k: r.n for k, r in exact.items()}
    for k in exact:
        if k != 1:
            assert tuple(approx[k]) == tuple(exact[k])         # small keys are kept whole
    ranked = sorted(r.v for r in hot.collect())
    for name, p in probs.items():
        rank = sum(v <= approx[1][name] for v in ranked) / len(ranked)
        assert abs(rank - p) <= 3 * error
    plan = Q.approx_quantiles(values, ["k"], "v", probs)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("ObjectHashAggregate") == 2
    # sketches of parts merge
    parts = Q.quantile_sketches(values.withColumn("day", F.hash("v") % 5), ["k", "day"], "v", error)
    merged = Q.sketch_quantiles(Q.merge_sketches(parts, ["k"]), ["k"], probs)
    assert {r.k: r.n for r in merged.collect()} == {k: r.n for k, r in exact.items()}


def test_positions_of_decimal_shares(spark):
    """0.7 of ten values is the seventh, though 10 * 0.7 is above 7 in doubles."""
    ten = spark.range(1, 11).select(F.lit(0).alias("k"), F.col("id").cast("double").alias("v"))
    got = quantiles_disc(ten, ["k"], "v", {"a": 0.7, "b": 0.1, "c": 0.55, "d": 1.0}).first()
    assert (got.a, got.b, got.c, got.d) == (7.0, 1.0, 6.0, 10.0)


def test_release_is_by_thread_and_time(spark):
    """A release since a mark leaves what was staged before, and by other threads."""
    from concurrent.futures import ThreadPoolExecutor

    from gapscan import staging as S
    S.release(spark)
    early = S.stage(spark.range(3), "early")
    before = S.mark(spark)
    with ThreadPoolExecutor(1) as pool:
        other = pool.submit(S.stage, spark.range(4), "other").result()
    S.stage(spark.range(5), "mine")
    newest = S.stage(spark.range(6), "newest")
    assert S.release(spark, before, keep_last=True) == 1
    assert (early.count(), other.count(), newest.count()) == (3, 4, 6)
    assert S.release(spark, before) == 1 and len(S.staged_paths(spark)) == 2
    assert S.release(spark) == 2 and S.staged_paths(spark) == []
