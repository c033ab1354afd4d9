"""The core operator: goldens, properties, and a differential check."""

import random

import pytest
from brute import gap_flags

from gapscan.operators.gap import gap_outliers, gap_scores

GOLDENS = {
    "a": (list(range(1, 30)) + [100], {29.0: "upper", 100.0: "upper"}),
    "b": ([-100] + list(range(-29, 0)), {-100.0: "lower"}),
    "c": ([-100] + list(range(1, 30)) + [100], {}),
    "d": ([i * i for i in range(20)], {}),
    "e": ([8.7470924, 10.3672866, 8.3287428, 13.1905616, 10.6590156, 8.3590632,
           10.9748582, 11.4766494, 11.1515628, 9.3892232, 1.0], {1.0: "lower"}),
}


def _flags(df, keys=("g",), value="v", **kw):
    rows = gap_outliers(df, list(keys), value, **kw).collect()
    return {(tuple(r[k] for k in keys), r.xx): r.outlier_type for r in rows}


@pytest.mark.parametrize("kw", [{"partitions": 1}, {"partitions": 3}, {"partitions": 7}, {}])
def test_goldens(spark, kw):
    rows = [(k, float(v)) for k, (vs, _) in GOLDENS.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    got = _flags(df, **kw)
    want = {((k,), v): t for k, (_, exp) in GOLDENS.items() for v, t in exp.items()}
    assert got == want


def test_golden_scores(spark):
    df = spark.createDataFrame([("a", float(v)) for v in GOLDENS["a"][0]], "g string, v double")
    s = gap_scores(df, ["g"], "v").collect()
    assert round(s[0].t1, 6) == 5.403364
    assert round(max(r.z for r in s if r.z is not None), 6) == 5.487761
    assert {r.median for r in s} == {15.0}
    top = [r for r in s if r.xx == 100.0][0]
    assert top.x1 is None and top.y is None and top.z is None


def test_size_guard_and_duplicates(spark):
    rows = [("nine", float(v)) for v in range(9)] + [("dups", float(v)) for v in [0, 0, 0, 1, 1, 1]]
    rows += [("ten", float(v)) for v in range(9)] + [("ten", 1000.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    keys = {r.g for r in gap_scores(df, ["g"], "v").collect()}
    assert keys == {"ten"}


def test_zero_deviation_is_not_an_error(spark):
    df = spark.createDataFrame([("k", 0.0), ("k", 1.0), ("k", 2.0)], "g string, v double")
    s = gap_scores(df, ["g"], "v", min_n=3).collect()
    assert len(s) == 3
    assert all(r.z is None and r.outlier_type is None for r in s)


def test_nulls_are_dropped(spark):
    vals = GOLDENS["a"][0]
    rows = [("a", float(v)) for v in vals] + [("a", None), (None, 5.0), (None, None)]
    df = spark.createDataFrame(rows, "g string, v double")
    assert _flags(df) == {(("a",), 29.0): "upper", (("a",), 100.0): "upper"}


def test_invariance(spark):
    """Row order, duplicates and a positive affine change keep the flags."""
    vals = GOLDENS["a"][0]
    base = _flags(spark.createDataFrame([("a", float(v)) for v in vals], "g string, v double"))
    shuffled = vals * 3
    random.Random(1).shuffle(shuffled)
    df2 = spark.createDataFrame([("a", 2.5 * v + 7.0) for v in shuffled], "g string, v double")
    got = _flags(df2, partitions=4)
    assert got == {(k, 2.5 * v + 7.0): t for (k, v), t in base.items()}


def test_even_n_lower_median(spark):
    # 1..10: lower median is 5 (not 5.5)
    df = spark.createDataFrame([("k", float(v)) for v in range(1, 11)], "g string, v double")
    assert {r.median for r in gap_scores(df, ["g"], "v").collect()} == {5.0}


def test_multi_key_and_hot_key_differential(spark):
    """Random groups, one of them holding most rows, split over many segments."""
    rnd = random.Random(7)
    rows = []
    for g in range(40):
        n = rnd.randint(5, 40)
        vals = [round(rnd.gauss(100, 15), 1) for _ in range(n)]
        if rnd.random() < 0.5:
            vals.append(round(rnd.choice([-1, 1]) * rnd.uniform(200, 900), 1))
        rows += [(g % 7, f"s{g % 3}", v) for v in vals]
    hot = [float(v) for v in range(4000)] + [1e6]
    rnd.shuffle(hot)
    rows += [(99, "s0", v) for v in hot]
    df = spark.createDataFrame(rows, "g long, s string, v double")
    got = _flags(df, keys=("g", "s"), partitions=16)
    assert _flags(df, keys=("g", "s"), partitions=1) == got
    want = {}
    groups = {}
    for g, s, v in rows:
        groups.setdefault((g, s), []).append(v)
    for k, vs in groups.items():
        for v, t in (gap_flags(vs) or {}).items():
            want[(k, v)] = t
    assert got == want
    assert any(k == (99, "s0") for k, _ in got)


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([("k", float(v)) for v in range(1, 30)] + [("k", float("nan"))], "g string, v double")
    assert _flags(df) == {}


def test_hot_key_is_split_into_segments(spark):
    from pyspark.sql import functions as F

    from gapscan.operators.segments import tag_segments
    df = spark.range(0, 20000).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("xx"))
    segs = tag_segments(df, ["g"], ["xx"], partitions=8).select("_seg").distinct().count()
    assert segs == 8


def test_upper_and_lower_disjoint_and_subset(spark):
    rnd = random.Random(3)
    rows = [(g, float(rnd.randint(-50, 50) * (1 + (g == 2) * 9))) for g in range(5) for _ in range(60)]
    df = spark.createDataFrame(rows, "g long, v double")
    s = gap_scores(df, ["g"], "v").collect()
    values = {(g, float(v)) for g, v in rows}
    for r in s:
        assert (r.g, r.xx) in values
    flagged = [(r.g, r.xx, r.outlier_type) for r in s if r.outlier_type]
    assert len({(g, x) for g, x, _ in flagged}) == len(flagged)
