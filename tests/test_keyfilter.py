"""The Bloom filter of join keys: nothing lost, little let through, applied before the shuffle."""

from paths import SF001
from pyspark.sql import functions as F

from gapscan.operators import flags as FL
from gapscan.operators import keyfilter as KF


def test_no_key_is_lost_and_few_others_pass(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 1000 != 0, F.col("id")).alias("a"), (F.col("id") % 97).cast("int").alias("b"), "id")
    keys = rows.where("id % 400 = 0").select("a", "b")
    bits = KF.filter_bits(keys.count())
    passed = KF.passing(rows, KF.key_filter(keys, ["a", "b"], bits), ["a", "b"], bits)
    assert passed.columns == rows.columns
    assert passed.where("id % 400 = 0").count() == 500
    assert passed.count() < 500 + 0.06 * 200_000
    joined = FL.join_few(rows, keys, ["a", "b"])
    assert joined.count() == rows.join(keys, ["a", "b"]).count()


def test_size_is_bounded():
    assert KF.filter_bits(0) == KF.PIECE == KF.filter_bits(1000)
    assert KF.filter_bits(1100) == 2 * KF.PIECE
    assert KF.filter_bits(10 ** 15) == KF.MOST_BITS


def test_unlike_key_types_and_floats(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, float("nan")), (4, 1.5), (5, None)], "k int, x double")
    assert FL.semi_filter(rows, spark.createDataFrame([(2,), (9,)], "k long"), "k").count() == 1
    found = FL.semi_filter(rows, spark.createDataFrame([(0.0,), (float("nan"),), (None,)], "x double"), "x")
    assert sorted(r.k for r in found.collect()) == [1, 2, 3]
    assert FL.semi_filter(rows, rows.limit(0), "k").count() == 0


def test_filter_is_below_the_records_exchange(spark):
    """With broadcast joins off, the export's records meet the filter before their shuffle."""
    from gapscan.plans import catalog as C
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query in (C.export_wide, C.q_semi_filter):
            plan = query(spark, SF001)._jdf.queryExecution().executedPlan().toString()
            join = plan.index("SortMergeJoin")
            side = plan[join:]
            exchange, bits = side.index("Exchange hashpartitioning"), side.index("getbit")
            scan = side.index("FileScan parquet [o_orderkey")
            assert exchange < bits < scan          # a node's inputs stand below it
            assert "BroadcastHashJoin" in side[exchange:scan]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shuffle_follows_the_flagged_rows(spark):
    """Rows that reach the exchange: the flagged ones and a few more, not all."""
    wide = spark.range(100_000).select("id", *[F.concat(F.lit(f"text {i} "), F.col("id")).alias(f"c{i}") for i in range(5)])
    few = wide.where("id % 1000 = 7").select("id")
    bits = KF.filter_bits(few.count())
    passed = KF.passing(wide, KF.key_filter(few, ["id"], bits), ["id"], bits)
    assert 100 <= passed.count() < 2000
