"""Plan checks and the driver contract."""

from paths import SF001

from gapscan.operators.gap import gap_outliers


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gap_plan_has_no_python_and_no_global_window(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = _plan(gap_outliers(o, ["o_custkey"], "o_totalprice"))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "SinglePartition" not in plan


def test_gap_plan_moves_only_segment_tables(spark):
    """The staged rows are read in their buckets: only the segment tables and
    the per-key bounds are exchanged, by hash."""
    import re
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = _plan(gap_outliers(o, ["o_custkey"], "o_totalprice"))
    assert "Bucketed: true" in plan
    assert set(re.findall(r"(?<!Broadcast)Exchange (\w+)\(", plan)) == {"hashpartitioning"}


def test_scan_prunes_and_pushes(spark):
    from gapscan.plans.catalog import q_prepare_records
    plan = q_prepare_records(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))" in plan
    assert "ReadSchema" in plan and "o_orderdate" not in plan  # pruned: y_cell is not projected


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "n_outliers" in df.columns
    from gapscan.plans.catalog import QUERIES
    qs, sql = E.queries(), E.oracle_sql()
    assert len(QUERIES) == 65 and set(QUERIES) <= set(qs) and set(QUERIES) <= set(sql) <= set(qs)


UNSCALABLE = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
               "FlatMapGroupsInPandas", "SinglePartition")


# What is small whatever the tables: the rows before each file, from one row a file.
ALLOWED = {"ordered_labels": {"SinglePartition"}}


def test_queries_run_at_smoke_scale_with_scalable_plans(spark):
    """Every registered query runs; none uses a cross product, a nested-loop
    join, a Python worker, or a single-partition exchange (but for ``ALLOWED``)."""
    from concurrent.futures import ThreadPoolExecutor

    from gapscan.plans.catalog import QUERIES

    def unscalable(name):
        df = QUERIES[name](spark, SF001)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        return name, [n for n in UNSCALABLE if n in plan and n not in ALLOWED.get(name, ())]
    with ThreadPoolExecutor(4) as pool:     # small jobs leave most cores idle
        assert [x for x in pool.map(unscalable, QUERIES) if x[1]] == []


def test_fixture_has_shared_flagged_cells(spark):
    """Some flagged (group, cell) holds several records, so the fan-out from cells to records is tested."""
    from paths import SF01

    from gapscan.plans import fixtures as FX
    rf = FX.rf(spark, SF01).join(FX.records(spark, SF01).select(FX.RECORD_ID, *FX.CELL), FX.RECORD_ID)
    shared = rf.groupBy(FX.GROUP, "surface", *FX.CELL).count().where("count > 1")
    assert shared.count() > 0


def test_profiles_run_one_gap_search_and_aggregate_first(spark, monkeypatch):
    """The gap search is planned once a query, and rows meet the kept keys aggregated."""
    from gapscan.plans import catalog as C
    from gapscan.plans import fixtures as FX
    calls = []
    search = FX.gap_outliers
    monkeypatch.setattr(FX, "gap_outliers", lambda *a, **k: calls.append(1) or search(*a, **k))
    plans = []
    for q in (C.cumulative_frequency, C.q_location_flag_count, C.q_bbox_padded):
        plans.append(q(spark, SF001)._jdf.queryExecution().optimizedPlan().toString())
    assert len(calls) == 3
    assert all("Window" not in p for p in plans[1:])   # flags are read from their staged table
    semi = plans[1].index("Join LeftSemi")
    assert "Aggregate" in plans[1][semi:]               # below the semi join
    assert "LeftSemi" not in plans[2]


def test_hot_key_among_many_small_ones_is_split(spark):
    """A key with a third of the values spans several segments of the staged rows."""
    from pyspark.sql import functions as F

    from gapscan.operators.segments import SEG, tag_segments
    hot = spark.range(20000).select(F.lit(-1).cast("long").alias("k"), F.col("id").cast("double").alias("v"))
    small = spark.range(40000).select((F.col("id") % 4000).alias("k"), F.col("id").cast("double").alias("v"))
    rows = tag_segments(hot.unionByName(small), ["k"], ["v"], 8)
    sizes = {r[SEG]: r["count"] for r in rows.groupBy(SEG).count().collect()}
    assert rows.where("k = -1").select(SEG).distinct().count() >= 2
    assert max(sizes.values()) < 2 * 60000 / 8
