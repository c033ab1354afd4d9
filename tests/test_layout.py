"""Bucketed, cell-ordered and globally ordered tables."""

import glob
import re
import tempfile

import pyarrow.parquet as pq
from paths import SF001
from pyspark.sql import functions as F

from gapscan.functions import morton
from gapscan.operators import flags as FL
from gapscan.operators.grid import make_grid
from gapscan.operators.segments import drop_staged, materialize, staged_table
from gapscan.plans import fixtures as FX
from gapscan.sources import layout as L
from gapscan.staging import mark


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_records_need_no_exchange(spark):
    """Distinct cells and the join that brings flags back read the buckets in place."""
    before = mark(spark)
    name, path = staged_table(spark, "records")
    cell = [FX.GROUP, *FX.CELL]
    rec = L.write_bucketed(FX.records(spark, SF001), name, path, cell, ["record_class"])
    try:
        assert "Exchange" not in _plan(rec.select(*cell).distinct())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        few = materialize(rec.where("record_id % 50 = 0").select(*cell).distinct())
        plan = _plan(FL.join_few(rec, few, cell))
        records_side = plan[plan.index("SortMergeJoin"):plan.index(f"{name}")]
        assert "Bucketed: true" in plan and "getbit" in records_side
        # below the join, on the records' side, only the filter is broadcast
        assert not re.search(r"(?<!Broadcast)Exchange", records_side)
        assert rec.join(few, cell, "left_semi").count() == FL.join_few(rec, few, cell).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_staged(spark, before)


def test_classes_found_at_run_time_prune_folders(spark):
    before = mark(spark)
    name, path = staged_table(spark, "records")
    rec = L.write_bucketed(FX.records(spark, SF001), name, path, [FX.GROUP, *FX.CELL], ["record_class"])
    try:
        counts = materialize(rec.groupBy("record_class").count())
        largest = counts.agg(F.max("count")).first()[0]
        kept = rec.join(F.broadcast(counts.where(F.col("count") >= largest).select("record_class")), "record_class")
        assert "dynamicpruning" in _plan(kept)
        assert kept.select("record_class").distinct().count() == 1
    finally:
        drop_staged(spark, before)


def _row_groups(path, box):
    """(row groups, those whose ranges meet the box) of all files."""
    total = met = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(at[c]).statistics for c in ("row", "col")}
            total += 1
            met += all(s.max >= lo and s.min <= hi for s, lo, hi in
                       ((stats["row"], *box[:2]), (stats["col"], *box[2:])))
    return total, met


def test_cells_in_morton_order_prune_row_groups(spark):
    d = tempfile.mkdtemp(prefix="gapscan-layout-", dir="/tmp")
    grid = make_grid(spark, 1.0, 0.0, 255.0, 0.0, 255.0)
    L.write_by_cell(grid, f"{d}/morton", "row", "col", files=16, row_group_bytes=20_000)
    grid.repartitionByRange(16, "row", "col").sortWithinPartitions("row", "col") \
        .write.option("parquet.block.size", "20000").parquet(f"{d}/rows")
    box = (100, 130, 60, 90)
    total, met = _row_groups(f"{d}/morton", box)
    assert met < total / 8 and met <= _row_groups(f"{d}/rows", box)[1]
    narrow = (0, 255, 100, 110)
    assert _row_groups(f"{d}/morton", narrow)[1] < total / 4
    by_row, met_by_row = _row_groups(f"{d}/rows", narrow)
    assert met_by_row > 0.9 * by_row           # sorted by row alone, nearly all is read
    found = L.in_box(spark.read.parquet(f"{d}/morton"), "row", "col", *box)
    assert "PushedFilters: [IsNotNull(row), IsNotNull(col), GreaterThanOrEqual(row,100)" in _plan(found)
    assert found.count() == 31 * 31


def test_morton_key_interleaves_bits(spark):
    cells = [(0, 0), (1, 0), (0, 1), (-1, 5), (2 ** 30 - 1, -(2 ** 30)), (12345, -678)]
    got = spark.createDataFrame(cells, "x long, y long").select("x", "y", morton("x", "y").alias("m")).collect()
    for r in got:
        bits = lambda v: f"{v + 2 ** 30:031b}"
        assert r.m == int("".join(b + a for a, b in zip(bits(r.x), bits(r.y))), 2)


def test_ordered_files_are_the_whole_order(spark):
    d = tempfile.mkdtemp(prefix="gapscan-layout-", dir="/tmp")
    rows = spark.range(50_000).select(F.pmod(F.hash("id"), F.lit(9973)).alias("v"), "id")
    L.write_ordered(rows, f"{d}/o", ["v", "id"], files=7)
    got = L.read_ordered(spark, f"{d}/o").orderBy("position").collect()
    assert len(glob.glob(f"{d}/o/part-*.parquet")) > 1
    assert [r.position for r in got] == list(range(1, 50_001))
    assert [(r.v, r.id) for r in got] == sorted((r.v, r.id) for r in got)
    L.write_ordered(rows.limit(0), f"{d}/empty", ["v"])
    assert L.read_ordered(spark, f"{d}/empty").count() == 0
