"""Preparation, reshape, grid, segments, profile and report operators on tiny frames."""

import pytest
from pyspark.sql import functions as F

from gapscan.functions import (blank_zero, cell_to_value, composite_key, fixed_decimal,
                               normalise_label, safe_ratio, snap_cell, snap_value, split_key,
                               surface_number)
from gapscan.operators import flags as FL
from gapscan.operators import profile as PR
from gapscan.operators import reports as RP
from gapscan.operators.grid import (build_surfaces, grid_lookup, make_grid, point_cells,
                                    raster_cell_join, raster_rows)
from gapscan.operators.prepare import (drop_null_rows, prepare_records, range_or_null,
                                       rename_by_index, rows_containing, scale_columns, select_like)
from gapscan.operators.reshape import pivot_wide, unpivot_surfaces
from gapscan.operators.segments import quantiles_disc, running_sum, with_next, with_positions


def test_snap_matches_reference_order_of_operations(spark):
    vals = [0.05, 0.15, -0.05, -0.15, 12.349999, 12.35, -179.95, 89.95]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select(snap_cell("x").alias("c"), snap_value("x").alias("s"),
                    cell_to_value(snap_cell("x")).alias("b")).collect()
    for v, r in zip(vals, got):
        assert r.c == round_half_away(v * 100 / 10)
        assert r.s == r.c * 10 / 100 == r.b


def round_half_away(x):
    from decimal import ROUND_HALF_UP, Decimal
    return int(Decimal(x).quantize(Decimal(1), rounding=ROUND_HALF_UP))


def test_scalar_functions(spark):
    df = spark.createDataFrame([("NATION_1", "bio12", 0, 3.0, 0.0)], "n string, b string, k int, a double, z double")
    r = df.select(normalise_label("n").alias("l"), surface_number("b", "bio").alias("no"),
                  blank_zero("k").alias("bz"), safe_ratio("a", "z").alias("q"),
                  fixed_decimal(F.lit(-0.04), 1).alias("fd"),
                  composite_key("k", "b").alias("ck")).first()
    assert (r.l, r.no, r.bz, r.q, r.fd, r.ck) == ("nation 1", 12, "", None, "0.0", "0_bio12")
    assert df.select(split_key(F.lit("12_bio3"), 1).alias("p")).first().p == "bio3"


def test_prepare_records_filters(spark):
    rows = [(1, False, "HUMAN_OBSERVATION", 1, 10.04, 20.06),
            (2, True, "HUMAN_OBSERVATION", 1, 10.0, 20.0),
            (3, False, "FOSSIL_SPECIMEN", 1, 10.0, 20.0),
            (4, False, None, 1, 10.0, 20.0),
            (5, False, "PRESERVED_SPECIMEN", 2, 10.0, 20.0),
            (6, False, "PRESERVED_SPECIMEN", 6, None, 20.0),
            (7, False, "PRESERVED_SPECIMEN", 5, -0.05, 0.05)]
    df = spark.createDataFrame(rows, "id long, issue boolean, basis string, kingdom int, lat double, lon double")
    out = prepare_records(df, false_flags=["issue"],
                          exclude={"basis": ["FOSSIL_SPECIMEN", "UNKNOWN", "LIVING_SPECIMEN"]},
                          include={"kingdom": [1, 6, 5]}, not_null=["lat", "lon"],
                          snap={"lat": ("lat_cell", "lat_r"), "lon": ("lon_cell", "lon_r")},
                          columns=["id", "lat_cell", "lon_cell", "lat_r", "lon_r"]).orderBy("id").collect()
    assert [r.id for r in out] == [1, 7]
    assert (out[0].lat_cell, out[0].lon_cell) == (100, 201)
    assert (out[1].lat_cell, out[1].lon_cell) == (-1, 1)


def test_filters_and_columns(spark):
    df = spark.createDataFrame([(1, 500.0, "a"), (2, None, "b"), (3, 5000.0, None)],
                               "id long, u double, c string")
    assert sorted(r.id for r in range_or_null(df, "u", 1000).collect()) == [1, 2]
    assert sorted(r.id for r in drop_null_rows(df).collect()) == [1]
    assert scale_columns(df, ["u"], 10).where("id = 1").first().u == 50.0
    wide = spark.createDataFrame([(1, 1.0, 2.0, 3.0)], "id long, bio1 double, bio2 double, comp1 double")
    assert select_like(wide, contains=["bio"], keep=["id"]).columns == ["id", "bio1", "bio2"]
    assert rename_by_index(wide, "bio", "outlier", 19).columns == ["id", "outlier1", "outlier2", "comp1"]
    names = spark.createDataFrame([("bio1",), ("comp1",), ("bio12",)], "surface string")
    assert sorted(r.surface for r in rows_containing(names, "surface", "bio").collect()) == ["bio1", "bio12"]


def test_unpivot_and_pivot_round_trip(spark):
    wide = spark.createDataFrame([(1, 1.0, 2, None), (2, 4.0, 5, 6.0)], "id long, a double, b int, c double")
    long = unpivot_surfaces(wide, ["id"], ["a", "b", "c"])
    assert long.count() == 5
    back = pivot_wide(long, ["id"], "surface", "xx", ["a", "b", "c", "d"]).orderBy("id").collect()
    assert back[0].asDict() == {"id": 1, "a": 1.0, "b": 2.0, "c": None, "d": None}
    assert back[1].c == 6.0


def test_make_grid_and_cells(spark):
    g = make_grid(spark, 10.0)
    assert g.count() == 19 * 37
    assert g.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first() == (-90.0, 90.0, -180.0, 180.0)
    pts = spark.createDataFrame([(1, 15.0, -5.0), (2, -179.0, 89.0)], "id long, lon double, lat double")
    cells = point_cells(pts, "lon", "lat", -180.0, 90.0, 10.0, 10.0).orderBy("id").collect()
    assert (cells[0].cell_col, cells[0].cell_row) == (19, 9)
    assert (cells[1].cell_col, cells[1].cell_row) == (0, 0)
    band = spark.createDataFrame([(9, 19, 250.0, 10.0), (0, 0, None, 3.0)],
                                 "row long, col long, b1 double, b2 double")
    grid = make_grid(spark, 10.0)
    surf = build_surfaces(grid, band, ["b1", "b2"]).collect()
    assert len(surf) == 1 and surf[0].b1 == 25.0 and surf[0].b2 == 1.0
    hit = raster_cell_join(point_cells(pts, "lon", "lat", -180.0, 90.0, 10.0, 10.0),
                           band.withColumnRenamed("row", "cell_row").withColumnRenamed("col", "cell_col"))
    assert sorted(r.id for r in hit.collect()) == [1, 2]
    recs = spark.createDataFrame([(1, 9, 19), (2, 5, 5)], "id long, row long, col long")
    assert [r.id for r in grid_lookup(recs, band, ["row", "col"]).collect()] == [1]


@pytest.mark.parametrize("kw", [{"partitions": 1}, {"partitions": 5}, {}])
def test_segment_helpers(spark, kw):
    rows = [(k, float(v)) for k in (1, 2) for v in range(k * 50)]
    df = spark.createDataFrame(rows, "k long, v double")
    pos_df = with_positions(df, ["k"], ["v"], **kw)
    assert dict(pos_df.dtypes)["pos"] == "bigint" and dict(pos_df.dtypes)["n"] == "bigint"
    pos = {(r.k, r.v): (r.pos, r.n) for r in pos_df.collect()}
    assert pos[(2, 0.0)] == (1, 100) and pos[(2, 99.0)] == (100, 100) and pos[(1, 10.0)] == (11, 50)
    nxt = {(r.k, r.v): r.x1 for r in with_next(df, ["k"], "v", **kw).collect()}
    assert nxt[(1, 48.0)] == 49.0 and nxt[(1, 49.0)] is None
    rs = {(r.k, r.v): r.cs for r in running_sum(df.withColumn("one", F.lit(2)), ["k"], ["v"], "one", "cs",
                                                  **kw).collect()}
    assert rs[(2, 99.0)] == 200 and rs[(1, 0.0)] == 2
    q = {r.k: (r.n, r.q1, r.med, r.q3) for r in
         quantiles_disc(df, ["k"], "v", {"q1": 0.25, "med": 0.5, "q3": 0.75}, **kw).collect()}
    assert q[1] == (50, 12.0, 24.0, 37.0)


def _toy(spark):
    records = spark.createDataFrame(
        [(i, i % 2, "F" if i % 3 else "O", f"src{i % 2}", float(i), i % 4, i % 3) for i in range(1, 41)],
        "record_id long, group_key long, record_class string, source_key string, amount double, x_cell int, y_cell int")
    # surface 'a': group 0 has an extreme value at record 40; 'b' has no outliers
    surf = records.select("record_id", F.when(F.col("record_id") == 40, F.lit(1e6))
                          .otherwise(F.col("record_id").cast("double")).alias("a"),
                          F.lit(1.0).alias("b"))
    return records, surf


def test_product_pipeline(spark):
    records, surf = _toy(spark)
    long = FL.long_cells(records, surf, "group_key", ["record_id"], ["a", "b"])
    flags = FL.surface_outliers(records, surf, "group_key", ["record_id"], ["a", "b"])
    fl = {(r.group_key, r.surface, r.xx, r.outlier_type) for r in flags.collect()}
    assert (0, "a", 1e6, "upper") in fl and all(s == "a" for _, s, _, _ in fl)
    rf = FL.outlier_records(records, long, flags, "record_id", "group_key", ["record_id"])
    ids = {r.record_id for r in rf.collect()}
    assert 40 in ids
    export = FL.outlier_export(records, rf, "record_id", ["a", "b"]).collect()
    assert {r.record_id for r in export} == ids
    assert all(r.n_outliers == 1 and r.b is None for r in export)
    assert FL.trusted(FL.outlier_export(records, rf, "record_id", ["a", "b"]), 2).count() == 0
    cnt = FL.count_outlier_surfaces(rf, "record_id").collect()
    assert all(r.n_outliers == 1 for r in cnt)
    memb = FL.membership(records, rf, "record_id", "hit").where("hit").count()
    assert memb == len(ids) == FL.semi_filter(records, rf, "record_id").count()
    left = FL.left_outer_flags(records, FL.outlier_export(records, rf, "record_id", ["a", "b"])
                               .select("record_id", "n_outliers"), ["record_id"])
    assert left.count() == 40


def test_profile_and_reports(spark):
    records, surf = _toy(spark)
    long = FL.long_cells(records, surf, "group_key", ["record_id"], ["a", "b"])
    flags = FL.surface_outliers(records, surf, "group_key", ["record_id"], ["a", "b"])
    rf = FL.outlier_records(records, long, flags, "record_id", "group_key", ["record_id"])
    ll = PR.flagged_long(long.join(records.select("record_id", "x_cell", "y_cell"), "record_id"),
                         rf, "record_id")
    prof = PR.cumfreq_profile(ll, ["group_key", "surface"], "xx", ["x_cell", "y_cell"]).collect()
    assert {(r.group_key, r.surface) for r in prof} == {(0, "a")}
    assert max(r.cum_freq for r in prof) == 20
    loc = PR.location_flag_count(ll, "group_key", ["x_cell", "y_cell"]).collect()
    want = rf.join(records.select("record_id", "x_cell", "y_cell"), "record_id") \
        .select("group_key", "surface", "x_cell", "y_cell").distinct().count()
    assert sum(r.n_outliers for r in loc) == want == 2
    bb = PR.bbox_padded(ll, ["group_key", "surface"], "x_cell", "y_cell", 10).first()
    assert (bb.x_min, bb.x_max) == (-10, 12)
    flagged = RP.flagged_records(records, rf, "record_id")
    assert RP.count_by(flagged, ["record_class"], ["record_id"]).count() >= 1
    pages = RP.ids_json_pages(records, "source_key", "record_id", page_size=7).collect()
    assert sum(r.n_ids for r in pages) == 40 and max(r.page for r in pages) == 2
    assert [r.group_key for r in RP.nth_key(records, "group_key", 2).collect()] == [1]
    assert RP.nth_key(records, "group_key", 3).count() == 0
    top = RP.top_by_count(records, "source_key", "record_id", 1).collect()
    assert [(r.source_key, r.n) for r in top] == [("src0", 20)]
    assert RP.random_group(records, "group_key").count() == 1
    ov = {(r.in_a, r.in_b): r.n for r in RP.detector_overlap(records, rf, records.where("record_id <= 2"),
                                                              "record_id").collect()}
    assert sum(ov.values()) == 40
    share = RP.source_share(records, rf, "source_key", "record_id", min_flagged=0).collect()
    assert all(0 < r.share <= 1 for r in share)
    mean = RP.mean_by_flag_count(FL.outlier_export(records, rf, "record_id", ["a", "b"]), ["record_id"],
                                 "amount").collect()
    assert mean[0].n_outliers == 1


def test_materialize_bucketed_and_drop_staged(spark):
    from gapscan.operators.segments import STAGED_PREFIX, drop_staged, materialize
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    staged = materialize(df, ["k"], 2)
    assert staged.count() == 10
    plan = staged.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan   # aggregate reads the buckets in place
    plain = materialize(df)
    assert sorted(r.id for r in plain.collect()) == list(range(10))
    spark.range(3).write.saveAsTable(f"{STAGED_PREFIX}of_another_session")
    try:
        assert drop_staged(spark) >= 1
        left = [t.name for t in spark.catalog.listTables() if t.name.startswith(STAGED_PREFIX)]
        assert left == [f"{STAGED_PREFIX}of_another_session"]
    finally:
        spark.sql(f"DROP TABLE {STAGED_PREFIX}of_another_session")


def test_staged_files_are_deleted(spark):
    from gapscan import staging
    staging.release(spark)
    staged = staging.stage(spark.range(5))
    path = staged.inputFiles()[0].rsplit("/", 1)[0]
    assert staged.count() == 5 and staging.release(spark) == 1
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def test_reports_count_what_they_are_told(spark):
    """Several records of one group at one place count once."""
    rows = [(1, 7, "A", 0, 0, 5.0, 1), (2, 7, "A", 0, 0, 5.0, 1), (3, 7, "A", 1, 0, 6.0, 1), (4, 8, "A", 0, 0, 5.0, 1)]
    df = spark.createDataFrame(rows, "record_id long, g long, c string, x int, y int, u double, n_outliers int")
    assert RP.count_by(df, ["c"], ["g", "x", "y"]).first().n == 3
    assert [tuple(r) for r in RP.hot_locations(df, ["x", "y"], "g", 2).collect()] == [(0, 0, 2)]
    mean = RP.mean_by_flag_count(df, ["g", "x", "y"], "u").first()
    assert (mean.n_records, mean.mean_value) == (3, round(16 / 3, 6))


def test_export_keeps_repeated_ids(spark):
    recs = spark.createDataFrame([(1, "g", 0), (1, "g", 0), (2, "g", 0), (3, "g", 1)], "id long, g string, cell int")
    long = spark.createDataFrame([("g", 0, "s1", 9.0), ("g", 1, "s1", 1.0)], "g string, cell int, surface string, xx double")
    flags = spark.createDataFrame([("g", "s1", 9.0, "upper")], "g string, surface string, xx double, outlier_type string")
    out = FL.export_flagged(recs, long, flags, "id", "g", ["cell"], ["s1"])
    assert sorted((r.id, r.s1, r.n_outliers) for r in out.collect()) == [(1, 9.0, 1), (1, 9.0, 1), (2, 9.0, 1)]


def test_composite_key_with_null_and_separator(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    got = [r[0] for r in df.select(composite_key("x", "y", sep=".")).collect()]
    assert got == [None, "a.b"]
    assert df.select(split_key(F.lit("a.b"), 1, sep=".").alias("p")).first().p == "b"


def test_reports_from_k_flags(spark):
    recs = spark.createDataFrame([(i, "s") for i in range(4)], "record_id long, source_key string")
    rf = spark.createDataFrame([(0, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "a")], "record_id long, surface string")
    ids = lambda k: sorted(r.record_id for r in RP.flagged_records(recs, rf, "record_id", k).collect())
    assert (ids(1), ids(2), ids(3)) == ([0, 1, 2], [1], [])
    share = RP.source_share(recs, rf, "source_key", "record_id", min_flagged=0, k=2).first()
    assert (share.n_flagged, share.n_total, share.share) == (1, 4, 0.25)


def test_detector_labels(spark):
    recs = spark.createDataFrame([(i,) for i in (1, 2, 3, 3, 4)], "record_id long")
    a = spark.createDataFrame([(1, 5.0), (3, None)], "record_id long, s1 double")
    b = spark.createDataFrame([(2,), (3,), (3,)], "record_id long")
    got = sorted(tuple(r) for r in RP.detector_labels(recs, a, b, "record_id", ["s1"])
                 .select("record_id", "in_a", "in_b", "in_both", F.coalesce("s1", F.lit(-1.0))).collect())
    assert got == [(1, True, False, False, 5.0), (2, False, True, False, -1.0), (3, True, True, True, -1.0),
                   (3, True, True, True, -1.0), (4, False, False, False, -1.0)]


def test_raster_rows(spark):
    cells = spark.createDataFrame([(0, 1, 7.0, None)], "cell_row long, cell_col long, b1 double, b2 double")
    rows = raster_rows(cells, ["b1", "b2"], -180.0, 90.0, 10.0, 10.0).collect()
    assert [tuple(r) for r in rows] == [(-165.0, 85.0, "b1", 7.0)]


def test_labelled_profile(spark):
    rows = [("g", 0, 0, "s1", 1.0, 2, False), ("g", 1, 0, "s1", 9.0, 1, True),
            ("g", 0, 0, "s2", 4.0, 2, False), ("h", 0, 0, "s1", 3.0, 1, False)]
    df = spark.createDataFrame(rows, "g string, x int, y int, surface string, xx double, n long, is_outlier boolean")
    dim = spark.createDataFrame([("s1", "One"), ("s2", "Two")], "surface string, long_name string")
    out = PR.labelled_profile(df, "g", "xx", ["x", "y"], dim, "s", weight="n").orderBy("xx").collect()
    assert [(r.xx, r.freq, r.cum_freq, r.long_name, r.surface_no, r.n_outliers, r.n_label) for r in out] == [
        (1.0, 2, 2, "s1-One", 1, 0, ""), (9.0, 1, 3, "s1-One", 1, 1, "1")]
