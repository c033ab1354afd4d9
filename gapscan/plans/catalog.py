"""The driver queries: name -> (spark, sf_dir) -> DataFrame.

Each one runs a library operator over whole test tables (or data Spark
derives from them). Computed columns carry the same names as in
``gapscan.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscan.functions import (blank_zero, composite_key, fixed_decimal, normalise_label, snap_cell, snap_value,
                               split_key, surface_number)
from gapscan.operators import flags as FL
from gapscan.operators import profile as PR
from gapscan.operators import reports as RP
from gapscan.operators.gap import gap_outliers, gap_scores
from gapscan.operators.grid import (grid_lookup, grid_over, point_cells, raster_cell_join,
                                    raster_rows, surface_table)
from gapscan.operators.prepare import (drop_null_rows, prepare_records, range_or_null, rename_by_index,
                                       rows_containing, scale_columns, select_like)
from gapscan.operators.quantiles import approx_quantiles
from gapscan.operators.reshape import unpivot_surfaces
from gapscan.operators.segments import materialize, quantiles_disc, staged_table, with_next
from gapscan.plans import fixtures as FX
from gapscan.plans import job
from gapscan.plans.fixtures import CELL, GROUP, RECORD_ID, SURFACES, table
from gapscan.sources import read_parquet, read_records_csv, surface_dim, write_tsv
from gapscan.sources.layout import in_box, read_ordered, write_bucketed, write_by_cell, write_ordered
from gapscan.sources.quarantine import read_split
from gapscan.sources.runs import read_counters, read_run, write_run
from gapscan.staging import staging_path

Query = Callable[[SparkSession, str], DataFrame]

# Long names of the four test surfaces (the label dimension).
SURFACE_NAMES = [
    ("s1", "Quantity"),
    ("s2", "Extended price in cents"),
    ("s3", "Discount in percent"),
    ("s4", "Line count"),
]
TRUSTED_K = 2
PAD = 10
NTH = 15
HOT_LOCATION = 2
MIN_FLAGGED = 10
THIN_CELL = 20         # line items below which a cell is taken off the surface
LEAST_SHARE = 0.1      # of all records, for a class to be exported by itself
RANK_ERROR = 0.005


def _orders_values(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias(GROUP), F.col("o_totalprice").alias("amount"))


def _export(spark, sf_dir):
    return FX.export(spark, sf_dir)


def _marked(spark, sf_dir):
    """(cells marked as flagged or not, flags); the flags are staged, so that the
    gap search runs once."""
    _, lg, fl = FX.flagged(spark, sf_dir)
    fl = materialize(fl)
    return PR.flagged_cells_long(lg, fl, GROUP), fl


def _surface_dim(spark):
    return surface_dim(spark, SURFACE_NAMES).select("surface", "long_name")


def _docs_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


# -- projections, filters, scalar functions --------------------------------

def snap_grid(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "value", snap_cell("value").alias("cell"),
                     snap_value("value").alias("snapped"))


def q_prepare_records(spark, sf_dir):
    return prepare_records(
        FX.records(spark, sf_dir),
        exclude={"record_class": ["P"]},
        include={"source_key": ["1-URGENT", "2-HIGH", "3-MEDIUM"]},
        not_null=["amount"],
        snap={"amount": ("amount_cell", "amount_snapped")},
        columns=[RECORD_ID, GROUP, "record_class", "source_key", "amount",
                 "amount_cell", "amount_snapped"])


def filter_range_or_null(spark, sf_dir):
    return range_or_null(_docs_labels(spark, sf_dir), "toxic", 1)


def q_drop_null_rows(spark, sf_dir):
    return drop_null_rows(_docs_labels(spark, sf_dir).select("doc_id", "source", "quality", "toxic"))


def q_normalise_label(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", normalise_label("n_name").alias("label"))


def boolean_filter(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_discount") > 0.05).alias("is_cut"))
    return prepare_records(lines, false_flags=["is_cut"], columns=["l_orderkey", "l_linenumber", "l_quantity"])


def q_rows_containing(spark, sf_dir):
    return rows_containing(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "ring")


def q_select_like(spark, sf_dir):
    return select_like(table(spark, sf_dir, "lineitem"), contains=["price"], startswith=["l_return"],
                       keep=["l_orderkey", "l_linenumber"])


def q_rename_by_index(spark, sf_dir):
    return rename_by_index(FX.surf(spark, sf_dir), "s", "layer", len(SURFACES))


def q_scale_columns(spark, sf_dir):
    return scale_columns(FX.surf(spark, sf_dir), SURFACES, 10.0)


def fixed_decimal_key(spark, sf_dir):
    cells = FX.surf(spark, sf_dir)
    return cells.select(*CELL, *[fixed_decimal(F.col(c) / 10).alias(f"{c}_text") for c in CELL])


def q_surface_number(spark, sf_dir):
    long = unpivot_surfaces(FX.surf(spark, sf_dir), CELL, SURFACES)
    return long.select(*CELL, surface_number("surface", "s").alias("number"), "xx")


def q_blank_zero(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", blank_zero(F.col("l_linenumber") - 1).alias("lines_before"))


def row_count(spark, sf_dir):
    # counted while the table is written; the counter is read from the commit record
    path = staging_path(spark, "run")
    write_run(table(spark, sf_dir, "orders"), path, ["o_orderstatus"], "orders", {"n": F.count(F.lit(1))})
    return read_counters(spark, path, ["n"])


def write_counters(spark, sf_dir):
    """Three counters of one write: records, those off the surface, those flagged."""
    cells = FX.surf(spark, sf_dir).where(F.col("s4") >= THIN_CELL).select(*CELL)
    rec = FL.membership(FX.records(spark, sf_dir), cells, CELL, "on_surface")
    rec = FL.membership(rec, FX.rf(spark, sf_dir), RECORD_ID, "flagged")
    path = staging_path(spark, "run")
    write_run(rec, path, ["record_class"], "records", {
        "n_records": F.count(F.lit(1)), "n_off_surface": F.count_if(~F.col("on_surface")),
        "n_flagged": F.count_if("flagged")})
    return read_counters(spark, path, ["n_records", "n_off_surface", "n_flagged"])


def restarted_write(spark, sf_dir):
    """A first run writes all classes; a second one replaces those it has rows for."""
    rec = FX.records(spark, sf_dir).select(RECORD_ID, "record_class", "amount")
    path = staging_path(spark, "run")
    write_run(rec, path, ["record_class"], "all")
    again = rec.where(F.col("record_class") == "F").withColumn("amount", F.round("amount"))
    write_run(again, path, ["record_class"], "class F", mode="replace")
    return read_run(spark, path).select(RECORD_ID, "record_class", "amount")


def quarantine_rows(spark, sf_dir):
    """All orders as tab-separated lines, some broken, read back as good rows and set-aside lines."""
    key = F.col("o_orderkey")
    fields = [key.cast("string"), F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string")]
    line = (F.when(key % 40 == 1, F.concat_ws("\t", *fields[:2], F.lit("n/a")))
             .when(key % 40 == 2, F.concat_ws("\t", *fields[:2]))
             .when(key % 40 == 3, F.concat_ws("\t", *fields, F.lit("more")))
             .otherwise(F.concat_ws("\t", *fields)))
    path = staging_path(spark, "lines")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    split = read_split(spark, path, "o_orderkey bigint, o_custkey bigint, price double", header=False)
    bad = split.bad.select(split_key("line", 0, "\t").cast("bigint").alias("o_orderkey"), F.lit(None).cast("double").alias("price"),
                           F.lit(True).alias("is_bad"))
    return split.good.select("o_orderkey", "price", F.lit(False).alias("is_bad")).unionByName(bad)


def csv_id_list(spark, sf_dir):
    """Records on an outside list of ids: a CSV file with a header, read with a declared schema."""
    listed = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    path = staging_path(spark, "csv")
    listed.select("o_orderkey", "o_orderpriority").write.option("header", "true").csv(path)
    ids = read_records_csv(spark, path, "gbif_id bigint, note string").select(F.col("gbif_id").alias(RECORD_ID))
    return FL.semi_filter(FX.records(spark, sf_dir).select(RECORD_ID, GROUP, "amount"), ids, RECORD_ID)


def ordered_labels(spark, sf_dir):
    """All orders by the number in their label (bio2 before bio10), written as
    sorted files and read back with their place in the whole order."""
    label = F.concat(F.lit("bio"), F.month("o_orderdate").cast("string"))
    rows = table(spark, sf_dir, "orders").select(label.alias("label"), "o_orderkey")
    path = staging_path(spark, "ordered")
    write_ordered(rows, path, [surface_number("label", "bio"), "o_orderkey"])
    return read_ordered(spark, path)


def approx_quartiles(spark, sf_dir):
    """Approximate quartiles of the amounts of each class, checked against the
    ranks that they really have: ``ok`` when within three times the rank error."""
    values = FX.records(spark, sf_dir).select("record_class", "amount")
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    q = materialize(approx_quantiles(values, ["record_class"], "amount", probs, RANK_ERROR))
    ranks = [f(F.when(c, 1)).alias(f"{name}_{side}") for name in probs
             for f, side, c in ((F.count, "below", F.col("amount") < F.col(name)),
                                (F.count, "upto", F.col("amount") <= F.col(name)))]
    checked = values.join(q, "record_class").groupBy("record_class").agg(F.max("n").alias("n"), *ranks)
    slack = 3 * RANK_ERROR * F.col("n") + 1
    return checked.select("record_class", "n", *[
        ((F.col(f"{name}_below") <= p * F.col("n") + slack) & (F.col(f"{name}_upto") >= p * F.col("n") - slack))
        .alias(f"{name}_ok") for name, p in probs.items()])


def bucketed_export(spark, sf_dir):
    """The wide export from a bucketed record table, for the classes that hold a
    good share of all records (their folders are found at run time)."""
    name, path = staged_table(spark, "records")
    rec = write_bucketed(FX.records(spark, sf_dir), name, path, [GROUP, *CELL], ["record_class"])
    counts = rec.groupBy("record_class").agg(F.count(F.lit(1)).alias("n"))
    classes = materialize(counts)
    total = classes.agg(F.sum("n")).first()[0] or 0
    lg = FL.long_cells(rec, FX.surf(spark, sf_dir), GROUP, CELL, SURFACES)
    fl = gap_outliers(lg, [GROUP, "surface"], "xx")
    kept = rec.join(F.broadcast(classes.where(F.col("n") >= LEAST_SHARE * total).select("record_class")), "record_class")
    return FL.export_flagged(kept.select(*FX.records(spark, sf_dir).columns), lg, fl, RECORD_ID, GROUP, CELL, SURFACES)


def box_lookup(spark, sf_dir):
    """The surface rows in the padded box around the flagged cells of one group,
    from a surface table in Morton order."""
    rec, lg, fl = FX.flagged(spark, sf_dir)
    cells = materialize(FL.flagged_cells(lg, fl, GROUP))
    group = RP.nth_key(cells, GROUP, NTH)
    here = cells.join(group, GROUP, "left_semi").withColumn("is_outlier", F.lit(True))
    box = PR.bbox_padded(here, [], *CELL, PAD).first()
    path = staging_path(spark, "surface")
    write_by_cell(FX.surf(spark, sf_dir), path, *CELL)
    surface = read_parquet(spark, path)
    if box is None:      # fewer groups than NTH
        return surface.limit(0)
    return in_box(surface, *CELL, box["x_min"], box["x_max"], box["y_min"], box["y_max"])


def natural_merge(spark, sf_dir):
    """Records with what their group and class hold in all, by the column names
    that both tables have; missing classes are one class."""
    rec = FX.records(spark, sf_dir).select(
        RECORD_ID, GROUP, F.nullif("record_class", F.lit("P")).alias("record_class"), "amount")
    held = rec.groupBy(GROUP, "record_class").agg(F.count(F.lit(1)).alias("n_held")).where(F.col("n_held") >= 3)
    return FL.natural_join(rec, held, "left")


def job_export(spark, sf_dir):
    """The whole job through its own doors: a catalog table of occurrences and a
    surface TSV in, Parquet out. Cells are tenths of a degree here."""
    one = F.lit(1)
    occ = table(spark, sf_dir, "orders").join(
        FX.records(spark, sf_dir).select(F.col(RECORD_ID).alias("o_orderkey"), GROUP, *CELL), "o_orderkey").select(
        F.col("o_orderkey").alias("gbifid"), F.col("o_orderpriority").alias("datasetkey"),
        F.when(F.col("o_orderstatus") == "P", "FOSSIL_SPECIMEN").otherwise("HUMAN_OBSERVATION").alias("basisofrecord"),
        F.col(GROUP).cast("int").alias("specieskey"),
        *[one.alias(c) for c in ("genuskey", "familykey", "orderkey", "phylumkey", "classkey")],
        F.when(F.col("o_orderkey") % 7 == 0, 2).otherwise(1).alias("kingdomkey"),
        *[F.lit(c[0]).alias(c) for c in ("species", "genus", "family", "phylum", "order_", "class", "kingdom")],
        (F.col("x_cell") / 10).alias("decimallatitude"), (F.col("y_cell") / 10).alias("decimallongitude"),
        F.col("o_totalprice").alias("coordinateuncertaintyinmeters"),
        (F.col("o_orderkey") % 97 == 0).alias("hasgeospatialissues"))
    name, path = staged_table(spark, "occurrence")
    occ.write.format("parquet").option("path", path).saveAsTable(name)
    tsv, out = staging_path(spark, "tsv"), staging_path(spark, "export")
    write_tsv(FX.surf(spark, sf_dir).select((F.col("x_cell") / 10).alias("decimallatitude"),
                                            (F.col("y_cell") / 10).alias("decimallongitude"), *SURFACES), tsv)
    job.run(spark, name, tsv, out, SURFACES)
    return read_parquet(spark, out).select(
        "gbifid", "specieskey", "basisofrecord", "rounded_decimallatitude", "rounded_decimallongitude",
        *SURFACES, "n_bioclim_outliers")


def q_random_group(spark, sf_dir):
    return RP.random_group(FX.flags(spark, sf_dir), GROUP)


def q_composite_key(spark, sf_dir):
    long = unpivot_surfaces(FX.surf(spark, sf_dir), CELL, SURFACES)
    keyed = long.select(composite_key(*CELL, "surface").alias("key"), "xx")
    return keyed.select("key", split_key("key", 0).cast("long").alias("key_x"),
                        split_key("key", 1).cast("long").alias("key_y"),
                        split_key("key", 2).alias("key_surface"), "xx")


def q_unpivot_surfaces(spark, sf_dir):
    return unpivot_surfaces(FX.surf(spark, sf_dir), CELL, SURFACES)


# -- the core ------------------------------------------------------------------

def distinct_group_values(spark, sf_dir):
    return _orders_values(spark, sf_dir).select(GROUP, F.col("amount").alias("xx")).distinct()


def group_size_guard(spark, sf_dir):
    d = distinct_group_values(spark, sf_dir)
    return d.groupBy(GROUP).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 10)


def group_quartiles(spark, sf_dir):
    return quantiles_disc(distinct_group_values(spark, sf_dir), [GROUP], "xx",
                          {"q1": 0.25, "median": 0.5, "q3": 0.75})


def lead_gap(spark, sf_dir):
    return with_next(distinct_group_values(spark, sf_dir), [GROUP], "xx", "x1")


def q_gap_scores(spark, sf_dir):
    s = gap_scores(_orders_values(spark, sf_dir), [GROUP], "amount")
    # Amounts are cents: n * mx rounded to the cent is the exact sum, so the
    # mean is reported as that sum over n (no float noise from summation order).
    # y of cent data is a fraction with a small denominator that can sit on a
    # rounding tie, where one ulp of the mean decides; it is reported to the
    # thousand, far above that noise.
    mx = F.round(F.col("mx") * F.col("n"), 2) / F.col("n")
    return s.select(GROUP, "xx", "n", mx.alias("mx"), "x1",
                    F.round("y", -3).alias("y"), F.round("z", 6).alias("z"),
                    F.round("t1", 6).alias("t1"), "median", "outlier_type")


def q_gap_outliers(spark, sf_dir):
    return gap_outliers(_orders_values(spark, sf_dir), [GROUP], "amount")


def gap_outliers_by_doc(spark, sf_dir):
    return gap_outliers(table(spark, sf_dir, "documents"), ["source", "lang"], "n_chars")


def gap_outliers_by_user(spark, sf_dir):
    return gap_outliers(table(spark, sf_dir, "events"), ["user_id"], "value")


def flag_union(spark, sf_dir):
    s = materialize(gap_outliers(_orders_values(spark, sf_dir), [GROUP], "amount"))
    return (s.where(F.col("outlier_type") == "upper")
             .unionByName(s.where(F.col("outlier_type") == "lower")))


# -- grids and lookups -----------------------------------------------------------

def make_grid(spark, sf_dir):
    return grid_over(FX.records(spark, sf_dir), x="x_cell", y="y_cell", step=1.0)


def q_raster_cell_join(spark, sf_dir):
    # the raster's rows are months, the points' are hours: hours without a month miss
    cells = (FX.records(spark, sf_dir)
               .groupBy(F.col("y_cell").cast("long").alias("cell_row"),
                        F.col("x_cell").cast("long").alias("cell_col"))
               .agg(F.max(F.round(F.col("amount") * 100)).alias("band")))
    ev = table(spark, sf_dir, "events").select("event_id", "value", F.hour("ts").alias("hour"))
    points = point_cells(ev, "value", "hour", 0.0, 0.0, 10.0, 1.0, y_down=False)
    hits = raster_cell_join(points, cells).select("event_id", "cell_row", "cell_col", "band")
    return scale_columns(hits, ["band"], 10.0)


def grid_lookup_join(spark, sf_dir):
    return grid_lookup(FX.records(spark, sf_dir).select(RECORD_ID, *CELL), FX.surf(spark, sf_dir), CELL)


def _raster(spark, sf_dir):
    """The surface table as a raster of bands, one cell per location cell."""
    return FX.surf(spark, sf_dir).select(F.col("y_cell").cast("long").alias("cell_row"),
                                         F.col("x_cell").cast("long").alias("cell_col"), *SURFACES)


def surface_build(spark, sf_dir):
    grid = grid_over(FX.records(spark, sf_dir), x="x_cell", y="y_cell", step=0.5)
    return surface_table(grid, _raster(spark, sf_dir), SURFACES, 0.0, 0.0, 1.0, 1.0, y_down=False)


def q_raster_rows(spark, sf_dir):
    return raster_rows(_raster(spark, sf_dir), SURFACES, 0.0, 0.0, 1.0, 1.0, y_down=False)


# -- the product -------------------------------------------------------------------

def q_surface_outliers(spark, sf_dir):
    return FL.surface_outliers(FX.records(spark, sf_dir), FX.surf(spark, sf_dir), GROUP, CELL, SURFACES)


def flags_to_records(spark, sf_dir):
    return FX.rf(spark, sf_dir)


def q_count_outlier_surfaces(spark, sf_dir):
    return FL.count_outlier_surfaces(FX.rf(spark, sf_dir), RECORD_ID)


def pivot_wide(spark, sf_dir):
    from gapscan.operators.reshape import pivot_wide as pw
    return pw(FX.rf(spark, sf_dir), [RECORD_ID], "surface", "xx", SURFACES)


def export_wide(spark, sf_dir):
    return _export(spark, sf_dir)


def trusted_outliers(spark, sf_dir):
    return FL.trusted(_export(spark, sf_dir), TRUSTED_K)


def q_left_outer_flags(spark, sf_dir):
    from gapscan.operators.reshape import count_present, pivot_wide as pw
    wide = pw(FX.rf(spark, sf_dir), [RECORD_ID], "surface", "xx", SURFACES)
    wide = wide.withColumn("n_outliers", count_present(SURFACES))
    rec = FX.records(spark, sf_dir).select(RECORD_ID, GROUP, "amount")
    return FL.left_outer_flags(rec, wide, [RECORD_ID])


def membership_flag(spark, sf_dir):
    rec = FX.records(spark, sf_dir).select(RECORD_ID, GROUP, "record_class", "y_cell")
    return RP.label_group(rec, FX.rf(spark, sf_dir), RECORD_ID,
                          (F.col("record_class") == "F") & (F.col("y_cell") >= 3))


def q_semi_filter(spark, sf_dir):
    return FL.semi_filter(FX.records(spark, sf_dir), FX.rf(spark, sf_dir), RECORD_ID)


def label_dim_join(spark, sf_dir):
    cells = FX.long(spark, sf_dir, stage=False).select(GROUP, *CELL, "surface", "xx")
    return FL.label_join(cells, _surface_dim(spark), "surface")


# -- profiles --------------------------------------------------------------------------

def cumulative_frequency(spark, sf_dir):
    marked, hits = _marked(spark, sf_dir)
    return PR.labelled_profile(marked, GROUP, "xx", CELL, _surface_dim(spark), "s",
                               weight="n_records", hits=hits)


def q_location_flag_count(spark, sf_dir):
    marked, hits = _marked(spark, sf_dir)
    return PR.location_flag_count(marked, GROUP, CELL, hits=hits)


def q_bbox_padded(spark, sf_dir):
    marked, _ = _marked(spark, sf_dir)
    return PR.bbox_padded(marked, [GROUP, "surface"], "x_cell", "y_cell", PAD)


# -- reports ------------------------------------------------------------------------------

def _flagged(spark, sf_dir, k=1):
    return RP.flagged_records(FX.records(spark, sf_dir), FX.rf(spark, sf_dir), RECORD_ID, k)


def nth_group(spark, sf_dir):
    return RP.nth_key(FX.flags(spark, sf_dir), GROUP, NTH)


def top_sources(spark, sf_dir):
    return RP.top_by_count(_flagged(spark, sf_dir), "source_key", RECORD_ID, 100)


def report_by_class(spark, sf_dir):
    return RP.count_by(_flagged(spark, sf_dir, TRUSTED_K), ["record_class"], [GROUP, "x_cell", "y_cell"])


def report_hot_locations(spark, sf_dir):
    return RP.hot_locations(_flagged(spark, sf_dir, TRUSTED_K), ["x_cell", "y_cell"], GROUP, HOT_LOCATION)


def report_by_taxon(spark, sf_dir):
    return RP.count_by(_flagged(spark, sf_dir, TRUSTED_K), [GROUP], [RECORD_ID])


def report_by_surface(spark, sf_dir):
    return RP.count_by(FX.rf(spark, sf_dir), ["surface"], [RECORD_ID])


def report_source_share(spark, sf_dir):
    return RP.source_share(FX.records(spark, sf_dir), FX.rf(spark, sf_dir), "source_key", RECORD_ID,
                           min_flagged=MIN_FLAGGED, k=TRUSTED_K)


def report_uncertainty(spark, sf_dir):
    ex = _export(spark, sf_dir).where(F.col("record_class") == "F")
    return RP.mean_by_flag_count(ex, [GROUP, "x_cell", "y_cell"], "amount")


def ids_json_per_source(spark, sf_dir):
    return RP.ids_json_pages(_flagged(spark, sf_dir, TRUSTED_K), "source_key", RECORD_ID)


def _amount_outliers(rec):
    """Records flagged by the second detector: gap outliers of the amount per group."""
    amounts = gap_outliers(rec, [GROUP], "amount").select(GROUP, F.col("xx").alias("amount"))
    return rec.join(amounts, [GROUP, "amount"], "left_semi")


def _both_detectors(spark, sf_dir, rec):
    """Rows flagged by each of the two detectors; their staging jobs run side by side."""
    with ThreadPoolExecutor(2) as pool:
        surfaces, amounts = pool.submit(FX.rf, spark, sf_dir), pool.submit(_amount_outliers, rec)
        return surfaces.result(), amounts.result()


def q_detector_overlap(spark, sf_dir):
    rec = FX.records(spark, sf_dir)
    return RP.detector_overlap(rec, *_both_detectors(spark, sf_dir, rec), RECORD_ID)


def detector_labels(spark, sf_dir):
    from gapscan.operators.reshape import pivot_wide as pw
    rec = FX.records(spark, sf_dir)
    by_surface, by_amount = _both_detectors(spark, sf_dir, rec)
    wide = pw(by_surface, [RECORD_ID], "surface", "xx", SURFACES)
    return RP.detector_labels(rec, wide, by_amount, RECORD_ID, SURFACES)


QUERIES: dict[str, Query] = {
    "snap_grid": snap_grid,
    "prepare_records": q_prepare_records,
    "filter_range_or_null": filter_range_or_null,
    "drop_null_rows": q_drop_null_rows,
    "normalise_label": q_normalise_label,
    "boolean_filter": boolean_filter,
    "rows_containing": q_rows_containing,
    "select_like": q_select_like,
    "rename_by_index": q_rename_by_index,
    "scale_columns": q_scale_columns,
    "fixed_decimal_key": fixed_decimal_key,
    "surface_number": q_surface_number,
    "blank_zero": q_blank_zero,
    "row_count": row_count,
    "write_counters": write_counters,
    "restarted_write": restarted_write,
    "quarantine_rows": quarantine_rows,
    "csv_id_list": csv_id_list,
    "ordered_labels": ordered_labels,
    "approx_quartiles": approx_quartiles,
    "bucketed_export": bucketed_export,
    "box_lookup": box_lookup,
    "natural_merge": natural_merge,
    "job_export": job_export,
    "random_group": q_random_group,
    "composite_key": q_composite_key,
    "unpivot_surfaces": q_unpivot_surfaces,
    "pivot_wide": pivot_wide,
    "distinct_group_values": distinct_group_values,
    "group_size_guard": group_size_guard,
    "group_quartiles": group_quartiles,
    "lead_gap": lead_gap,
    "gap_scores": q_gap_scores,
    "gap_outliers": q_gap_outliers,
    "gap_outliers_by_doc": gap_outliers_by_doc,
    "gap_outliers_by_user": gap_outliers_by_user,
    "flag_union": flag_union,
    "make_grid": make_grid,
    "raster_cell_join": q_raster_cell_join,
    "grid_lookup_join": grid_lookup_join,
    "surface_outliers": q_surface_outliers,
    "flags_to_records": flags_to_records,
    "count_outlier_surfaces": q_count_outlier_surfaces,
    "export_wide": export_wide,
    "trusted_outliers": trusted_outliers,
    "left_outer_flags": q_left_outer_flags,
    "membership_flag": membership_flag,
    "semi_filter": q_semi_filter,
    "label_dim_join": label_dim_join,
    "cumulative_frequency": cumulative_frequency,
    "location_flag_count": q_location_flag_count,
    "bbox_padded": q_bbox_padded,
    "nth_group": nth_group,
    "top_sources": top_sources,
    "report_by_class": report_by_class,
    "report_hot_locations": report_hot_locations,
    "report_by_taxon": report_by_taxon,
    "report_by_surface": report_by_surface,
    "report_source_share": report_source_share,
    "report_uncertainty": report_uncertainty,
    "ids_json_per_source": ids_json_per_source,
    "detector_overlap": q_detector_overlap,
    "detector_labels": detector_labels,
    "surface_build": surface_build,
    "raster_rows": q_raster_rows,
}
