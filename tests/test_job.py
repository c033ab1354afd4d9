"""The whole job on a small occurrence table and surface TSV (reference schemas)."""

import os
import tempfile

from pyspark.sql import functions as F

from gapscan.plans import job as J
from gapscan.sources import surface_schema, write_tsv

OCC_SCHEMA = ("gbifid long, datasetkey string, basisofrecord string, specieskey int, genuskey int, "
              "familykey int, orderkey int, phylumkey int, classkey int, kingdomkey int, species string, "
              "genus string, family string, phylum string, order_ string, class string, kingdom string, "
              "decimallatitude double, decimallongitude double, coordinateuncertaintyinmeters double, "
              "hasgeospatialissues boolean")


def _occ_row(i, sp, lat, lon, basis="HUMAN_OBSERVATION", kingdom=1, issue=False):
    return (i, "ds", basis, sp, 1, 1, 1, 1, 1, kingdom, f"sp{sp}", "g", "f", "p", "o", "c", "k",
            lat, lon, 10.0, issue)


def test_outlier_job_end_to_end(spark):
    # Surface cells along latitude 0.0 .. 2.9; bio1 grows by 1 per cell, except one hot cell.
    cells = [(round(k / 10, 1), 5.0, float(k), 7.0) for k in range(30)]
    cells[29] = (2.9, 5.0, 500.0, 7.0)
    d = tempfile.mkdtemp(prefix="gapscan-job-", dir="/tmp")
    tsv = os.path.join(d, "bioclim.tsv")
    surf = spark.createDataFrame(cells, "decimallatitude double, decimallongitude double, bio1 double, bio2 double")
    write_tsv(surf, tsv)
    rows = []
    i = 0
    for k in range(30):
        for _ in range(3):  # three records per cell, with jitter inside the cell
            i += 1
            rows.append(_occ_row(i, 7, k / 10 + 0.01 * (i % 3), 5.02))
    rows.append(_occ_row(1000, 7, 2.9, 5.0, basis="FOSSIL_SPECIMEN"))   # excluded
    rows.append(_occ_row(1001, 7, 2.9, 5.0, issue=True))                # excluded
    rows.append(_occ_row(1002, 7, 2.9, 5.0, kingdom=2))                 # excluded
    rows.append(_occ_row(1003, 8, 40.0, 5.0))                           # off the surface
    occ = spark.createDataFrame(rows, OCC_SCHEMA)
    surfaces = J.read_surfaces(spark, tsv, surface_schema(["bio1", "bio2"]))
    out = J.outlier_job(occ, surfaces, ["bio1", "bio2"]).collect()
    ids = sorted(r.gbifid for r in out)
    # cells 28 and 29 are flagged upper on bio1 (left end of the gap and the outlier)
    assert ids == list(range(28 * 3 + 1, 30 * 3 + 1))
    assert all(r.n_bioclim_outliers == 1 and r.bio2 is None for r in out)
    assert {r.bio1 for r in out} == {28.0, 500.0}
    assert out[0].rounded_decimallatitude in (2.8, 2.9)

    # run(): catalog table in, Parquet out
    occ.createOrReplaceTempView("occurrence_test")
    path = os.path.join(d, "export.parquet")
    assert J.run(spark, "occurrence_test", tsv, path, ["bio1", "bio2"]) == 6
    assert spark.read.parquet(path).count() == 6
    # the command line does the same, with real arguments
    cli_out = os.path.join(d, "cli.parquet")
    J.main(["occurrence_test", tsv, cli_out, "--surfaces-list", "bio1,bio2"])
    assert spark.read.parquet(cli_out).count() == 6
    assert spark.read.parquet(path).where(F.col("n_bioclim_outliers") > 0).count() == 6


def test_surface_file_from_raster_cells(spark):
    d = tempfile.mkdtemp(prefix="gapscan-surfaces-", dir="/tmp")
    cells = spark.createDataFrame([(0, 0, 125.0, -30.0), (0, 1, 60.0, None)],
                                  "cell_row long, cell_col long, bio1 double, bio2 double")
    cells.write.parquet(os.path.join(d, "cells"))
    out = os.path.join(d, "bioclim.tsv")
    J.build_surface_file(spark, os.path.join(d, "cells"), out, ["bio1", "bio2"], cell=0.25,
                         lat_min=0.5, lat_max=1.0, lon_min=0.0, lon_max=0.5)
    text = sorted(tuple(r) for r in spark.read.option("header", "true").option("sep", "\t").csv(out).collect())
    # points at 0.0, 0.1, 0.2 (right) and 1.0, 0.9, 0.8 (down) lie in the only cell with both values
    assert text == sorted((lat, lon, "12.5", "-3.0") for lat in ("1.0", "0.9", "0.8") for lon in ("0.0", "0.1", "0.2"))
    read = J.read_surfaces(spark, out, surface_schema(["bio1", "bio2"]))
    assert read.count() == 9


def test_run_leaves_nothing_staged(spark):
    from gapscan.operators.segments import STAGED_PREFIX
    J.drop_staged(spark)
    before = {t.name for t in spark.catalog.listTables() if t.name.startswith(STAGED_PREFIX)}
    d = tempfile.mkdtemp(prefix="gapscan-job-", dir="/tmp")
    surf = spark.createDataFrame([(round(k / 10, 1), 5.0, float(k)) for k in range(12)],
                                 "decimallatitude double, decimallongitude double, bio1 double")
    write_tsv(surf, os.path.join(d, "s.tsv"))
    spark.createDataFrame([_occ_row(i, 7, i / 10, 5.0) for i in range(12)], OCC_SCHEMA) \
        .createOrReplaceTempView("occurrence_small")
    J.run(spark, "occurrence_small", os.path.join(d, "s.tsv"), os.path.join(d, "out"), ["bio1"])
    assert {t.name for t in spark.catalog.listTables() if t.name.startswith(STAGED_PREFIX)} == before
    assert J.drop_staged(spark) == 0
