"""The whole outlier job, from an occurrence table and a surface TSV to the wide export.

The reference runs this as one batch: prepare the records, snap them to the
0.1 degree grid, look up the surfaces of each distinct (species, cell), flag
gap outliers per (species, surface), trace the flags back to the records and
write one wide row per flagged record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscan.functions import snap_cell
from gapscan.operators.flags import export_flagged, long_cells
from gapscan.operators.gap import gap_outliers
from gapscan.operators.grid import make_grid, surface_table
from gapscan.operators.prepare import prepare_records
from gapscan.operators.segments import drop_staged
from gapscan.sources import (BIOCLIM_SURFACES, EXCLUDED_BASIS, KINGDOM_KEYS, read_parquet, read_records,
                             read_surfaces, surface_schema, write_export, write_tsv)
from gapscan.staging import mark

# The columns of the occurrence table kept by the job, in the
# order the export lists them (the first is the record id).
RECORD_COLUMNS = [
    "gbifid", "datasetkey", "basisofrecord", "specieskey", "genuskey", "familykey", "orderkey",
    "phylumkey", "classkey", "kingdomkey", "species", "genus", "family", "phylum", "order_",
    "class", "kingdom", "decimallatitude", "decimallongitude", "rounded_decimallatitude",
    "rounded_decimallongitude", "coordinateuncertaintyinmeters",
]
CELL_KEYS = ["lat_cell", "lon_cell"]


def prepared_occurrences(occ: DataFrame) -> DataFrame:
    """X6 with the reference's rules, plus the integer cell keys used for joins."""
    out = prepare_records(
        occ, false_flags=["hasgeospatialissues"],
        exclude={"basisofrecord": EXCLUDED_BASIS}, include={"kingdomkey": KINGDOM_KEYS},
        not_null=["decimallatitude", "decimallongitude"],
        snap={"decimallatitude": ("lat_cell", "rounded_decimallatitude"),
              "decimallongitude": ("lon_cell", "rounded_decimallongitude")})
    return out.select(*RECORD_COLUMNS, *CELL_KEYS)


def keyed_surfaces(surfaces: DataFrame, lat: str = "decimallatitude",
                   lon: str = "decimallongitude") -> DataFrame:
    """The surface table keyed by the same integer cells as the records."""
    return (surfaces.withColumn("lat_cell", snap_cell(lat)).withColumn("lon_cell", snap_cell(lon))
                    .drop(lat, lon))


def outlier_job(occ: DataFrame, surfaces: DataFrame,
                surface_cols: Sequence[str] = tuple(n for n, _ in BIOCLIM_SURFACES),
                min_n: int = 10) -> DataFrame:
    """Records flagged on at least one surface: record columns, one column per
    surface (the flagged value or null) and ``n_bioclim_outliers``.

    The occurrence table is scanned twice: once for its distinct (species,
    cell) pairs (staged once, narrow), once to pick up the flagged records.
    """
    rec = prepared_occurrences(occ)
    surf = keyed_surfaces(surfaces)
    long = long_cells(rec, surf, "specieskey", CELL_KEYS, list(surface_cols))
    flags = gap_outliers(long, ["specieskey", "surface"], "xx", min_n=min_n)
    export = export_flagged(rec, long, flags, RECORD_COLUMNS[0], "specieskey", CELL_KEYS,
                            list(surface_cols), name="n_bioclim_outliers")
    return export.drop(*CELL_KEYS)


def run(spark: SparkSession, occurrence_table: str, surfaces_path: str, out_path: str,
        surface_cols: Sequence[str] = tuple(n for n, _ in BIOCLIM_SURFACES),
        mode: str = "errorifexists") -> int:
    """Read the catalog table and the surface TSV, run the job, write Parquet.

    Returns the number of exported rows, observed while writing (no second run).
    Nothing that was staged on the way is left behind; what the session had
    staged before stays.
    """
    from pyspark.sql import Observation
    before = mark(spark)
    occ = read_records(spark, occurrence_table)
    surfaces = read_surfaces(spark, surfaces_path, surface_schema(list(surface_cols)))
    obs = Observation("export")
    export = outlier_job(occ, surfaces, surface_cols).observe(obs, F.count(F.lit(1)).alias("rows"))
    try:
        write_export(export, out_path, mode=mode)
        return int(obs.get["rows"])
    finally:
        drop_staged(spark, before)


def build_surface_file(spark: SparkSession, cells_path: str, out_path: str,
                       bands: Sequence[str] = tuple(n for n, _ in BIOCLIM_SURFACES),
                       cell: float = 1 / 6, step: float = 0.1, factor: float = 10.0,
                       lat_min: float = -90.0, lat_max: float = 90.0,
                       lon_min: float = -180.0, lon_max: float = 180.0) -> None:
    """G2 as a job: the surface TSV that ``run`` reads, from a raster cell table.

    ``cells_path`` holds Parquet with cell_row, cell_col (from the upper left
    corner, cells of ``cell`` degrees) and the bands, stored times ``factor``.
    Grid points at ``step`` degrees take the values of their cell; points
    without a value (sea) are left out.
    """
    grid = make_grid(spark, step, lat_min, lat_max, lon_min, lon_max)
    table = surface_table(grid, read_parquet(spark, cells_path), bands, lon_min, lat_max, cell, cell,
                          factor=factor)
    write_tsv(table.withColumnsRenamed({"lat": "decimallatitude", "lon": "decimallongitude"}), out_path)


def main(argv: Sequence[str] | None = None) -> None:
    """Command line: ``python -m gapscan.plans.job TABLE SURFACES_TSV OUT [options]``.

    Uses the session of ``spark-submit`` (cluster settings, including the
    shared ``spark.checkpoint.dir``).
    """
    import argparse
    p = argparse.ArgumentParser(description="Flag gap outliers of records on numeric surfaces.")
    p.add_argument("table", help="catalog table of occurrence records")
    p.add_argument("surfaces", help="tab-separated surface table with a header line")
    p.add_argument("out", help="Parquet output path (must not exist unless --mode overwrite)")
    p.add_argument("--surfaces-list", default=",".join(n for n, _ in BIOCLIM_SURFACES),
                   help="comma-separated surface columns")
    p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite"])
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("gapscan-outliers").getOrCreate()
    rows = run(spark, a.table, a.surfaces, a.out, a.surfaces_list.split(","), a.mode)
    print(f"exported {rows} records")


if __name__ == "__main__":
    main()
