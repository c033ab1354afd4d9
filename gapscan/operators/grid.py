"""Grids, cell lookups and the surface-table build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscan.functions import fixed_decimal
from gapscan.operators.prepare import drop_null_rows, scale_columns
from gapscan.operators.reshape import unpivot_surfaces


def make_grid(spark: SparkSession, step: float, lat_min: float = -90.0, lat_max: float = 90.0,
              lon_min: float = -180.0, lon_max: float = 180.0,
              partitions: int | None = None) -> DataFrame:
    """G1: every grid point at ``step`` (both ends included).

    One ``range`` over all points, split into row and column by division, so
    the grid is generated in parallel with no join. Columns: ``row``, ``col``
    (integer indexes), ``lat``, ``lon``.
    """
    n_lat = int(round((lat_max - lat_min) / step)) + 1
    n_lon = int(round((lon_max - lon_min) / step)) + 1
    ids = spark.range(0, n_lat * n_lon, numPartitions=partitions) if partitions \
        else spark.range(0, n_lat * n_lon)
    return (ids.select((F.col("id") / n_lon).cast("long").alias("row"),
                       (F.col("id") % n_lon).alias("col"))
               .withColumn("lat", F.lit(lat_min) + F.col("row") * F.lit(step))
               .withColumn("lon", F.lit(lon_min) + F.col("col") * F.lit(step)))


def grid_over(df: DataFrame, x: str, y: str, step: float) -> DataFrame:
    """G1 over the extent of the data: every point at ``step`` from min to max of y, x.

    The extent is one aggregated row (four numbers) read on the driver; the
    grid itself is generated on the executors.
    """
    b = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"),
               F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    if b is None or b["x0"] is None:
        return make_grid(df.sparkSession, step, 0.0, -1.0, 0.0, -1.0)
    return make_grid(df.sparkSession, step, float(b["y0"]), float(b["y1"]),
                     float(b["x0"]), float(b["x1"]))


def point_cells(points: DataFrame, x: str, y: str, x0: float, y0: float,
                step_x: float, step_y: float, row: str = "cell_row",
                col: str = "cell_col", y_down: bool = True) -> DataFrame:
    """J11 (first half): the raster cell that holds each point.

    ``col = floor((x - x0) / step_x)``; ``row = floor((y0 - y) / step_y)`` for a
    raster whose rows run from the top edge ``y0`` down (``y_down``), else
    ``floor((y - y0) / step_y)``.
    """
    r = (F.lit(y0) - F.col(y)) if y_down else (F.col(y) - F.lit(y0))
    return (points.withColumn(col, F.floor((F.col(x) - F.lit(x0)) / F.lit(step_x)))
                  .withColumn(row, F.floor(r / F.lit(step_y))))


def raster_cell_join(points: DataFrame, cells: DataFrame, keys: Sequence[str] = ("cell_row", "cell_col"),
                     how: str = "inner") -> DataFrame:
    """J11 (second half): equi-join points to the cell table on the cell keys.

    Points outside every cell drop out with ``how='inner'``.
    """
    return points.join(cells, list(keys), how)


def build_surfaces(grid: DataFrame, cells: DataFrame, bands: Sequence[str],
                   keys: Sequence[str] = ("row", "col"), factor: float = 10.0) -> DataFrame:
    """Grid points with their cell's band values, scaled by 1/factor.

    Points without a value in every band (sea, no data) are dropped.
    """
    joined = raster_cell_join(grid, cells, keys)
    return drop_null_rows(scale_columns(joined, bands, factor), list(bands))


def surface_table(grid: DataFrame, cells: DataFrame, bands: Sequence[str], x0: float, y0: float,
                  step_x: float, step_y: float, y_down: bool = True, factor: float = 10.0,
                  x: str = "lon", y: str = "lat", digits: int = 1) -> DataFrame:
    """G2 from grid points to the written table: the raster cell that holds each
    point, its band values over ``factor``, points without a value dropped,
    coordinates as fixed-decimal text keys.

    ``cells`` holds cell_row, cell_col and the bands.
    """
    placed = point_cells(grid.select(y, x), x, y, x0, y0, step_x, step_y, y_down=y_down)
    built = build_surfaces(placed, cells, bands, ("cell_row", "cell_col"), factor)
    return built.select(fixed_decimal(y, digits).alias(y), fixed_decimal(x, digits).alias(x), *bands)


def raster_rows(cells: DataFrame, bands: Sequence[str], x0: float, y0: float, step_x: float,
                step_y: float, y_down: bool = True, row: str = "cell_row",
                col: str = "cell_col") -> DataFrame:
    """One row per cell and band: the centre of the cell (x, y), the band's
    name (surface) and its value (xx). Cells without a value drop out."""
    down = -1.0 if y_down else 1.0
    centred = cells.select((F.lit(x0) + (F.col(col) + 0.5) * F.lit(step_x)).alias("x"),
                           (F.lit(y0) + (F.col(row) + 0.5) * F.lit(down * step_y)).alias("y"), *bands)
    return unpivot_surfaces(centred, ["x", "y"], bands)


def grid_lookup(records: DataFrame, surfaces: DataFrame, cell_keys: Sequence[str]) -> DataFrame:
    """Records joined to the surface table on their snapped cell keys.

    Records off the surface (no cell) drop out. Catalyst/AQE choose broadcast
    or sort-merge from the measured size of the surface side.
    """
    return records.join(surfaces, list(cell_keys), "inner")
