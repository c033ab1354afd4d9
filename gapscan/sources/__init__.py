"""Sources and sinks.

Every reader takes a declared schema where the format has none: inferring a
schema costs a pass over the data and can change a column's type from one
file to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The names and long names of the 19 bioclimatic surfaces, in
# the order the surface dimension lists them.
BIOCLIM_SURFACES = [
    ("bio1", "Annual Mean Temperature"),
    ("bio2", "Mean Diurnal Range"),
    ("bio3", "Isothermality (bio2/bio7) (×100)"),
    ("bio4", "Temperature Seasonality"),
    ("bio5", "Max Temperature of Warmest Month"),
    ("bio6", "Min Temperature of Coldest Month"),
    ("bio7", "Temperature Annual Range (bio5-bio6)"),
    ("bio8", "Mean Temperature of Wettest Quarter"),
    ("bio9", "Mean Temperature of Driest Quarter"),
    ("bio10", "Mean Temperature of Warmest Quarter"),
    ("bio11", "Mean Temperature of Coldest Quarter"),
    ("bio12", "Annual Precipitation"),
    ("bio13", "Precipitation of Wettest Month"),
    ("bio14", "Precipitation of Driest Month"),
    ("bio15", "Precipitation Seasonality"),
    ("bio16", "Precipitation of Wettest Quarter"),
    ("bio17", "Precipitation of Driest Quarter"),
    ("bio18", "Precipitation of Warmest Quarter"),
    ("bio19", "Precipitation of Coldest Quarter"),
]

# Record classes left out of the run, and the kingdom keys kept
# (animals, plants, fungi).
EXCLUDED_BASIS = ["FOSSIL_SPECIMEN", "UNKNOWN", "LIVING_SPECIMEN"]
KINGDOM_KEYS = [1, 6, 5]


def surface_schema(value_cols: Sequence[str] = tuple(n for n, _ in BIOCLIM_SURFACES),
                   lat: str = "decimallatitude", lon: str = "decimallongitude") -> T.StructType:
    """Schema of a surface table: two coordinates, then one double per surface."""
    fields = [T.StructField(lat, T.DoubleType()), T.StructField(lon, T.DoubleType())]
    fields += [T.StructField(c, T.DoubleType()) for c in value_cols]
    return T.StructType(fields)


def read_surfaces(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Tab-separated surface table with a header line, declared schema."""
    return (spark.read.schema(schema or surface_schema())
            .option("sep", "\t").option("header", "true").option("mode", "FAILFAST")
            .csv(path))


def read_records(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table (filters and projections given later reach its scan)."""
    return spark.table(table)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """S3: Parquet, one file or a multi-part folder."""
    return spark.read.parquet(*paths)


def read_records_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated record list with a header line."""
    return spark.read.schema(schema).option("header", "true").csv(path)


def surface_dim(spark: SparkSession, rows: Sequence[tuple[str, str]] = BIOCLIM_SURFACES) -> DataFrame:
    """The inline surface dimension (name, long name, number)."""
    data = [(name, long_name, i + 1) for i, (name, long_name) in enumerate(rows)]
    return spark.createDataFrame(data, "surface string, long_name string, surface_no int")


def write_export(df: DataFrame, path: str, mode: str = "errorifexists",
                 partition_by: Sequence[str] = ()) -> None:
    """Parquet sink; by default fails when the path exists, like the reference."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated sink with a header; nulls written as empty fields."""
    (df.write.mode(mode).option("sep", "\t").option("header", "true")
       .option("nullValue", "").option("emptyValue", "").csv(path))


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Cut the lineage of ``df``.

    With a path: write Parquet there (a shared folder; it must not exist) and read it back.
    Without: a reliable ``checkpoint()`` into the session's checkpoint folder
    (``spark.checkpoint.dir`` on a cluster). Both survive lost executors.
    """
    if path:
        df.write.mode("errorifexists").parquet(path)
        return df.sparkSession.read.parquet(path)
    return df.checkpoint(eager=True)
