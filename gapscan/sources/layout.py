"""Tables laid out for the reads to come: buckets, space-filling order, global order.

* ``write_bucketed`` (S4): records partitioned by a class and bucketed on (group,
  cell), so that distinct cells, and the join that brings flags back, read the
  buckets in place; a filter on the class, given or found at run time, skips
  folders. Buckets on the cell too, so a hot group is spread.
* ``write_by_cell`` (J1, J11, G2): a surface table in Morton order of its cells.
  Cells near each other lie together, so a box (A17) reads few row groups.
* ``write_ordered`` (O2, O6): sorted files from a range partitioning; the files
  in name order are the whole table in order, with no single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapscan.functions import morton


def write_bucketed(df: DataFrame, table: str, path: str, bucket_by: Sequence[str],
                   partition_by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Write the catalog table ``table`` at ``path`` and return its scan.

    Rows are dealt by the bucket columns first, so a partition has at most one
    file a bucket.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = df.repartition(n, *bucket_by).write.format("parquet").bucketBy(n, *bucket_by).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)
    return spark.table(table)


def write_by_cell(df: DataFrame, path: str, x: str, y: str, files: int | None = None,
                  row_group_bytes: int = 8 << 20) -> None:
    """Write ``df`` range-partitioned and sorted by the Morton key of its cell."""
    key = morton(F.col(x), F.col(y))
    parts = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    (parts.sortWithinPartitions(key).write.option("parquet.block.size", str(row_group_bytes))
          .mode("errorifexists").parquet(path))


def in_box(table: DataFrame, x: str, y: str, x_min, x_max, y_min, y_max) -> DataFrame:
    """Rows whose cell lies in a box, borders included. Plain comparisons, which
    the scan checks against the row groups' ranges."""
    return table.where(F.col(x).between(x_min, x_max) & F.col(y).between(y_min, y_max))


def write_ordered(df: DataFrame, path: str, order: Sequence[Column | str], files: int | None = None) -> None:
    """Write ``df`` in the given order over several files, numbered in order."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    parts = df.repartitionByRange(files, *cols) if files else df.repartitionByRange(*cols)
    parts.sortWithinPartitions(*cols).write.mode("errorifexists").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of an ordered table with their place in it (from 1): the rows of
    the files before, and the row's place in its file. The counts are one row a file."""
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    rows = spark.read.parquet(path).select("*", number.alias("_file"), F.col("_metadata.row_index").alias("_at"))
    before = F.sum("_rows").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
                   .select("_file", F.coalesce(before, F.lit(0)).alias("_before")))
    return (rows.join(F.broadcast(offsets), "_file")
                .withColumn(position, F.col("_before") + F.col("_at") + 1).drop("_file", "_at", "_before"))
