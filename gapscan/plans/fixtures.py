"""Inputs of the driver queries, derived from the test tables with Spark.

* ``records``: one record per order (id, class, source, amount, two integer
  location cells); its group is a block of four customers, so a group has
  enough cells to be scored and several records at some of them;
* ``surf``: a surface table keyed by location cell with four integer-valued
  surfaces from the line items of the orders there;
* ``long``: distinct (group, cell) joined to ``surf``, unpivoted, with the
  number of records at each;
* ``flags``: gap outliers per (group, surface) of ``long``;
* ``rf``: flagged (record, surface) rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapscan.operators.flags import export_flagged, long_cells, outlier_records
from gapscan.operators.gap import gap_outliers

SURFACES = ["s1", "s2", "s3", "s4"]
RECORD_ID = "record_id"
GROUP = "group_key"
CELL = ["x_cell", "y_cell"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("record_id"),
        F.expr("o_custkey div 4").alias("group_key"),
        F.col("o_orderstatus").alias("record_class"),
        F.col("o_orderpriority").alias("source_key"),
        F.col("o_totalprice").alias("amount"),
        F.round(F.col("o_totalprice") / 10000).cast("int").alias("x_cell"),
        F.month("o_orderdate").cast("int").alias("y_cell"),
    )


def surf(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cells = records(spark, sf_dir).select(F.col(RECORD_ID).alias("l_orderkey"), *CELL)
    return li.join(cells, "l_orderkey").groupBy(*CELL).agg(
        F.sum(F.col("l_quantity").cast("long")).cast("double").alias("s1"),
        F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).cast("double").alias("s2"),
        F.sum(F.round(F.col("l_discount") * 100).cast("long")).cast("double").alias("s3"),
        F.count(F.lit(1)).cast("double").alias("s4"),
    )


def long(spark: SparkSession, sf_dir: str, stage: bool = True) -> DataFrame:
    """(group_key, x_cell, y_cell, n_records, surface, xx): the surface values of every occupied cell."""
    return long_cells(records(spark, sf_dir), surf(spark, sf_dir), GROUP, CELL, SURFACES,
                      stage=stage, count="n_records")


def flagged(spark: SparkSession, sf_dir: str):
    """(records, long, flags) built once, for queries that need several of them."""
    lg = long(spark, sf_dir)
    return records(spark, sf_dir), lg, gap_outliers(lg, [GROUP, "surface"], "xx")


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged(spark, sf_dir)[2]


def rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged (record_id, group_key, surface, xx)."""
    rec, lg, fl = flagged(spark, sf_dir)
    return outlier_records(rec, lg, fl, RECORD_ID, GROUP, CELL)


def export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged records, wide, from one more scan of the records."""
    rec, lg, fl = flagged(spark, sf_dir)
    return export_flagged(rec, lg, fl, RECORD_ID, GROUP, CELL, SURFACES)
