"""Ordered work per key without putting an unbounded key into one task.

A window ``partitionBy(keys).orderBy(...)`` sends a whole key to one task; a
key that holds a third of the rows would then run on one core. Each helper
therefore range-partitions on (keys, order columns), so a hot key is cut into
several segments of bounded size, whatever the table's size. The ordered step
runs in a window over (segment, keys) and is written once (``materialize``);
what crosses segment borders (offsets, the next segment's first row) comes
from a segment table with at most one row per (range partition, key), combined
with a window over keys on that table, and is joined back on (segment, keys).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscan.staging import release, stage, staging_path

SEG = "_seg"


STAGED_PREFIX = "gapscan_staged_"

def materialize(df: DataFrame, bucket_by: Sequence[str] | None = None,
                buckets: int | None = None) -> DataFrame:
    """Compute ``df`` once, for every later use: a Parquet table in the shared folder.

    The segment number comes from sampled range bounds. Rows and the segment
    tables built from them must agree on it, so they have to come from one
    execution of the range shuffle; two separate executions could sample
    different bounds. Writing the rows once fixes that, lets later branches
    read columnar files instead of recomputing the window, and survives lost
    executors. The files go under the session's checkpoint folder
    (``spark.checkpoint.dir``, shared on a cluster).

    With ``bucket_by`` the table is bucketed on those columns (as many buckets
    as shuffle partitions): joins and aggregates on them then read the table
    without any exchange of the large side — only the small segment tables
    move. ``drop_staged`` removes such tables.
    """
    if not bucket_by:
        return stage(df, "segments")
    spark = df.sparkSession
    name, path = staged_table(spark, "bucketed")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(n, *bucket_by).option("path", path).saveAsTable(name)
    return spark.table(name)


def staged_table(spark, label: str) -> tuple[str, str]:
    """Name and path of a new staged catalog table."""
    name = STAGED_PREFIX + uuid.uuid4().hex
    return name, staging_path(spark, label, name)


def drop_staged(spark, since: int | None = None) -> int:
    """Delete all that this process staged in this application (no other
    session's), or with ``since`` (``staging.mark``) what this thread staged
    after it. Returns how many folders."""
    return release(spark, since)


def tag_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 partitions: int | None = None) -> DataFrame:
    """Range partition on (keys, order) and add the segment number ``_seg``.

    Range bounds are sampled once and stored with the shuffle, so rows land in
    the same segment when a lost task is run again.
    """
    cols = [*keys, *order]
    parted = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return parted.withColumn(SEG, F.spark_partition_id())


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def with_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   pos: str = "pos", size: str = "n", partitions: int | None = None) -> DataFrame:
    """Add the 1-based position of each row in its key (by ``order``) and the key size.

    ``order`` must make rows unique within a key for the result to be stable.
    """
    keys = list(keys)
    seg_keys = [SEG, *keys]
    s = tag_segments(df, keys, order, partitions)
    w_in = Window.partitionBy(*seg_keys).orderBy(*_order_cols(order))
    local = materialize(s.withColumn("_rn", F.row_number().over(w_in)), seg_keys)
    w_key = Window.partitionBy(*keys)
    seg = (local.groupBy(*seg_keys).agg(F.count(F.lit(1)).alias("_cnt"))
            .withColumn(size, F.sum("_cnt").over(w_key))
            .withColumn("_off", F.coalesce(
                F.sum("_cnt").over(w_key.orderBy(SEG)
                                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .select(*seg_keys, size, "_off"))
    return (local.join(seg, seg_keys)
                 .withColumn(pos, (F.col("_off") + F.col("_rn")).cast("long"))
                 .drop("_rn", "_off", SEG))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                out: str, partitions: int | None = None) -> DataFrame:
    """Running total of ``value`` per key in ``order`` (rows unbounded preceding .. current).
    """
    keys = list(keys)
    seg_keys = [SEG, *keys]
    s = tag_segments(df, keys, order, partitions)
    w_in = (Window.partitionBy(*seg_keys).orderBy(*_order_cols(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = materialize(s.withColumn("_loc", F.sum(value).over(w_in)), seg_keys)
    w_key = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    seg = (local.groupBy(*seg_keys).agg(F.sum(value).alias("_ssum"))
            .withColumn("_soff", F.coalesce(F.sum("_ssum").over(w_key), F.lit(0)))
            .select(*seg_keys, "_soff"))
    return (local.join(seg, seg_keys)
                 .withColumn(out, F.col("_loc") + F.col("_soff"))
                 .drop("_loc", "_soff", SEG))


def with_next(df: DataFrame, keys: Sequence[str], value: str, out: str = "x1",
              partitions: int | None = None) -> DataFrame:
    """Next larger value of ``value`` within its key (null for the last).

    Rows should be distinct on (keys, value).
    """
    keys = list(keys)
    seg_keys = [SEG, *keys]
    s = tag_segments(df, keys, [value], partitions)
    w_in = Window.partitionBy(*seg_keys).orderBy(value)
    local = materialize(s.withColumn("_nx", F.lead(value).over(w_in)), seg_keys)
    w_ord = Window.partitionBy(*keys).orderBy(SEG)
    seg = (local.groupBy(*seg_keys).agg(F.min(value).alias("_first"))
            .withColumn("_next", F.lead("_first").over(w_ord))
            .select(*seg_keys, "_next"))
    return (local.join(seg, seg_keys)
                 .withColumn(out, F.coalesce("_nx", "_next"))
                 .drop("_nx", "_next", SEG))


def quantiles_disc(df: DataFrame, keys: Sequence[str], value: str,
                   probs: dict[str, float], partitions: int | None = None) -> DataFrame:
    """Exact discrete quantiles per key over the rows of ``df``.

    The value at position ceil(p * n) of the key's sorted rows, for each
    ``name -> p`` in ``probs``. Rows should be distinct on (keys, value).
    """
    keys = list(keys)
    ranked = with_positions(df.select(*keys, value), keys, [value], "_p", "_n", partitions)

    def place(p: float) -> Column:
        """ceil(p * n) in integers: p as it is written, not its nearest double."""
        share = Fraction(str(p))
        return F.expr(f"(_n * {share.numerator}L + {share.denominator - 1}L) div {share.denominator}L")
    aggs = [F.max(F.when(F.col("_p") == place(p), F.col(value))).alias(name) for name, p in probs.items()]
    return ranked.groupBy(*keys).agg(F.max("_n").alias("n"), *aggs)
