"""Cumulative-frequency profiles of flagged groups.

The reference profiles one group at a time; here every group is profiled at
once, with the group in the key of every aggregate and window.

Rows are aggregated by every column of the result before they meet the kept
keys, so a hot (group, surface) is spread by value and location up to the join,
and only the aggregated rows move. ``hits`` (default: the flagged rows
themselves) names the keys to keep; passing the flags there avoids a second
evaluation of the marked rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapscan.functions import blank_zero, surface_number
from gapscan.operators.flags import label_join, membership
from gapscan.operators.segments import materialize, running_sum


def flagged_long(long: DataFrame, rf: DataFrame, record_id: str, out: str = "is_outlier") -> DataFrame:
    """Mark each (record, surface) row of ``long`` that is a flagged outlier."""
    return membership(long, rf, [record_id, "surface"], out)


def flagged_cells_long(long: DataFrame, flags: DataFrame, group: str, out: str = "is_outlier") -> DataFrame:
    """Mark each (group, cell, surface) row of ``long`` whose value is flagged.

    The left join shuffles on (group, surface, value) at most, never on a group.
    """
    return membership(long, flags, [group, "surface", "xx"], out)


def keys_with_flags(df: DataFrame, keys: Sequence[str], flag: str = "is_outlier",
                    hits: DataFrame | None = None) -> DataFrame:
    """Keep the rows of keys where at least one row is flagged.

    A distinct (partial aggregation) and a semi join, rather than a window over
    the key, so a large key is never gathered in one task.
    """
    hit = (df.where(F.col(flag)) if hits is None else hits).select(*keys).distinct()
    return df.join(hit, list(keys), "left_semi")


def frequencies(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows (or the sum of ``weight``) per distinct combination of ``columns``."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*columns).agg(n.cast("long").alias("freq"))


def cumfreq_profile(df: DataFrame, keys: Sequence[str], value: str, location: Sequence[str],
                    flag: str = "is_outlier", weight: str | None = None,
                    hits: DataFrame | None = None) -> DataFrame:
    """Frequency per (keys, value, location, flag) and its running total per key.

    Rows of keys without any flag are left out. The running total is ordered by
    value, then location, then flag (false first), which makes every row's
    place unique.
    """
    keys = list(keys)
    order = [value, *location, flag]
    freq = keys_with_flags(frequencies(df, [*keys, *order], weight), keys, flag, hits)
    return running_sum(freq, keys, order, "freq", "cum_freq")


def labelled_profile(df: DataFrame, group: str, value: str, location: Sequence[str], dim: DataFrame,
                     prefix: str, weight: str | None = None, hits: DataFrame | None = None,
                     flag: str = "is_outlier") -> DataFrame:
    """X7 with its labels: the profile per (group, surface), the surface's number
    and long name ("s1-Quantity"), and the number of flagged surfaces at each
    row's location, also as a label that is empty for zero.

    The frequencies are written once; the running total and the counts per
    location both read them.
    """
    keys = [group, "surface"]
    order = [value, *location, flag]
    freq = materialize(keys_with_flags(frequencies(df, [*keys, *order], weight), keys, flag, hits))
    profile = label_join(running_sum(freq, keys, order, "freq", "cum_freq"), dim, "surface")
    at = _flags_at(freq, group, location, flag, "n_outliers")
    return (profile.withColumn("long_name", F.concat_ws("-", "surface", "long_name"))
                   .withColumn("surface_no", surface_number("surface", prefix))
                   .join(at, [group, *location])
                   .withColumn("n_label", blank_zero("n_outliers")))


def _flags_at(rows: DataFrame, group: str, location: Sequence[str], flag: str, name: str) -> DataFrame:
    return (rows.select(group, "surface", *location, flag).distinct()
                .groupBy(group, *location)
                .agg(F.sum(F.col(flag).cast("int")).cast("long").alias(name)))


def location_flag_count(df: DataFrame, group: str, location: Sequence[str],
                        flag: str = "is_outlier", name: str = "n_outliers",
                        hits: DataFrame | None = None) -> DataFrame:
    """Per (group, location), the number of surfaces flagged there."""
    rows = df.select(group, "surface", *location, flag).distinct()
    kept = keys_with_flags(rows, [group, "surface"], flag, hits)
    return (kept.groupBy(group, *location)
                .agg(F.sum(F.col(flag).cast("int")).cast("long").alias(name)))


def bbox_padded(df: DataFrame, keys: Sequence[str], x: str, y: str, pad: float,
                flag: str = "is_outlier") -> DataFrame:
    """Bounding box of each flagged key's points, padded by ``pad``.

    One aggregation, partial before its shuffle: the box and whether any row
    of the key is flagged.
    """
    box = df.groupBy(*keys).agg((F.min(x) - pad).alias("x_min"), (F.max(x) + pad).alias("x_max"),
                                (F.min(y) - pad).alias("y_min"), (F.max(y) + pad).alias("y_max"),
                                F.bool_or(flag).alias("_any"))
    return box.where("_any").drop("_any")
