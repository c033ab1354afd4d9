"""Wide <-> long reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_surfaces(df: DataFrame, ids: Sequence[str], surfaces: Sequence[str],
                     name: str = "surface", value: str = "xx",
                     drop_nulls: bool = True) -> DataFrame:
    """One row per (ids, surface) with the surface's value.

    ``unpivot`` widens mixed numeric columns to one type; no padding rows.
    """
    long = df.unpivot(list(ids), list(surfaces), name, value)
    return long.where(F.col(value).isNotNull()) if drop_nulls else long


def pivot_wide(df: DataFrame, index: Sequence[str], name: str, value: str,
               values: Sequence[str]) -> DataFrame:
    """Long -> wide with a fixed value list (stable schema, no extra job).

    Written as one conditional aggregation per value, so the whole pivot is a
    single grouped aggregation (one shuffle, partial aggregation before it);
    the ``pivot`` API plans two. There is one value per (index, name) here, so
    taking the maximum is the reference's ``first``.
    """
    return df.groupBy(*index).agg(*[F.max(F.when(F.col(name) == F.lit(v), F.col(value))).alias(v)
                                    for v in values])


def count_present(columns: Sequence[str]):
    """Number of non-null columns among ``columns`` (as a long column)."""
    total = F.lit(0)
    for c in columns:
        total = total + F.col(c).isNotNull().cast("int")
    return total.cast("long")
