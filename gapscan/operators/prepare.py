"""Record preparation and row filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapscan.functions import snap_cell, snap_value


def prepare_records(df: DataFrame, *, false_flags: Sequence[str] = (),
                    exclude: Mapping[str, Sequence] | None = None,
                    include: Mapping[str, Sequence] | None = None,
                    not_null: Sequence[str] = (),
                    snap: Mapping[str, tuple[str, str]] | None = None,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Filters first, then the snapped cells, then the projection.

    * ``false_flags``: boolean columns that must be false (null rejected);
    * ``exclude``: column -> values to drop (null rejected, like ``!=``);
    * ``include``: column -> values to keep;
    * ``not_null``: columns that must be present;
    * ``snap``: source column -> (cell key column, snapped value column);
    * ``columns``: final projection (default: all).

    The filters are plain predicates on source columns, so Catalyst pushes the
    supported ones into the Parquet scan.
    """
    out = df
    for c in false_flags:
        out = out.where(~F.col(c))
    for c, values in (exclude or {}).items():
        out = out.where(~F.col(c).isin(list(values)))
    for c, values in (include or {}).items():
        out = out.where(F.col(c).isin(list(values)))
    for c in not_null:
        out = out.where(F.col(c).isNotNull())
    for src, (cell, shown) in (snap or {}).items():
        out = out.withColumn(cell, snap_cell(src)).withColumn(shown, snap_value(src))
    if columns is not None:
        out = out.select(*columns)
    return out


def range_or_null(df: DataFrame, col: str, upper: float) -> DataFrame:
    """Keep rows with ``col < upper`` or ``col`` missing."""
    return df.where((F.col(col) < upper) | F.col(col).isNull())


def rows_containing(df: DataFrame, col: str, text: str) -> DataFrame:
    """Keep rows whose text column contains ``text`` (e.g. surface names with "bio")."""
    return df.where(F.col(col).contains(text))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any null in ``columns`` (default: all columns)."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def scale_columns(df: DataFrame, columns: Sequence[str], factor: float) -> DataFrame:
    """Divide the given numeric columns by ``factor``, keep the others."""
    cols = set(columns)
    return df.select(*[(F.col(c) / F.lit(factor)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def select_like(df: DataFrame, contains: Sequence[str] = (), startswith: Sequence[str] = (),
                minus: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Select columns by name pattern, minus a list, plus named ones first."""
    picked = [c for c in df.columns
              if (any(s in c for s in contains) or any(c.startswith(s) for s in startswith))
              and c not in minus and c not in keep]
    return df.select(*keep, *picked)


def rename_by_index(df: DataFrame, old_prefix: str, new_prefix: str, n: int) -> DataFrame:
    """Rename ``old1..oldn`` to ``new1..newn`` (missing ones ignored)."""
    mapping = {f"{old_prefix}{i}": f"{new_prefix}{i}" for i in range(1, n + 1)
               if f"{old_prefix}{i}" in df.columns}
    return df.withColumnsRenamed(mapping)
