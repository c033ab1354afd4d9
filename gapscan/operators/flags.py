"""The product: surface outliers, traced back to records, exported wide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapscan.operators.gap import gap_outliers
from gapscan.operators.keyfilter import filter_bits, key_filter, passing
from gapscan.operators.reshape import count_present, pivot_wide, unpivot_surfaces
from gapscan.operators.segments import materialize


def long_cells(records: DataFrame, surfaces: DataFrame, group: str, cell_keys: Sequence[str],
               surface_cols: Sequence[str], name: str = "surface", value: str = "xx",
               stage: bool = True, count: str | None = None) -> DataFrame:
    """Distinct (group, cell) joined to the surfaces, unpivoted.

    Reducing the records to distinct (group, cell) before the join is the main
    saving: records far outnumber the cells a group occupies. With ``stage``
    the joined (group, cell, surfaces) table is written once to the checkpoint
    folder, so the flag search and the later match of flags to cells neither
    scan the records nor join the surfaces again. With ``count`` the number of
    records of each (group, cell) is kept under that name.
    Columns: group, cell keys, (count,) surface, xx.
    """
    cells = records.select(group, *cell_keys).where(F.col(group).isNotNull())
    if count:
        cells = cells.groupBy(group, *cell_keys).agg(F.count(F.lit(1)).alias(count))
    else:
        cells = cells.distinct()
    joined = cells.join(surfaces.select(*cell_keys, *surface_cols), list(cell_keys), "inner")
    if stage:
        joined = materialize(joined)
    ids = [group, *cell_keys, *([count] if count else [])]
    return unpivot_surfaces(joined, ids, surface_cols, name, value)


def surface_outliers(records: DataFrame, surfaces: DataFrame, group: str,
                     cell_keys: Sequence[str], surface_cols: Sequence[str],
                     **gap_kw) -> DataFrame:
    """Gap outliers for every (group, surface) in one pass.

    Columns: group, surface, xx, outlier_type.
    """
    long = long_cells(records, surfaces, group, cell_keys, surface_cols)
    return gap_outliers(long, [group, "surface"], "xx", **gap_kw)


def flagged_cells(long: DataFrame, flags: DataFrame, group: str) -> DataFrame:
    """(group, cell keys, surface, xx) of every cell whose value is flagged.

    The double ``xx`` is compared exactly: both sides read it from the same
    column. Flags are few, so AQE broadcasts them.
    """
    return long.join(flags.select(group, "surface", "xx"), [group, "surface", "xx"])


def outlier_records(records: DataFrame, long: DataFrame, flags: DataFrame, record_id: str,
                    group: str, cell_keys: Sequence[str]) -> DataFrame:
    """Flagged (record, surface) rows.

    ``long`` holds (group, cell keys, surface, xx); flags hold (group, surface,
    xx). Flags are matched to cells first, and only the flagged cells are
    joined to the records.
    Columns: record_id, group, surface, xx.
    """
    fc = flagged_cells(long, flags, group)
    return (records.select(record_id, group, *cell_keys)
                   .join(fc, [group, *cell_keys])
                   .select(record_id, group, "surface", "xx"))


def export_flagged(records: DataFrame, long: DataFrame, flags: DataFrame, record_id: str,
                   group: str, cell_keys: Sequence[str], surface_values: Sequence[str],
                   name: str = "n_outliers") -> DataFrame:
    """X3 + X4: every flagged record, wide.

    The flagged cells are few; their wide form (one row per group and cell,
    one column per surface, and the count) is staged first and the records
    (every column) are joined to it once, in one scan. A Bloom filter of the
    flagged cells is applied in that scan, so only records that (almost
    certainly) are flagged reach the join's shuffle. Each row of ``records``
    is kept, so repeated record ids stay. Same result as
    ``outlier_export(records, outlier_records(...))``.
    """
    cell = [group, *cell_keys]
    wide = pivot_wide(flagged_cells(long, flags, group).select(*cell, "surface", "xx"),
                      cell, "surface", "xx", surface_values).withColumn(name, count_present(surface_values))
    return join_few(records, materialize(wide), cell).select(*records.columns, *surface_values, name)


def join_few(rows: DataFrame, few: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inner join of ``rows`` to the few keys of ``few`` (staged, so that it
    is computed once), with a Bloom filter of those keys in the scan of ``rows``.
    Keys of unlike types hash differently, so they are joined without it."""
    if all(rows.schema[c].dataType == few.schema[c].dataType for c in cols):
        bits = filter_bits(few.count())
        rows = passing(rows, key_filter(few, cols, bits), cols, bits)
    return rows.join(few, list(cols))


def count_outlier_surfaces(rf: DataFrame, record_id: str, name: str = "n_outliers") -> DataFrame:
    """Number of distinct flagged surfaces per record."""
    return rf.groupBy(record_id).agg(F.count_distinct("surface").alias(name))


def outlier_export(records: DataFrame, rf: DataFrame, record_id: str,
                   surface_values: Sequence[str], name: str = "n_outliers") -> DataFrame:
    """Record columns + one column per surface (flagged value or null) + count.

    One ``groupBy`` makes both the pivot and the count (a record has at most
    one value per surface, so the count of non-null pivot columns is the
    number of distinct flagged surfaces). The value list fixes the schema.
    Only flagged records survive the final join.
    """
    wide = pivot_wide(rf, [record_id], "surface", "xx", surface_values)
    wide = wide.withColumn(name, count_present(surface_values))
    return records.join(wide, record_id, "inner")


def trusted(export: DataFrame, k: int, name: str = "n_outliers") -> DataFrame:
    """Records flagged on at least ``k`` surfaces."""
    return export.where(F.col(name) >= k)


def left_outer_flags(records: DataFrame, flagged: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep every record, with the flag columns where present."""
    return records.join(flagged, list(on), "left")


def membership(df: DataFrame, ids: DataFrame, id_col: str | Sequence[str], out: str) -> DataFrame:
    """Add a boolean column: is the row's id (one or more columns) in ``ids``?

    Written as a left join to the distinct ids with a marker, which Catalyst
    runs as a broadcast or sort-merge join by size.
    """
    cols = [id_col] if isinstance(id_col, str) else list(id_col)
    marks = ids.select(*cols).distinct().withColumn("_hit", F.lit(True))
    return (df.join(marks, cols, "left")
              .withColumn(out, F.coalesce(F.col("_hit"), F.lit(False)))
              .drop("_hit"))


def semi_filter(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows whose id is in ``ids``. The distinct ids are staged, and a Bloom
    filter of them is applied in the scan of ``df``. (An inner join: the
    optimizer would move a semi join below the filter.)"""
    return join_few(df, materialize(ids.select(id_col).distinct()), [id_col]).select(*df.columns)


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Merge on every column name that both sides have, in ``left``'s order.

    Two missing keys are the same key. The result has the shared columns once,
    then the other columns of ``left`` and of ``right``; a row of ``right`` that
    an outer merge keeps alone shows its own keys. A name that one side has
    twice, or no shared name at all, is an error (a merge without keys would be
    a cross product).
    """
    for side, df in (("left", left), ("right", right)):
        twice = sorted({c for c in df.columns if df.columns.count(c) > 1})
        if twice:
            raise ValueError(f"the {side} side has several columns named {', '.join(twice)}")
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the two sides share no column name")
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown kind of merge: {how}")
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in shared})
    same = F.lit(True)
    for c in shared:
        same = same & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    first = {"right": lambda c: F.col(f"_right_{c}"), "full": lambda c: F.coalesce(F.col(c), F.col(f"_right_{c}"))}
    key = first.get(how, F.col)
    return left.join(other, same, how).select(
        *[key(c).alias(c) for c in shared], *[c for c in left.columns if c not in shared],
        *[c for c in right.columns if c not in shared])


def label_join(df: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Inner join to a dimension table (labels for surfaces and the like).

    A plain equi-join: a dimension of known small size is broadcast by the
    planner, any other by AQE when its measured size allows.
    """
    return df.join(dim, on, "inner")
