"""Reports on flagged records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapscan.operators.flags import count_outlier_surfaces, membership
from gapscan.operators.segments import with_positions


# Ids per page of ``ids_json_pages``.
PAGE = 100


def flagged_records(records: DataFrame, rf: DataFrame, record_id: str, k: int = 1) -> DataFrame:
    """Records flagged on at least ``k`` surfaces (each record once)."""
    ids = rf.select(record_id).distinct() if k <= 1 else \
        count_outlier_surfaces(rf, record_id, "_k").where(F.col("_k") >= k).select(record_id)
    return records.join(ids, record_id, "left_semi")


def count_by(records: DataFrame, by: Sequence[str], distinct_on: Sequence[str],
             name: str = "n") -> DataFrame:
    """Number of distinct combinations of ``distinct_on`` per ``by``.

    ``distinct_on`` says what is counted: the record id for records, (group,
    location) for places a group was seen at, (group,) for groups. Distinct
    first, then a grouped count; both aggregate partially before their shuffle.
    """
    cols = list(dict.fromkeys([*by, *distinct_on]))
    return records.select(*cols).distinct().groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def hot_locations(flagged: DataFrame, location: Sequence[str], group: str,
                  min_count: int, name: str = "n") -> DataFrame:
    """A11 by location: locations where at least ``min_count`` groups have flagged records."""
    return count_by(flagged, location, [group], name).where(F.col(name) >= min_count)


def source_share(records: DataFrame, rf: DataFrame, source: str, record_id: str,
                 min_flagged: int = 100, digits: int = 6, k: int = 1) -> DataFrame:
    """Records flagged on at least ``k`` surfaces per source, the source's
    total, and the share.

    Kept when the flagged count is above ``min_flagged``.
    """
    totals = records.groupBy(source).agg(F.count(F.lit(1)).alias("n_total"))
    flagged = count_by(flagged_records(records, rf, record_id, k), [source], [record_id], "n_flagged")
    return (flagged.where(F.col("n_flagged") > min_flagged)
                   .join(totals, source)
                   .withColumn("share", F.round(F.try_divide(F.col("n_flagged"), F.col("n_total")), digits)))


def mean_by_flag_count(export: DataFrame, distinct_on: Sequence[str], value: str,
                       n_col: str = "n_outliers", digits: int = 6) -> DataFrame:
    """Mean of ``value`` per number of flagged surfaces, over the distinct
    combinations of ``distinct_on``, the value and the number (nulls out)."""
    rows = export.select(*distinct_on, n_col, value).where(F.col(value).isNotNull()).distinct()
    return rows.groupBy(n_col).agg(F.round(F.avg(value), digits).alias("mean_value"),
                                   F.count(F.lit(1)).alias("n_records"))


def ids_json_pages(flagged: DataFrame, source: str, record_id: str,
                   page_size: int = PAGE) -> DataFrame:
    """The flagged ids of each source as JSON array text, in pages.

    A source may hold a large share of all flagged records, so its ids are
    cut into pages of at most ``page_size`` ids (in id order) and each page is
    one row: no single row or task ever holds a whole source.
    Columns: source, page (0-based), n_ids, ids_json.
    """
    ids = flagged.select(source, record_id).distinct()
    ranked = with_positions(ids, [source], [record_id], "_pos", "_n")
    paged = ranked.withColumn("page", ((F.col("_pos") - 1) / page_size).cast("long"))
    return (paged.groupBy(source, "page")
                 .agg(F.count(F.lit(1)).alias("n_ids"),
                      F.to_json(F.sort_array(F.collect_list(record_id))).alias("ids_json")))


def nth_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """O3: the n-th smallest distinct key (deterministic; empty if fewer than n).

    A top-n by key (bounded by n rows per task), then its largest element.
    """
    first_n = df.select(key).distinct().orderBy(key).limit(n)
    counted = first_n.agg(F.count(F.lit(1)).alias("_k"), F.max(key).alias(key))
    return counted.where(F.col("_k") == n).select(key)


def top_by_count(df: DataFrame, key: str, record_id: str, n: int, name: str = "n") -> DataFrame:
    """Keys by number of distinct records, largest first, ties by key; first n."""
    return count_by(df, [key], [record_id], name).orderBy(F.desc(name), F.asc(key)).limit(n)


def random_group(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """One group picked at random but reproducibly (hash of key and seed)."""
    return (df.select(key).distinct()
              .orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)).limit(1))


def label_group(records: DataFrame, flagged: DataFrame, record_id: str,
                where: Column | None = None, out: str = "is_flagged") -> DataFrame:
    """Records picked by ``where`` (class, year, group, ...), labelled yes/no
    by whether the detector flagged them."""
    picked = records.where(where) if where is not None else records
    return membership(picked, flagged, record_id, out)


def detector_labels(records: DataFrame, a_rows: DataFrame, b_rows: DataFrame, record_id: str,
                    values: Sequence[str] = (), a: str = "in_a", b: str = "in_b",
                    both: str = "in_both") -> DataFrame:
    """Every record, marked by detector a, by b and by both.

    ``values`` are columns of ``a_rows`` (its flagged values) carried along.
    The ids of both detectors are tagged and aggregated first, so the records
    meet them in a single join.
    """
    a_side = a_rows.select(record_id, *values, F.lit(True).alias(a), F.lit(False).alias(b))
    b_side = b_rows.select(record_id, F.lit(False).alias(a), F.lit(True).alias(b))
    tags = (a_side.unionByName(b_side, allowMissingColumns=True).groupBy(record_id)
                  .agg(*[F.max(v).alias(v) for v in values],
                       F.bool_or(a).alias(a), F.bool_or(b).alias(b)))
    none = F.lit(False)
    return (records.join(tags, record_id, "left")
                   .withColumns({a: F.coalesce(F.col(a), none), b: F.coalesce(F.col(b), none)})
                   .withColumn(both, F.col(a) & F.col(b)))


def detector_overlap(records: DataFrame, a_ids: DataFrame, b_ids: DataFrame, record_id: str,
                     a: str = "in_a", b: str = "in_b") -> DataFrame:
    """Records flagged by detector a, by b, by both: a frequency table."""
    marked = detector_labels(records.select(record_id), a_ids, b_ids, record_id, a=a, b=b)
    return marked.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
