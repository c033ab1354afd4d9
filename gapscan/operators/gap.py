"""Gap outliers per key — the core operator.

For every key, over its distinct values (null and NaN are none) x1 < ... < xn:

1. keys with n < ``min_n`` are dropped;
2. mx = mean, t1 = coef * sqrt(n) + offset;
3. for i < n: y_i = gap_i * (mx - x_i) if x_i < mx else gap_i * (x_{i+1} - mx),
   with gap_i = x_{i+1} - x_i; y_n is null;
4. z = y / stddev_pop(y)   (not centred; zero deviation gives null);
5. v = x_i where z > t1 (the left end of a significant gap);
6. med = lower median (the value at position ceil(n/2));
7. hi = max v above med, lo = min v below med;
8. upper if x >= hi, lower if x <= lo.

Plan. The large side is only ever shuffled on (keys, value) or on
(segment, keys), and every key takes the same path whatever its size:

- the distinct values are range-partitioned on (keys, value), which cuts a hot
  key into *segments*, one per range partition, each bounded by the partition
  size; the next value and the row number run in a window over (segment,
  keys), and the rows are staged once;
- everything that needs the whole key comes from small *segment tables* — at
  most one row per (range partition, key) — combined with windows over the key
  on those tables and joined back on (segment, keys):
  round 1: n, mean, offsets, the next segment's first value;
  round 2: the population deviation of y, from per-segment (count, mean, M2)
  merged with the pairwise formula of Chan et al.;
  round 3: the median position and the outermost significant gaps, from a
  grouped aggregate (partial aggregation) spread to the key's segments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapscan.operators.segments import SEG, materialize, tag_segments


def _gap_score(x: Column, x1: Column, mx: Column) -> Column:
    """y for the gap from x to its successor x1 (null when x1 is null)."""
    gap = x1 - x
    return F.when(x < mx, gap * (mx - x)).otherwise(gap * (x1 - mx))


def _distinct_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values per key; null and NaN are no values."""
    x = F.col(value).cast("double")
    cond = x.isNotNull() & ~F.isnan(x)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond).select(*keys, x.alias("xx")).distinct()


def _scored_segments(d: DataFrame, keys: Sequence[str], min_n: int,
                     coef: float, offset: float, partitions: int | None):
    """Segmented plan. Scored rows (segment, keys, xx, n, mx, x1, y, z, t1,
    _pos, _mid) and the keys' segment list, for keys with n >= min_n."""
    keys = list(keys)
    seg_keys = [SEG, *keys]
    s = tag_segments(d, keys, ["xx"], partitions)
    w_in = Window.partitionBy(*seg_keys).orderBy("xx")
    rows = materialize(s.withColumn("_nx", F.lead("xx").over(w_in))
                        .withColumn("_rn", F.row_number().over(w_in)), seg_keys)

    w_ord = Window.partitionBy(*keys).orderBy(SEG)
    w_key = Window.partitionBy(*keys)
    # Round 1: n, mean, offsets and the next segment's first value.
    seg1 = (rows.groupBy(*seg_keys)
                .agg(F.count(F.lit(1)).alias("_cnt"), F.sum("xx").alias("_sx"),
                     F.min("xx").alias("_first"))
                .withColumn("n", F.sum("_cnt").over(w_key))
                .where(F.col("n") >= min_n)
                .withColumn("mx", F.sum("_sx").over(w_key) / F.col("n"))
                .withColumn("_off", F.coalesce(
                    F.sum("_cnt").over(w_ord.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                .withColumn("_next", F.lead("_first").over(w_ord))
                .select(*seg_keys, "n", "mx", "_off", "_next"))
    r1 = (rows.join(seg1, seg_keys)
              .withColumn("x1", F.coalesce("_nx", "_next"))
              .withColumn("y", _gap_score(F.col("xx"), F.col("x1"), F.col("mx")))
              .withColumn("_pos", F.col("_off") + F.col("_rn"))
              .select(*seg_keys, "xx", "n", "mx", "x1", "y", "_pos"))

    # Round 2: population deviation of y, merged across the key's segments.
    seg2 = (r1.groupBy(*seg_keys)
              .agg(F.count("y").cast("double").alias("_c"),
                   F.coalesce(F.avg("y"), F.lit(0.0)).alias("_m"),
                   F.coalesce(F.var_pop("y") * F.count("y"), F.lit(0.0)).alias("_m2"))
              .withColumn("_kc", F.sum("_c").over(w_key))
              .withColumn("_ks", F.sum(F.col("_c") * F.col("_m")).over(w_key))
              .withColumn("_km", F.when(F.col("_kc") > 0, F.col("_ks") / F.col("_kc")))
              .withColumn("_km2", F.sum(F.col("_m2") + F.col("_c")
                                        * F.pow(F.col("_m") - F.col("_km"), 2)).over(w_key))
              .withColumn("_sd", F.when(F.col("_kc") > 0, F.sqrt(F.col("_km2") / F.col("_kc"))))
              .select(*seg_keys, "_sd"))
    r2 = (r1.join(seg2, seg_keys)
            .withColumn("z", F.try_divide(F.col("y"), F.col("_sd")))
            .withColumn("t1", F.lit(coef) * F.sqrt(F.col("n")) + F.lit(offset))
            .withColumn("_mid", F.floor((F.col("n") + 1) / 2))
            .drop("_sd"))
    return r2, seg1.select(*seg_keys)


def _bounds(r: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: lower median and the outermost significant gap on each side.

    Values are distinct, so "v above the median" is "position above mid".
    A grouped aggregate: partial aggregation collapses a hot key before the
    shuffle.
    """
    sig = F.col("z") > F.col("t1")
    return r.groupBy(*keys).agg(
        F.max(F.when(sig & (F.col("_pos") > F.col("_mid")), F.col("xx"))).alias("hi"),
        F.min(F.when(sig & (F.col("_pos") < F.col("_mid")), F.col("xx"))).alias("lo"),
        F.max(F.when(F.col("_pos") == F.col("_mid"), F.col("xx"))).alias("median"))


def _spread(bounds: DataFrame, segs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Round 3: per-key bounds copied to each (segment, key) of the key (both small)."""
    return segs.join(bounds, list(keys))


def _flag(xx: Column, hi: Column, lo: Column) -> Column:
    return F.when(xx >= hi, F.lit("upper")).when(xx <= lo, F.lit("lower"))


def gap_scores(df: DataFrame, keys: Sequence[str], value: str, min_n: int = 10,
               coef: float = 0.95, offset: float = 0.2, partitions: int | None = None) -> DataFrame:
    """Every distinct value of every key with n >= min_n and its scores.

    Columns: keys..., xx, n, mx, x1, y, z, t1, median, outlier_type
    (``upper``/``lower``/null).
    """
    keys = list(keys)
    cols = [*keys, "xx", "n", "mx", "x1", "y", "z", "t1", "median", "outlier_type"]
    d = _distinct_values(df, keys, value)
    r, segs = _scored_segments(d, keys, min_n, coef, offset, partitions)
    b = _spread(_bounds(r, keys), segs, keys)
    out = (r.join(b, [SEG, *keys])
            .withColumn("outlier_type", _flag(F.col("xx"), F.col("hi"), F.col("lo"))))
    return out.select(*cols)


def gap_outliers(df: DataFrame, keys: Sequence[str], value: str, min_n: int = 10,
                 coef: float = 0.95, offset: float = 0.2, partitions: int | None = None) -> DataFrame:
    """Flagged values only: (keys..., xx, outlier_type)."""
    keys = list(keys)
    d = _distinct_values(df, keys, value)
    r, segs = _scored_segments(d, keys, min_n, coef, offset, partitions)
    # Only keys with a significant gap reach the last join.
    flagged = _bounds(r, keys).where(F.col("hi").isNotNull() | F.col("lo").isNotNull())
    b = _spread(flagged.select(*keys, "hi", "lo"), segs, keys)
    out = (r.select(SEG, *keys, "xx").join(b, [SEG, *keys])
            .withColumn("outlier_type", _flag(F.col("xx"), F.col("hi"), F.col("lo"))))
    return out.where(F.col("outlier_type").isNotNull()).select(*keys, "xx", "outlier_type")
