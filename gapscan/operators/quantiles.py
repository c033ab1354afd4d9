"""Approximate percentiles from mergeable sketches.

A key's values are summarised by a KLL quantile sketch. Sketches are built with
partial aggregation, so a hot key sends one small sketch from each task and its
values never move: no range shuffle, no staged table. Stored sketches merge, so
the percentiles of a year come from the sketches of its days.

A quantile's rank differs from the one asked for by at most ``error`` times n,
with a probability of 99 % for each; keys with no more values than the sketch
holds are exact. ``segments.quantiles_disc`` gives exact positions.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR = 0.005
SMALLEST, LARGEST = 8, 65_535      # sizes that the sketch functions take


def sketch_size(error: float) -> int:
    """Least sketch size with that rank error: the published fit 2.296 / k^0.9723."""
    return min(max(math.ceil((2.296 / error) ** (1 / 0.9723)), SMALLEST), LARGEST)


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, error: float = ERROR,
                      out: str = "sketch") -> DataFrame:
    """(keys, sketch): one mergeable sketch a key; null and NaN are no values."""
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x))
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double(x, sketch_size(error)).alias(out))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch") -> DataFrame:
    """(keys, sketch): the sketches of parts merged to those of ``keys``."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double(sketch).alias(sketch))


def sketch_quantiles(sketches: DataFrame, keys: Sequence[str], probs: Mapping[str, float],
                     sketch: str = "sketch") -> DataFrame:
    """(keys, n, one column for each ``name -> p``) read from sketches."""
    return sketches.select(*keys, F.kll_sketch_get_n_double(sketch).alias("n"),
                           *[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))).alias(name)
                             for name, p in probs.items()])


def approx_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float],
                     error: float = ERROR) -> DataFrame:
    """(keys, n, one column for each ``name -> p``) of the values of each key."""
    return sketch_quantiles(quantile_sketches(df, keys, value, error), keys, probs)
