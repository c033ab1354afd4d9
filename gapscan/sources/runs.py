"""A restartable sink, with counters observed while it writes (A10).

A run writes a folder partitioned by some columns. It replaces the partitions
that it writes and leaves the others, so a run that failed, or one for a
single partition, can simply be started again. What a run wrote counts once
its commit record lies beside the data: the record is removed first and written
last, after Spark has committed the files, and readers refuse a folder whose
last run did not finish.

The record holds the run's counters. They are observed while the rows are
written, so counting costs no second pass.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from gapscan.staging import delete_path

# A leading underscore hides the record from readers of the data.
RECORD = "_commit"
MODES = ("errorifexists", "replace")


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return bool(fs.exists(p))


def write_run(df: DataFrame, path: str, partition_by: Sequence[str], run: str,
              counters: Mapping[str, Column] | None = None, mode: str = "errorifexists") -> dict[str, int]:
    """Write ``df`` below ``path`` and return the counters.

    ``mode``: "errorifexists" fails when the path exists; "replace" replaces the
    partitions that ``df`` has rows for. ``counters`` are aggregates over the
    rows as they are written.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    spark, record = df.sparkSession, f"{path}/{RECORD}"
    replace = mode == "replace"
    if replace:
        delete_path(spark, record)
    observation = Observation(run) if counters else None
    rows = df.observe(observation, *[c.alias(name) for name, c in counters.items()]) if counters else df
    (rows.write.mode("overwrite" if replace else "errorifexists")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    values = {name: observation.get[name] for name in counters} if counters else {}
    # one line of JSON: the run's name and its counters
    line = json.dumps({"run": run, **values})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(record)
    return values


def committed(spark: SparkSession, path: str) -> bool:
    """Did the last run into ``path`` finish?"""
    return _exists(spark, f"{path}/{RECORD}/_SUCCESS")


def read_run(spark: SparkSession, path: str) -> DataFrame:
    """The rows below ``path``; an error when its last run did not finish."""
    if not committed(spark, path):
        raise RuntimeError(f"the last run into {path} did not finish")
    return spark.read.parquet(path)


def read_counters(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The counters of the last run into ``path``, as one row of longs."""
    if not committed(spark, path):
        raise RuntimeError(f"the last run into {path} did not finish")
    return spark.read.schema(", ".join(f"{n} bigint" for n in names)).json(f"{path}/{RECORD}")
