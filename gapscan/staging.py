"""Tables staged in the shared folder, and their removal.

A staged table cuts lineage: it is computed once, later branches read columnar
files, and a lost executor costs only the tasks that were running on it. The
folder is the one the cluster names in ``spark.checkpoint.dir``. Tables staged
here are plain files; bucketed ones (``operators.segments.materialize``) need a
catalog entry, which ``segments.drop_staged`` removes with the files.
"""

from __future__ import annotations

import itertools
import threading
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from gapscan.session import ensure_checkpoint_dir

PREFIX = "gapscan-staged-"

_NUMBERS = itertools.count(1)


class _Entry(NamedTuple):
    number: int          # in the order of staging
    thread: int
    path: str
    table: str | None    # of a bucketed table


# What this process staged, by Spark application.
_STAGED: dict[str, list[_Entry]] = {}


def _entries(spark: SparkSession) -> list[_Entry]:
    return _STAGED.setdefault(spark.sparkContext.applicationId, [])


def staging_path(spark: SparkSession, label: str = "table", table: str | None = None) -> str:
    """A new path below the shared folder; ``release`` deletes what is written
    there, and drops the catalog table ``table`` if one is named."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{PREFIX}{label}-{uuid.uuid4().hex}"
    _entries(spark).append(_Entry(next(_NUMBERS), threading.get_ident(), path, table))
    return path


def stage(df: DataFrame, label: str = "table") -> DataFrame:
    """Compute ``df`` once as Parquet in the shared folder and read it back.

    The schema is passed to the reader, so an empty table reads back with its
    columns.
    """
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the file system that Spark uses for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))


def mark(spark: SparkSession) -> int:
    """A point in time: ``release`` deletes what is staged after it."""
    return next(_NUMBERS)


def staged_paths(spark: SparkSession) -> list[str]:
    """Paths of the tables staged in this application that are not released yet."""
    return [e.path for e in _entries(spark)]


def release(spark: SparkSession, since: int | None = None, keep_last: bool = False) -> int:
    """Delete tables that this process staged in this application (only those).

    With ``since`` (a ``mark``) only those that this thread staged after it, so
    that queries side by side keep theirs; with ``keep_last`` all but the newest.
    Call it after the results that read them have been written. Returns how
    many folders were deleted.
    """
    entries = _entries(spark)
    spent = [e for e in list(entries) if since is None or (e.number > since and e.thread == threading.get_ident())]
    if keep_last:
        spent = spent[:-1]
    deleted = 0
    for e in spent:
        entries.remove(e)
        if e.table:
            spark.sql(f"DROP TABLE IF EXISTS {e.table}")
        deleted += delete_path(spark, e.path)
    return deleted
