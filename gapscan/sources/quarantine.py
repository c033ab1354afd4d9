"""S1/S7 with bad rows: text scans that set aside what does not fit the schema.

The reader takes a declared schema and a column for the raw line of a row that
it cannot parse (a value of the wrong type, too few or too many fields). Both
kinds of rows are written in one pass over the text, partitioned by their
kind, so reading either part lists only its own files. Lines of white space
alone are no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapscan.staging import staging_path

RAW = "_raw"
KIND = "_bad"


@dataclass(frozen=True)
class Split:
    """``good``: rows of the declared schema. ``bad``: the raw lines of the others."""
    good: DataFrame
    bad: DataFrame


def read_split(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "\t",
               header: bool = True, out: str | None = None) -> Split:
    """Read delimited text below ``path`` and write good and bad rows apart, to
    ``out`` or a staged folder."""
    declared = spark.createDataFrame([], schema).schema
    fields = T.StructType([*declared.fields, T.StructField(RAW, T.StringType())])
    # fields by place, as declared: a reordered or renamed header is no bad row
    lines = (spark.read.schema(fields).option("sep", sep).option("header", str(header).lower())
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW)
             .option("enforceSchema", "true").csv(path))
    out = out or staging_path(spark, "split")
    lines.withColumn(KIND, F.col(RAW).isNotNull()).write.partitionBy(KIND).parquet(out)
    stored = spark.read.schema(T.StructType([*fields.fields, T.StructField(KIND, T.BooleanType())])).parquet(out)
    return Split(stored.where(~F.col(KIND)).select(*declared.names),
                 stored.where(F.col(KIND)).select(F.col(RAW).alias("line")))
