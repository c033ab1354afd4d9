"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on every row the stage before
it kept; its result is written as Parquet and read again as the next stage's
``docs``. All but the last return the columns of ``documents``.

1. toxicity: documents scored toxic go.
2. line_dedup: common blocks go from the later of two overlapping documents.
3. simhash: of each group of near duplicates one document stays.
4. mixing: sources are mixed to their target weights, in training order.
5. packing: token pieces are packed into sequences.

Defined cases, for any stage as the first one: a null or empty text is a
document (never toxic by its words, near a copy of any other empty text, of no
size in the mix); rows without doc_id or source are documents; repeated rows are
documents of which the third stage keeps one; columns other than doc_id, text,
source and n_chars pass through whatever their names; an empty table gives empty
results with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gapscan.llm.line_dedup import without_common_lines
from gapscan.llm.mixing import mix
from gapscan.llm.packing import pack_documents
from gapscan.llm.simhash import keep_one
from gapscan.llm.toxicity import reject_toxic
from gapscan.staging import mark, release, stage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines an earlier one has in a common block."""
    return without_common_lines(docs)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each near-duplicate group."""
    return keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per copy the mix takes, in training order."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token piece with its sequence and place."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("simhash", simhash),
          ("mixing", mixing), ("packing", packing)]

# Learned models, alignment and packing have no SQL form; the stages are
# tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, staged in between. What a stage had staged,
    and the documents it read, are deleted once its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = mark(spark)
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
        release(spark, before, keep_last=True)
    return STAGES[-1][1](spark, docs, sf_dir)
