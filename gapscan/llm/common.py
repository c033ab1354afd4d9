"""Helpers shared by the document operators: words, bindings, document order."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space that separates words: space and \t \n \v \f \r.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


# Stands for a missing number in an order: after all others.
LAST = 2 ** 63 - 1


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` may use it many
    times (also inside other lambdas) while it is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null or blank text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def order_key(number: Column) -> Column:
    """A number as a part of an order in which missing ones come last."""
    return F.coalesce(number.cast("long"), F.lit(LAST))


def segment_starts(rows: DataFrame, first: str, second: str, pieces: int) -> list[tuple[int, int]]:
    """The least (first, second) of each of at most ``pieces`` segments of about
    equal size that cut the order of two long columns; equal pairs share one.
    The driver gets one pair a segment."""
    cut = rows.select(first, second).repartitionByRange(max(pieces, 1), first, second)
    starts = cut.groupBy(F.spark_partition_id().alias("piece")).agg(
        F.min(F.struct(first, second)).alias("start"))
    return sorted((r["start"][0], r["start"][1]) for r in starts.collect())


class Segments:
    """Column expressions over segment starts. All starts are one array value in
    the plan, however many there are, and are searched by halving."""

    def __init__(self, starts: list[tuple[int, int]]):
        self.n = len(starts)
        array = lambda k: F.from_json(F.lit(json.dumps([s[k] for s in starts])), "array<bigint>")
        self.first, self.second = array(0), array(1)

    def start_is(self, segment: Column, a: Column, b: Column) -> Column:
        """Is (a, b) the start of the segment?"""
        return (F.get(self.first, segment) == a) & (F.get(self.second, segment) == b)

    def of(self, a: Column, b: Column) -> Column:
        """Number of the segment that holds (a, b), from 0."""
        steps = [1 << k for k in reversed(range(max(self.n - 1, 0).bit_length()))]
        if not steps:
            return F.lit(0)

        def further(at: Column, step: Column) -> Column:
            there = at + step
            x = F.get(self.first, there)
            reached = (x < a) | ((x == a) & (F.get(self.second, there) <= b))
            return F.when(F.coalesce(reached, F.lit(False)), there).otherwise(at)
        return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def default_pieces(df: DataFrame, per_partition: int = 4) -> int:
    """Segments for ordered work: a few for every shuffle partition, which a
    cluster sets to suit the size of its data."""
    return per_partition * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
