"""A Bloom filter of join keys, applied in the scan of the large side.

Few records have a flagged key, but a shuffle join moves every record, with all
its columns, before it learns which. The filter is built from the few keys and
tested where the records are read, below the join's exchange, so that what
moves follows the flagged rows (and a small share of false hits, which the
join removes).

It is one bit per key hash in a table of 32768-bit pieces, kept in ordinary
rows: pieces are built by ``bitmap_construct_agg`` with partial aggregation, and
a record meets its piece in a broadcast join. The table has at most
``MOST_BITS`` bits (32 MB) whatever the number of keys, so broadcasting it is
safe at any size; with more keys it only lets more records pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 32            # about 3 % false hits
PIECE = 1 << 15              # bits of one bitmap row (fixed by the bitmap functions)
MOST_BITS = 1 << 28


def filter_bits(keys: int) -> int:
    """Size of the filter for a number of keys: a power of two, at most ``MOST_BITS``."""
    return min(max(1 << (max(keys, 1) * BITS_PER_KEY - 1).bit_length(), PIECE), MOST_BITS)


def _place(cols: Sequence[str], bits: int) -> Column:
    # from 1, as the bitmap functions count
    return F.pmod(F.xxhash64(*cols), F.lit(bits)) + 1


def key_filter(keys: DataFrame, cols: Sequence[str], bits: int) -> DataFrame:
    """(_piece, _bits): the filter of the distinct values of ``cols``; at most ``bits`` / 32768 rows."""
    place = keys.select(_place(cols, bits).alias("_at"))
    return place.groupBy(F.bitmap_bucket_number("_at").alias("_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits"))


def passing(rows: DataFrame, filter_: DataFrame, cols: Sequence[str], bits: int) -> DataFrame:
    """The rows whose key may be in the filter: all that are, and few others.
    Rows with a null key pass as any other value does."""
    at = _place(cols, bits)
    bit = F.bitmap_bit_position(at)
    byte = F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1
    return (rows.join(F.broadcast(filter_), F.bitmap_bucket_number(at) == F.col("_piece"))
                .where(is_set).select(*[rows[c] for c in rows.columns]))
