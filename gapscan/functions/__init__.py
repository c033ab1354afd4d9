"""Column functions (all built-in Spark expressions, no Python UDFs)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def snap_cell(x: str | Column) -> Column:
    """Integer 0.1-cell key of a coordinate: round(x * 100 / 10), half away from zero.

    The order of operations is kept on purpose: round(x, 1) or round(x * 10)
    give a different cell for some inputs.
    """
    return F.round(_c(x) * 100 / 10).cast("long")


def snap_value(x: str | Column) -> Column:
    """The snapped coordinate as a number: round(x * 100 / 10) * 10 / 100."""
    return F.round(_c(x) * 100 / 10) * 10 / 100


def cell_to_value(cell: str | Column) -> Column:
    """Visible coordinate of an integer cell key (tenths)."""
    return _c(cell) * 10 / 100


def fixed_decimal(x: str | Column, digits: int = 1) -> Column:
    """Fixed-decimal text of a number ("12.0", "-0.5"), like a formatted key."""
    return F.trim(F.format_string(f"%.{digits}f", F.round(_c(x), digits)))


def normalise_label(x: str | Column) -> Column:
    """Lower-case a label and turn underscores into spaces."""
    return F.regexp_replace(F.lower(_c(x)), "_", " ")


def composite_key(*parts: str | Column, sep: str = "_") -> Column:
    """Join key parts into one text key; null when a part is null, so that such
    a row falls out of joins on the key."""
    texts = [_c(p).cast("string") for p in parts]
    return F.concat(texts[0], *[x for t in texts[1:] for x in (F.lit(sep), t)])


def split_key(key: str | Column, index: int, sep: str = "_") -> Column:
    """Part ``index`` (0-based) of a composite text key."""
    return F.split(_c(key), re.escape(sep)).getItem(index)


def surface_number(name: str | Column, prefix: str) -> Column:
    """Number inside a surface label ("bio12" -> 12), null when it is not a number."""
    return F.regexp_replace(_c(name), f"^{prefix}", "").try_cast("int")


def blank_zero(n: str | Column) -> Column:
    """Text of a count, empty when the count is zero."""
    return F.when(_c(n) == 0, F.lit("")).otherwise(_c(n).cast("string"))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, null when den is zero (ANSI mode would raise)."""
    return F.try_divide(_c(num), _c(den))


def scaled(x: str | Column, factor: float) -> Column:
    """x / factor (stored tenths to units and similar)."""
    return _c(x) / F.lit(factor)


def _spread_bits(x: Column) -> Column:
    """The low 31 bits of a non-negative number, moved to the even places of 62."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def morton(x: str | Column, y: str | Column, offset: int = 1 << 30) -> Column:
    """Morton key of an integer cell: the bits of x and y in turn, so that cells
    near each other get keys near each other. Cells from -2^30 to 2^30 - 1."""
    return _spread_bits(_c(x).cast("long") + offset).bitwiseOR(
        F.shiftleft(_spread_bits(_c(y).cast("long") + offset), 1))
