"""Expression builders shared by the operators.

Spark 4 runs with ANSI mode on, where a bad cast, an out-of-range array index
or a division by zero raises. The trip pipeline expects nulls in those cases,
so the builders use the ``try_`` forms, ``get`` and ``try_divide``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripkiln import schema as S

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: ColumnOrName, digits: int) -> Column:
    """``F.round`` of a double, without a decimal object for most values.

    A value whose scaled form is clearly off a tie (by far more than a
    double's error below 2^40) is rounded by ``floor``; whole numbers over a
    power of ten give the very double that the decimal would. Ties, large
    values, NaN and infinities take ``F.round``."""
    c = _col(c)
    if not 0 <= digits <= 15:
        return F.round(c, digits)
    power = F.lit(float(10**digits))
    scaled = c * power
    plain = (F.abs(scaled) < float(1 << 40)) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(plain, F.floor(scaled + 0.5).cast("double") / power).otherwise(F.round(c, digits))


def cast_value(c: ColumnOrName, kind: str, digits: int | None = None) -> Column:
    """Lenient cast of text (or any value) to a trip column type.

    Integers go through double so that ``'12.7'`` gives 12 (truncation) like a
    cast of an inferred double column; text that is no number, and numbers out
    of the integer range, give null. Doubles are rounded HALF_UP to ``digits``.
    """
    c = _col(c)
    if kind == S.INT:
        out = c.try_cast("double").try_cast("int")
    elif kind == S.DOUBLE:
        out = c.try_cast("double")
        if digits is not None:
            out = round_half_up(out, digits)
    elif kind == S.STRING:
        out = c.cast("string")
    elif kind == S.TIMESTAMP:
        out = c.try_cast(S.SPARK_TYPES[S.TIMESTAMP])
    else:
        raise ValueError(f"unknown column kind {kind!r}")
    return out


def parse_timestamp(c: ColumnOrName, fmt: str) -> Column:
    """Text in exactly the given format as a wall-clock time; null otherwise."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast(S.SPARK_TYPES[S.TIMESTAMP])


def split_part(c: ColumnOrName, index: int, separator: str = " ") -> Column:
    """0-based part of ``c`` split on a literal separator; null when missing."""
    return F.get(F.split(_col(c), re.escape(separator)), index)


def mask_full(c: ColumnOrName, text: str = "*****", keep_null: bool = False) -> Column:
    """Replace every value by ``text``; with ``keep_null`` nulls stay null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.lit(text)) if keep_null else F.lit(text)


def mask_partial(
    c: ColumnOrName,
    keep: int = 4,
    text: str = "***",
    min_hidden: bool = False,
) -> Column:
    """First ``keep`` + ``text`` + last ``keep`` characters; null stays null.

    Values not longer than ``2 * keep`` are shown whole (twice when shorter
    than ``keep``), as in the original pipeline; ``min_hidden=True`` masks
    such short values fully instead.
    """
    c = _col(c)
    out = F.concat(F.substring(c, 1, keep), F.lit(text), F.substring(c, -keep, keep))
    if min_hidden:
        out = F.when(F.length(c) <= 2 * keep, F.lit(text)).otherwise(out)
    return out


def epoch_seconds(c: ColumnOrName) -> Column:
    """Whole seconds since the epoch, floored (as a cast to long does).

    For TIMESTAMP_NTZ the wall-clock value is read as UTC, so the result does
    not depend on the session time zone.
    """
    return F.unix_timestamp(_col(c))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """(end - start) in minutes from whole-second epochs, as a double."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, null when den is zero or null."""
    return F.try_divide(_col(num), _col(den))
