"""String expressions that behave the same for every script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every character that counts as white space, in code point order.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of any kind; ``trim`` knows only the space."""
    return F.btrim(col, F.lit(SPACES))


def squeeze(col: Column) -> Column:
    """Lower case, stripped, inner white space collapsed to single spaces; null becomes empty."""
    lowered = strip(F.lower(F.coalesce(col, F.lit(""))))
    return F.regexp_replace(lowered, r"(?U)\s+", " ")


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def first_group(col: Column, pattern: str, group: int = 1) -> Column:
    """The first capture of ``pattern``, null where nothing matches."""
    return blank_to_null(F.regexp_extract(col, pattern, group))


def try_double(col: Column) -> Column:
    return col.try_cast("double")


def round_half_up(col: Column, digits: int) -> Column:
    """Floor-based rounding: the same double operations in every engine."""
    scale = float(10**digits)
    return F.floor(col * scale + 0.5) / scale + 0.0
