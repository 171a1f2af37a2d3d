"""Tolerant text -> typed parsing.

Spark 4 runs with ANSI mode on, where ``cast`` raises on bad text.  The
landing data is dirty by nature, and the bronze layer relies on bad values
turning into nulls that the validity filters then drop.  These helpers give
that null-on-failure behaviour without touching the session configuration.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.schemas import RAW_TS_FORMAT

# Text accepted as an integer by the legacy (non-ANSI) cast: surrounding
# whitespace, optional sign, then digits and/or a point followed by digits;
# the fraction is truncated.  A bare point counts as zero, a bare sign does
# not.  Group 1 is the sign, group 2 the whole digits.
_INT_TEXT = r"^\s*([+-]?)(?=[.0-9])([0-9]*)(?:[.][0-9]*)?\s*$"
# Sign, a literal 0 (so ".5" -> "0"), whole digits.
_INT_NORMALIZED = "$1\\0$2"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(c: Column | str) -> Column:
    """String -> int, null when the text is not a number or overflows.

    ``'2.7' -> 2``, ``'-3.9' -> -3``, ``'.5' -> 0``, ``'.' -> 0``, ``' 7 ' -> 7``,
    ``'x' -> null``, ``'1e2' -> null``, ``'3000000000' -> null``; a plain
    ``try_cast`` would null the decimals.

    Plain integers take the ``try_cast`` fast path (same value as the legacy
    cast); other text is normalized by one regular-expression replace and cast
    again (text that does not match is left as is and stays null).  The input
    is referenced only twice on purpose: Catalyst inlines it into every filter
    pushed below the projection.
    """
    text = _col(c).cast("string")
    slow = F.regexp_replace(text, _INT_TEXT, _INT_NORMALIZED).try_cast("int")
    return F.coalesce(text.try_cast("int"), slow)


def parse_double(c: Column | str) -> Column:
    """String -> double, null on bad text (``NaN`` and exponents are kept)."""
    return _col(c).try_cast("double")


def parse_timestamp(c: Column | str, fmt: str = RAW_TS_FORMAT) -> Column:
    """String -> timestamp in the session zone, null on bad text."""
    return F.try_to_timestamp(_col(c), F.lit(fmt))
