"""Business-date helpers over instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# Fixed value: the business calendar's home zone.
BUSINESS_TZ = "Europe/London"


def _local_wall_clock(ts: Column, tz: str, source_tz: str | None) -> Column:
    if source_tz is None:
        # An instant (TIMESTAMP): its wall clock in the session zone, then
        # shifted, so the answer does not depend on the session zone.
        return F.convert_timezone(
            F.current_timezone(), F.lit(tz), ts.cast(TimestampNTZType())
        )
    # A wall clock (TIMESTAMP_NTZ) known to be in ``source_tz``.
    return F.convert_timezone(F.lit(source_tz), F.lit(tz), ts.cast(TimestampNTZType()))


def business_date(ts: Column | str, tz: str = BUSINESS_TZ, source_tz: str | None = None) -> Column:
    """Calendar date of ``ts`` in zone ``tz``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(_local_wall_clock(c, tz, source_tz))


def previous_business_date(
    ts: Column | str, tz: str = BUSINESS_TZ, source_tz: str | None = None
) -> Column:
    """The local date before the one ``ts`` falls on in ``tz`` ("yesterday").

    ``ts`` is an instant (TIMESTAMP), or a TIMESTAMP_NTZ wall clock in
    ``source_tz`` (e.g. ``"UTC"``).  DST shifts are handled by the zone rules.
    """
    return F.date_sub(business_date(ts, tz, source_tz), 1)


__all__ = ["BUSINESS_TZ", "business_date", "previous_business_date"]
