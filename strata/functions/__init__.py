"""Column-expression helpers (all JVM-side, no UDFs)."""

from strata.functions.calendar import business_date, previous_business_date
from strata.functions.hashing import change_hash
from strata.functions.parsing import parse_double, parse_int, parse_timestamp

__all__ = [
    "business_date",
    "change_hash",
    "parse_double",
    "parse_int",
    "parse_timestamp",
    "previous_business_date",
]
