"""Writers: append by name, replace one day, SCD2 dimension rewrite,
landing export, and catalog registration."""

from strata.sinks.layout import TABLES, TableSpec
from strata.sinks.writers import (
    append_by_name,
    export_landing,
    replace_day,
    write_dimension,
)

__all__ = [
    "TABLES",
    "TableSpec",
    "append_by_name",
    "export_landing",
    "replace_day",
    "write_dimension",
]
