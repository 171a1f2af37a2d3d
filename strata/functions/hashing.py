"""Change-detection hash for slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and digest width of the stored hash_diff.
HASH_SEPARATOR = "||"
HASH_BITS = 256


def change_hash(columns: Iterable[str | Column]) -> Column:
    """Hex SHA-256 over the text of ``columns`` joined by ``||``.

    A null value hashes like an empty string, and the text form of a double
    follows Spark's rendering.  Both quirks are part of the stored format, so
    they are kept rather than "fixed".
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
        for c in columns
    ]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), HASH_BITS)
