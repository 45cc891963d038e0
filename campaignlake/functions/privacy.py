"""Pseudonymization of identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pseudonymize(col: str | Column) -> Column:
    """Lower-case hex SHA-256 of the value's string form (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sha2(c.cast("string"), 256)
