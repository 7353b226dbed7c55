"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(value: str | Column) -> Column:
    """Lower case without leading and trailing spaces (tabs are kept)."""
    value = F.col(value) if isinstance(value, str) else value
    return F.lower(F.trim(value))
