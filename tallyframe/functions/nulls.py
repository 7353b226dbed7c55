"""Null filters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_values(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all ``columns`` are set. Unlike ``dropna`` this reaches the Parquet scan."""
    return df.filter(reduce(and_, (F.col(c).isNotNull() for c in dict.fromkeys(columns))))
