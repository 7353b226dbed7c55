"""Data-quality profile of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.nulls import with_values

TOP_ROWS = 5


def profile_schema(df: DataFrame) -> DataFrame:
    """Column names and types in order."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, column_type string, nullable boolean")


def profile_row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def profile_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column from one pass over the table."""
    columns = list(columns or df.columns)
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], columns, "column_name", "missing_count")


def profile_columns(df: DataFrame) -> DataFrame:
    """Name, type, row count and NULL count of every column, from one pass."""
    facts = [
        F.struct(F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("column_type"),
                 F.count("*").alias("total_rows"),
                 F.count_if(F.col(f.name).isNull()).alias("missing_count"))
        for f in df.schema
    ]
    return df.agg(F.array(*facts).alias("facts")).select(F.inline("facts"))


def profile_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of rows that share all ``columns`` with another row, first copies included."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count("*").alias("_n"))
    repeated = F.sum(F.when(F.col("_n") > 1, F.col("_n")))
    return groups.agg(F.coalesce(repeated, F.lit(0)).alias("duplicate_count"))


def profile_numeric(df: DataFrame, column: str) -> DataFrame:
    """Least, greatest and mean value of ``column``."""
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"),
                  F.avg(column).alias(f"avg_{column}"))


def profile_categories(df: DataFrame, column: str, *, name: str = "n") -> DataFrame:
    """Rows per non-null value of ``column``, most frequent first."""
    counts = with_values(df, column).groupBy(column).agg(F.count("*").alias(name))
    return counts.orderBy(F.desc(name), column)


def profile_top_rows(df: DataFrame, column: str, k: int = TOP_ROWS, *,
                     where: Column | None = None, non_blank: Sequence[str] = ()) -> DataFrame:
    """The ``k`` rows with the greatest ``column`` among those that pass the tests.

    Equal values are ordered by the other columns from left to right.
    """
    rows = with_values(df, column)
    for c in non_blank:
        rows = rows.filter(F.trim(c) != "")
    if where is not None:
        rows = rows.filter(where)
    ties = [F.asc_nulls_last(c) for c in df.columns if c != column]
    return rows.orderBy(F.desc(column), *ties).limit(k)


def profile_top_groups(df: DataFrame, group: str, column: str, k: int = TOP_ROWS, *,
                       name: str = "total") -> DataFrame:
    """The ``k`` groups with the greatest sum of ``column``."""
    sums = with_values(df, column).groupBy(group).agg(F.sum(column).alias(name))
    return sums.orderBy(F.desc(name), F.asc_nulls_last(group)).limit(k)
