"""Partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The columns of cleaned precinct results, in order.
RESULTS_SCHEMA = (
    "state string, precinct string, year string, office string, votes bigint, party string"
)


def _is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end; a folder that holds an unfinished one is an error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return False
    if not files.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")):
        raise FileExistsError(f"{path} holds an unfinished table: remove it or write with mode='overwrite'")
    return True


def write_table(df: DataFrame, path: str, partition_by: Sequence[str], *,
                sort_by: Sequence[str] = (), mode: str = "ignore") -> None:
    """Write Parquet by ``partition_by``, each file sorted by ``sort_by``.

    The rebalance hint lets adaptive execution split a partition that holds much
    of the data and merge small ones. ``mode="ignore"`` keeps a finished table, which
    its ``_SUCCESS`` file tells; a folder without one stops the call.
    """
    if mode == "ignore" and _is_finished(df.sparkSession, path):
        return
    (
        df.hint("rebalance", *partition_by)
        .sortWithinPartitions(*partition_by, *sort_by)
        .write.mode("errorifexists" if mode == "ignore" else mode)
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_results(results: DataFrame, path: str, *, mode: str = "ignore") -> None:
    """Precinct results by state and year."""
    write_table(results, path, ("state", "year"), sort_by=("office", "precinct"), mode=mode)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """The schema is stated, so that folder names such as ``00`` stay text."""
    columns = [c.split()[0] for c in RESULTS_SCHEMA.split(", ")]
    return spark.read.schema(RESULTS_SCHEMA).parquet(path).select(*columns)
