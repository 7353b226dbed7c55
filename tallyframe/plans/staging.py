"""Intermediate tables in the shared folder of the cluster.

A staged table is written once and read back, so later jobs neither repeat the
work before it nor depend on executors that may be lost.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or by ``setCheckpointDir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallyframe-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the staging folder and return the stored table."""
    spark = df.sparkSession
    path = new_staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables that go when their block ends.

    For tables that a result no longer reads: ``with Scratch(spark) as scratch`` stages
    with ``scratch.stage``, and what is to live on is staged by ``stage`` before the end.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        path = new_staging_path(self._spark, label)
        self._paths.append(path)
        df.write.parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *error: object) -> None:
        conf = self._spark._jsc.hadoopConfiguration()
        for path in self._paths:
            folder = self._spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
        self._paths.clear()
