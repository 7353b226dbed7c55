"""Placement history: gzip CSV in, typed and date-partitioned Parquet out."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.nulls import with_values
from tallyframe.functions.timewin import parse_event_time
from tallyframe.sources.tables import write_table

# The columns of the CSV, in its order.
CSV_SCHEMA = "timestamp string, user_id string, pixel_color string, coordinate string"
KEPT_COLUMNS = ("user_id", "pixel_color", "coordinate")


def typed_placements(raw: DataFrame, *, columns: Sequence[str] = KEPT_COLUMNS,
                     on_bad_time: str = "drop") -> DataFrame:
    """The raw text ``columns`` with a typed ``ts`` and its UTC ``event_date``."""
    if on_bad_time not in ("drop", "fail"):
        raise ValueError(f"on_bad_time must be 'drop' or 'fail', not {on_bad_time!r}")
    text = F.col("timestamp")
    ts = parse_event_time(text)
    if on_bad_time == "fail":
        message = F.concat(F.lit("invalid timestamp: "), F.coalesce(text, F.lit("NULL")))
        ts = F.coalesce(ts, F.raise_error(message).cast("timestamp"))
    rows = raw.select(
        ts.alias("ts"), *columns, F.to_date(F.substring(text, 1, 10)).alias("event_date"))
    return rows if on_bad_time == "fail" else with_values(rows, "ts")


def read_placements_csv(spark: SparkSession, path: str, *, columns: Sequence[str] = KEPT_COLUMNS,
                        on_bad_time: str = "drop", spread: bool = False) -> DataFrame:
    """Placements with a typed ``ts`` and its UTC ``event_date``.

    ``columns`` are taken by header name, others need not be there; files with another header than the first one
    stop the job. A row whose timestamp does not parse is
    dropped, or stops the job with ``on_bad_time="fail"``. A gzip file is unpacked by one
    task, so a large history should come as many files; with ``spread`` that task only
    unpacks, and its lines are dealt out before they are parsed (no line breaks inside quotes).
    """
    if spread:
        raw = _spread_csv(spark, path)
    else:
        raw = spark.read.options(header=True, enforceSchema=False, escape='"').csv(path)
    return typed_placements(raw, columns=columns, on_bad_time=on_bad_time)


def _spread_csv(spark: SparkSession, path: str) -> DataFrame:
    """The lines of CSV files as text columns, parsed by all cores.

    For few large files: the header of each is read first.
    """
    listed = spark.read.format("binaryFile").load(path).select("path").orderBy("path")  # reads no file
    files = [row["path"] for row in listed.collect()]
    # Unpacks the beginning of a file only.
    headers = {file: (spark.read.text(_escaped(file)).first() or [""])[0] for file in files}
    if len(set(headers.values())) > 1:
        raise ValueError(f"files with different headers: {headers}")
    header = next(iter(headers.values()), "")
    schema = ", ".join(f"`{name.strip(chr(34))}` string" for name in header.split(","))
    lines = spark.read.text(path).filter((F.col("value") != "") & (F.col("value") != header)).hint("rebalance")
    return lines.select(F.from_csv("value", schema, {"escape": '"'}).alias("_row")).select("_row.*")


def _escaped(path: str) -> str:
    """A path that is no pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def write_placements(placements: DataFrame, path: str, *, mode: str = "ignore") -> None:
    """Parquet by ``event_date``, each file sorted by ``ts``."""
    write_table(placements, path, ("event_date",), sort_by=("ts",), mode=mode)


def ingest_placements(spark: SparkSession, csv_path: str, table_path: str, *,
                      columns: Sequence[str] = KEPT_COLUMNS, on_bad_time: str = "drop",
                      mode: str = "ignore", spread: bool = False) -> DataFrame:
    """Convert once, then read the typed table."""
    rows = read_placements_csv(spark, csv_path, columns=columns, on_bad_time=on_bad_time, spread=spread)
    write_placements(rows, table_path, mode=mode)
    return spark.read.parquet(table_path)
