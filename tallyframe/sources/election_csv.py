"""Precinct CSVs of many layouts as one table.

Every file may have its own header. Lines are matched with the header of their
file, parsed as CSV, and the wanted columns are picked by name. A file that the
layout or a vote count does not fit is left out as a whole and reported.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.plans.joins import lookup, without_members
from tallyframe.plans.staging import stage
from tallyframe.sources.archive import member_lines, open_archives

# The wanted columns and the spellings of a missing number.
TEXT_COLUMNS = ("office", "precinct", "party")
VOTES = "votes"
NULL_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
)
CSV_OPTIONS = {"quote": '"', "escape": '"'}


class Ingested(NamedTuple):
    """Conformed rows, and ``(file, problem, lines)`` of the files left out."""

    rows: DataFrame
    skipped: DataFrame


def _field_count(line: Column) -> Column:
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"[^"]*"', "")).otherwise(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def _with_fields(df: DataFrame, line: str, widths: Sequence[int], name: str, width: Column) -> DataFrame:
    """Add the first fields of a CSV line as an array, as many as ``width``, one of ``widths``.

    The parsed structs are columns of their own, of which the one of a line's width is not
    null, so that a line is parsed once and not once per field or width.
    """
    parsed = {w: f"_parsed{w}" for w in widths}
    df = df.withColumns({column: F.when(width == w, F.from_csv(
        line, ", ".join(f"c{i} string" for i in range(w)), CSV_OPTIONS)) for w, column in parsed.items()})
    fields = F.coalesce(*(
        F.when(F.col(column).isNotNull(), F.array(*(F.col(column)[f"c{i}"] for i in range(w))))
        for w, column in parsed.items()))
    return df.withColumn(name, fields).drop(*parsed.values())


def _from_path(file: Column, level: int) -> Column:
    """Folder name ``level`` steps above the file, without a ``key=`` prefix."""
    path = F.try_url_decode(F.regexp_replace(file, r"\+", "%2B"))
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1 - level), "^[^=]*=", "")


def _layouts(headers: DataFrame) -> tuple[DataFrame, list[int]]:
    """Per file its folders and where its header has the wanted columns.

    Positions count from 1, and 0 stands for an absent column. ``_parse`` is the number of
    fields that a line must be parsed into for them, as a power of two; its values are
    returned too.
    """
    width = headers.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    text = headers.withColumn("_text", F.regexp_replace("header", "^\ufeff", ""))
    layout = _with_fields(text, "_text", [width], "_fields", F.lit(width)).withColumn(
        "_names", F.slice("_fields", 1, _field_count(F.col("_text"))))
    places = [F.array_position("_names", c).cast("int") for c in (*TEXT_COLUMNS, VOTES)]
    power = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(*places, F.lit(1))))).cast("int")
    layout = layout.select(
        "file", "header", "weight", "state", "year", F.col("valid").alias("_readable"), power.alias("_parse"),
        F.size("_names").alias("_width"),
        (F.size(F.array_distinct("_names")) < F.size("_names")).alias("_repeats"),
        *(place.alias(f"_at_{c}") for c, place in zip((*TEXT_COLUMNS, VOTES), places, strict=True)),
    )
    layout = stage(layout, "layouts")
    # As many values as the widest header has powers of two.
    return layout, [r["_parse"] for r in layout.select("_parse").distinct().collect()]


def conform_lines(lines: DataFrame, headers: DataFrame, *, header_in_lines: bool = True,
                  **join_limits: int) -> Ingested:
    """Parse ``(file, line, valid)`` rows into the fixed columns.

    ``headers`` is a staged table of ``file``, ``header``, ``valid``, ``state``, ``year`` and
    ``weight``, the size of the file. ``valid`` tells whether the line is UTF-8. A line is parsed as far as the last wanted column of its file. An absent text column is ``''`` and an absent vote count is 0; a blank text
    field is ``''`` and a blank vote count NULL. Line breaks inside quotes are not
    supported. With ``header_in_lines`` one line equal to the header is dropped
    per file.
    """
    layouts, widths = _layouts(headers)
    lines = lines.select("file", "line", "valid").filter(F.col("line") != "")
    joined = lookup(lines, layouts, "file", "weight", **join_limits)
    parsed = _with_fields(joined, "line", sorted(widths) or [1], "_f", F.col("_parse"))

    def field(name: str) -> Column:
        place = F.col(f"_at_{name}")
        return F.when(place > 0, F.try_element_at("_f", place))

    number = F.col("_number")
    blank = number.isin(*NULL_SPELLINGS)
    exact = number.try_cast("decimal(38,6)")
    whole = F.col("_whole")
    parsed = parsed.withColumn("_number", F.trim(F.coalesce(field(VOTES), F.lit(""))))
    parsed = parsed.withColumn("_whole", F.coalesce(
        number.try_cast("bigint"), F.when(exact == F.floor(exact), exact.try_cast("bigint"))))
    problem = (
        F.when(~(F.col("valid") & F.col("_readable")), F.lit("not UTF-8"))
        .when(F.col("_repeats"), F.lit("repeated column"))
        .when(_field_count(F.col("line")) != F.col("_width"), F.lit("field count"))
        .when((F.col("_at_votes") > 0) & ~blank & whole.isNull(), F.lit("vote count"))
    )
    staged = stage(parsed.select(
        *(F.coalesce(field(c), F.lit("")).alias(c) for c in TEXT_COLUMNS),
        F.when(F.col("_at_votes") == 0, F.lit(0).cast("bigint"))
        .when(~blank, whole).alias(VOTES),
        "state", "year", "file",
        (F.col("line") == F.col("header")).alias("_is_header"),
        F.monotonically_increasing_id().alias("_line"),
        problem.alias("problem"),
    ), "conformed")

    body = staged
    if header_in_lines:
        like_header = staged.filter("_is_header")
        heads = like_header.groupBy("file").agg(F.min("_line").alias("_line")).select("_line")
        copies = like_header.join(heads, "_line", "left_anti")
        body = staged.filter("not _is_header").unionByName(copies)
    bad = body.filter(F.col("problem").isNotNull())
    # Text as an aggregate makes Spark sort its input, so the lines are counted by problem first.
    counts = bad.groupBy("file", "problem").agg(F.count("*").alias("lines"))
    skipped = stage(counts.groupBy("file").agg(F.min("problem").alias("problem"),
                                               F.sum("lines").alias("lines")), "skipped")
    rows = without_members(body, skipped, "file", "_line", **join_limits)
    return Ingested(rows.select(*TEXT_COLUMNS, VOTES, "state", "year"), skipped)


def read_csv_tree(spark: SparkSession, root: str) -> DataFrame:
    """Lines of all ``*.csv`` files below ``root`` with their file and its size."""
    text = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").text(root)
    )
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_bytes"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").alias("line"),
        F.is_valid_utf8("value").alias("valid"),
    )


def _first_lines(lines: DataFrame) -> DataFrame:
    """``(file, header, weight)``: the first non-blank line of the block at offset 0 of every file.

    A task reads such a block in one go, so that only its first line gets to the aggregate,
    which sorts what it gets.
    """
    starts = lines.filter((F.col("block_start") == 0) & (F.col("line") != "")).select(
        "file", F.col("line").cast("binary").alias("line"), "file_bytes",
        F.monotonically_increasing_id().alias("_at"))

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The first of rows that follow each other with the same file, whatever their number."""
        last = None
        for batch in batches:
            file = batch.column(0)
            if len(file):
                changes = pc.not_equal(file[1:], file[:-1])
                yield batch.filter(pa.concat_arrays([pa.array([file[0].as_py() != last]), changes]))
                last = file[-1].as_py()

    return starts.mapInArrow(heads, starts.schema).groupBy("file").agg(
        F.min_by(F.col("line").cast("string"), "_at").alias("header"), F.max("file_bytes").alias("weight"))


def ingest_election_csvs(spark: SparkSession, root: str, **join_limits: int) -> Ingested:
    """Read ``<state>/<year>/<name>.csv`` trees whose headers differ between files."""
    lines = read_csv_tree(spark, root)
    headers = _first_lines(lines).withColumns({"valid": F.is_valid_utf8("header"), "state": _from_path(F.col("file"), 2), "year": _from_path(F.col("file"), 1)})
    return conform_lines(lines, stage(headers, "headers"), **join_limits)


def ingest_election_archive(spark: SparkSession, path: str, **join_limits: int) -> Ingested:
    """The same for zip archives, without extracting them."""
    members = open_archives(spark, path)
    lines = member_lines(members)
    headers = member_lines(members, headersOnly=True).select(
        "file", F.col("line").alias("header"), "valid", F.col("file_bytes").alias("weight"), "state", "year")
    return conform_lines(lines.filter(F.col("line_no") > 0), stage(headers, "headers"),
                         header_in_lines=False, **join_limits)
