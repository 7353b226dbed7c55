"""Zip archives of precinct CSVs as lines, read through the file system of the cluster.

A zip entry begins with a fixed signature. The text source splits files at it, so that one
scan, with many tasks to an archive, yields the entries as rows, and the directory of the
archive as the end of its last row. Wanted entries are stored, still compressed, and checked
against the directory: an entry that only looks like one, as in an archive within an
archive, is dropped, and one whose data hold the signature by chance is put together
again. Tasks then unpack the stored members by blocks.
"""

from __future__ import annotations

import io
import math
import re
import sys
import zipfile
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.plans.files import Folder
from tallyframe.plans.joins import fits_broadcast
from tallyframe.plans.staging import stage

# These functions run in Python workers, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Which members hold precinct results of a general election.
MEMBER_PATTERN = re.compile(
    r"(?:^|/)(?P<state>[^/]*openelections-data[^/]*)/(?P<year>[^/]*)"
    r"/[^/]*__general__(?:[^/]+__)?precinct\.csv$"
)
EXCLUDED_WORD = "special"

LINE_SCHEMA = (
    "state string, year string, file string, file_bytes bigint, line_no bigint, line string, "
    "valid boolean"
)
# Fixed values of the zip format: signatures of an entry and of the end, and bytes of an entry
# between its signature and its name.
ENTRY, END = b"PK\x03\x04", b"PK\x05\x06"
HEADER = 26

GROUP_BYTES = 128 << 20
LEAST_BYTES = 2 << 20
BLOCK_BYTES = 4 << 20
HEADER_BYTES = 64 << 10


def member_of_interest(name: str) -> tuple[str, str] | None:
    """State folder and year folder of a wanted member, None for any other."""
    found = MEMBER_PATTERN.search(name)
    if found is None or EXCLUDED_WORD in name:
        return None
    return found["state"], found["year"]


def _line_blocks(raw: IO[bytes], size: int) -> Iterator[list[bytes]]:
    """Non-blank lines, those of about ``size`` bytes at a time, without a byte order mark."""
    rest, first = b"", True
    while True:
        data = raw.read(size)
        block = rest + data
        if first:
            block, first = block.removeprefix(b"\xef\xbb\xbf"), False
        # A carriage return at the end may be half of a line break.
        end = max(block.rfind(b"\n"), block.rfind(b"\r", 0, -1)) + 1 if data else len(block)
        rest = block[end:]
        lines = block[:end].replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n")
        if lines := [line for line in lines if line]:
            yield lines
        if not data:
            return


def _as_text(lines: list[bytes]) -> tuple[pa.Array, list[bool]]:
    """The lines as text, and which of them are UTF-8; in the others bad bytes are replaced."""
    try:
        return pa.array(lines, pa.binary()).cast(pa.string()), [True] * len(lines)
    except pa.ArrowInvalid:
        text = [line.decode("utf-8", errors="replace") for line in lines]
        return pa.array(text), [t.encode() == line for t, line in zip(text, lines, strict=True)]


_MEMBER = (
    "archive string, raw_name binary, name string, state string, year string, crc bigint, packed_bytes bigint, "
    "file_bytes bigint, method int, flags int, offset bigint, end bigint")
_MEMBER_TYPES = {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32()}
_MEMBER_FIELDS = [(c.split()[0], _MEMBER_TYPES[c.split()[1]]) for c in _MEMBER.split(", ")]


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """What follows each entry signature, in the order ``at``; the first row of an archive is
    what precedes them all."""
    reader = spark.read.option("lineSep", ENTRY.decode())
    return _archive_files(spark, reader, path).text(path).select(
        F.col("_metadata.file_path").alias("archive"), F.col("_metadata.file_size").alias("size"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("row")).alias("at"),
        F.col("value").cast("binary").alias("data"))


def _archive_files(spark: SparkSession, reader: DataFrameReader, path: str) -> DataFrameReader:
    return reader.option("pathGlobFilter", "*.zip") if Folder(spark, path).is_folder() else reader


def _little_endian(start: int, size: int) -> Column:
    """The number in ``size`` bytes of ``data``."""
    digits = [F.hex(F.substring("data", start + i + 1, 1)) for i in reversed(range(size))]
    return F.conv(F.concat(*digits), 16, 10).cast("long")


def _read_directories(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_MEMBER`` rows of the wanted members, from archives' names, sizes and last bytes."""
    for batch in batches:
        rows = []
        for archive, size, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                before = size - len(data)
                infos = sorted(z.infolist(), key=lambda info: info.header_offset)
                ends = [info.header_offset for info in infos[1:]] + [z.start_dir]
                for info, end in zip(infos, ends, strict=False):
                    place = member_of_interest(info.filename)
                    if place is not None:
                        raw = info.orig_filename.encode("utf-8" if info.flag_bits & 0x800 else "cp437")
                        rows.append((archive, raw, info.filename, *place, info.CRC, info.compress_size,
                                     info.file_size, info.compress_type, info.flag_bits,
                                     info.header_offset + before, end + before))
        columns = list(zip(*rows, strict=True)) or [()] * len(_MEMBER_FIELDS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, (_, kind) in zip(columns, _MEMBER_FIELDS, strict=True)],
            [name for name, _ in _MEMBER_FIELDS])


def _check_directories(spark: SparkSession, path: str, ends: DataFrame) -> None:
    """An archive without a directory at its end is an error."""
    # Lists the files and reads none of them.
    listed = _archive_files(spark, spark.read.format("binaryFile"), path).load(path)
    listed = listed.select(F.col("_metadata.file_path").alias("archive"))
    broken = [r["archive"] for r in listed.join(ends, "archive", "left_anti").limit(5).collect()]
    if broken:
        raise ValueError(f"not whole zip archives: {', '.join(broken)}")


def _wanted_members(spark: SparkSession, path: str) -> DataFrame:
    """The wanted members with what follows their signatures, ``data``, read from a staged table.

    One scan of the archives, whose tasks may share an archive; directories are read in tasks
    too. A further scan, of the archives concerned, is for members whose data hold the
    signature, or that occur in the same form within another entry.
    """
    raw_name = F.expr(f"substring(data, {HEADER + 1}, int(name_bytes))")
    entries = _entries(spark, path).withColumn("name_bytes", _little_endian(22, 2)).withColumns({
        "raw_name": raw_name,
        "is_end": F.contains("data", F.lit(END)),
        # Coarse, on bytes: the directory decides.
        "may_be": F.coalesce(F.decode(raw_name, "ISO-8859-1").rlike("__general__.*precinct[.]csv$"), F.lit(False))})
    stored = stage(entries.filter("is_end or may_be").select(
        "archive", "size", "at", "is_end", "may_be", "raw_name", _little_endian(10, 4).alias("_crc"),
        (F.octet_length("data") - HEADER - F.col("name_bytes") - _little_endian(24, 2)).alias("_packed"), "data"),
        "entries")
    # Ends of archives within an archive come before its own.
    ends = stored.filter("is_end").groupBy("archive").agg(
        F.max("size").alias("size"), F.max_by("data", "at").alias("data"))
    members = stage(ends.mapInArrow(_read_directories, _MEMBER), "members")
    _check_directories(spark, path, stored.filter("is_end").select("archive"))

    side = F.broadcast(members) if fits_broadcast(members) else members
    streamed = F.col("flags").bitwiseAND(8) != 0  # its entry does not know its checksum
    matched = stored.filter("may_be").join(side, ["archive", "raw_name"]).filter(
        (streamed | (F.col("_crc") == F.col("crc"))) & (F.col("_packed") >= F.col("packed_bytes")))
    names = [name for name, _ in _MEMBER_FIELDS]
    matched = matched.select(*names, "data")
    once = matched.groupBy("archive", "offset").agg(F.count("*").alias("n")).filter("n = 1")
    odd = stage(members.join(once, ["archive", "offset"], "left_anti"), "odd")
    if odd.isEmpty():
        return matched
    even = matched.join(odd.select("archive", "offset"), ["archive", "offset"], "left_anti")
    return even.unionByName(stage(_by_offset(spark, path, odd).select(*names, "data"), "odd-members"))


def _by_offset(spark: SparkSession, path: str, odd: DataFrame) -> DataFrame:
    """Members with the bytes from their offset to the next entry."""
    entries = _entries(spark, path)
    concerned = odd.select("archive").distinct()
    if fits_broadcast(concerned):
        concerned = F.broadcast(concerned)
    # Stored, as row numbers hold for one scan only.
    pieces = stage(entries.join(concerned, "archive", "left_semi").select("archive", "at", "data"), "pieces")
    in_order = Window.partitionBy("archive").orderBy("at")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    # Numbers only. A piece begins behind the signature that ends the one before, so one that
    # begins at the end of a member follows a signature in it.
    places = pieces.select("archive", "at", F.coalesce(
        F.sum(F.octet_length("data") + len(ENTRY)).over(before), F.lit(0)).alias("begin"))
    marks = odd.select("archive", F.lit(None).cast(pieces.schema["at"].dataType).alias("at"),
                       (F.col("offset") + len(ENTRY)).alias("begin"), "offset", "end")
    marked = places.withColumns({"offset": F.lit(None).cast("long"), "end": F.lit(None).cast("long")}).unionByName(marks)
    so_far = Window.partitionBy("archive").orderBy("begin", F.col("at").isNotNull())
    owned = marked.select("archive", "at", "begin", F.last("offset", True).over(so_far).alias("offset"),
                          F.last("end", True).over(so_far).alias("end"))
    owned = owned.filter(F.col("at").isNotNull() & (F.col("begin") <= F.col("end"))).select("archive", "at", "offset")
    whole = pieces.join(owned, ["archive", "at"]).groupBy("archive", "offset").agg(
        F.array_sort(F.collect_list(F.struct("at", "data"))).alias("parts"))
    data = F.expr(f"""aggregate(slice(parts, 2, size(parts)), parts[0].data,
                      (whole, part) -> concat(whole, X'{ENTRY.hex()}', part.data))""")
    return odd.join(whole.select("archive", "offset", data.alias("data")), ["archive", "offset"])


def _opened(member: dict) -> IO[bytes]:
    """A member from its entry alone, checked by its checksum."""
    info = zipfile.ZipInfo(member["name"])
    info.orig_filename = member["raw_name"].decode("utf-8" if member["flags"] & 0x800 else "cp437")
    info.CRC, info.compress_size, info.file_size = member["crc"], member["packed_bytes"], member["file_bytes"]
    info.compress_type, info.flag_bits, info.header_offset = member["method"], member["flags"], 0
    # An archive whose directory is empty.
    content = io.BytesIO(b"".join([ENTRY, member["data"], END, bytes(18)]))
    return zipfile.ZipFile(content).open(info)


_LINE_FIELDS = pa.schema([
    ("state", pa.string()), ("year", pa.string()), ("file", pa.string()), ("file_bytes", pa.int64()),
    ("line_no", pa.int64()), ("line", pa.string()), ("valid", pa.bool_())])


def _member_lines(member: dict, headers_only: bool) -> Iterator[pa.RecordBatch]:
    file = f"{member['archive']}!/{member['name']}"
    with _opened(member) as raw:
        first = 0
        for lines in _line_blocks(raw, HEADER_BYTES if headers_only else BLOCK_BYTES):
            lines = lines[:1] if headers_only else lines
            text, valid = _as_text(lines)
            same = [pa.repeat(pa.scalar(value, field.type), len(lines)) for value, field in zip(
                (member["state"], member["year"], file, member["file_bytes"]), _LINE_FIELDS, strict=False)]
            numbers = pa.array(range(first, first + len(lines)), pa.int64())
            yield pa.RecordBatch.from_arrays([*same, numbers, text, pa.array(valid)], schema=_LINE_FIELDS)
            if headers_only:
                return
            first += len(lines)


def open_archives(spark: SparkSession, path: str) -> DataFrame:
    """The wanted members of one archive, a folder of them, or a pattern, still packed.

    Read by Spark, so the archives may be wherever it reads. An archive that is cut off is an error.
    """
    return _wanted_members(spark, path)


def member_lines(members: DataFrame, *, groupBytes: int = GROUP_BYTES, headersOnly: bool = False) -> DataFrame:
    """The lines of the members of ``open_archives``; see ``read_archive_members``."""
    if headersOnly:
        dealt = members
    else:
        size = members.agg(F.count("*").alias("n"), F.sum("file_bytes").alias("bytes")).first()
        held = size["bytes"] or 0
        # Small archives too are for all cores.
        few = min(members.sparkSession.sparkContext.defaultParallelism, math.ceil(held / LEAST_BYTES))
        groups = max(1, min(size["n"], max(few, math.ceil(held / groupBytes))))
        turn = F.pmod(F.xxhash64("archive", "offset"), F.lit(groups)).cast("int")
        dealt = members.coalesce(1) if groups == 1 else members.repartitionById(groups, turn)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                member = batch.slice(row, 1).to_pylist()[0]
                yield from _member_lines(member, headersOnly)

    return dealt.mapInArrow(lines, LINE_SCHEMA)


def read_archive_members(spark: SparkSession, path: str, **options: int | bool) -> DataFrame:
    """Non-blank lines of the wanted members of one archive, or of a folder of archives.

    ``line_no`` counts from 0, the header line. A line that is not UTF-8 is not ``valid``, and
    its bad bytes are replaced. Options are ``groupBytes``, the
    uncompressed size of the members per task, and ``headersOnly``. The archives are read
    when this is called, the members when the lines are.
    """
    return member_lines(open_archives(spark, path), **options)


def write_members(lines: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Store member lines as Parquet by state folder and year folder."""
    lines.write.mode(mode).partitionBy("state", "year").parquet(path)
