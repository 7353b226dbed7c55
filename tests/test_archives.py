import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyframe.sources import archive as source
from tallyframe.sources import ingest_election_archive, ingest_election_csvs, read_archive_members

HEADER = "votes,precinct\n"


def name(state, number=0, year=2012):
    return f"all/openelections-data-{state}/{year}/x{number}__general__precinct.csv"


def lines_of(spark, path, **options):
    rows = read_archive_members(spark, str(path), **options).collect()
    return sorted((r.state[-2:], r.file.split("!/")[1], r.line_no, r.line) for r in rows)


def wanted(files):
    return sorted((n.split("/")[1][-2:], n, i, line) for n, text in files.items()
                  for i, line in enumerate(text.split("\n")) if line)


def zipped(files, method=zipfile.ZIP_DEFLATED, target=None):
    content = target or io.BytesIO()
    with zipfile.ZipFile(content, "w", method) as z:
        for n, text in files.items():
            z.writestr(n, text)
    return content


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_many_tasks_share_an_archive(spark, tmp_path, method):
    rng = random.Random(1)
    files = {name("al", i): HEADER + "".join(f"{rng.random()},P{i}\n" for _ in range(300)) for i in range(30)}
    path = tmp_path / "a.zip"
    path.write_bytes(zipped(files | {"notes.txt": "x" * 5000}, method).getvalue())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert source._entries(spark, str(path)).rdd.getNumPartitions() > 3
        assert lines_of(spark, path, groupBytes=20_000) == wanted(files)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_data_that_hold_signatures(spark, tmp_path):
    end, entry = "PK\x05\x06", "PK\x03\x04"
    files = {
        name("al"): HEADER + f"1,{entry}\n2,{entry}{entry}x\n", name("ga"): HEADER + "3,P\n",
        name("ky"): entry + "\n" + entry, name("ny"): HEADER + f"4,{end}{'z' * 40}\n",
        name("wa"): "", name("wi"): end + entry + end}
    path = tmp_path / "a.zip"
    path.write_bytes(zipped(files, zipfile.ZIP_STORED).getvalue())
    assert lines_of(spark, path) == wanted(files)


def test_an_archive_within_an_archive(spark, tmp_path):
    same = {name("al"): HEADER + "1,P\n"}
    inner = same | {name("ga"): HEADER + "2,Q\n"}
    outer = tmp_path / "a.zip"
    with zipfile.ZipFile(outer, "w", zipfile.ZIP_STORED) as z:
        z.writestr("copy/inner.zip", zipped(inner, zipfile.ZIP_STORED).getvalue())
        z.writestr(name("al"), same[name("al")])  # the same entry in both
        z.writestr(name("ky"), HEADER + "3,R\n")
        z.writestr("copy/last.zip", zipped(inner).getvalue())
    assert lines_of(spark, outer) == wanted(same | {name("ky"): HEADER + "3,R\n"})


class Pipe(io.RawIOBase):
    """A target that cannot seek, so that entries do not know their sizes."""

    def __init__(self):
        self.content = b""

    def writable(self):
        return True

    def write(self, data):
        self.content += bytes(data)
        return len(data)


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED])
def test_archives_written_as_streams(spark, tmp_path, method):
    files = {name("al", i): HEADER + f"{i},P\n" * i for i in range(5)}
    path = tmp_path / "a.zip"
    path.write_bytes(_stream(files, method))
    assert lines_of(spark, path) == wanted(files)


def _stream(files, method):
    pipe = Pipe()
    zipped(files, method, pipe)
    return pipe.content


def test_deleted_entries_and_bytes_around(spark, tmp_path):
    path = tmp_path / "a.zip"
    path.write_bytes(zipped({name("al"): HEADER + "1,old\n"}).getvalue())
    with zipfile.ZipFile(path, "a") as z, pytest.warns(UserWarning):
        z.writestr(name("al"), HEADER + "2,new\n")
        z.comment = b"the end"
        # The directory no longer has the first one.
        z.filelist.pop(0)
    data = path.read_bytes()
    path.write_bytes(b"#!/bin/sh\n" + data + b"\n")
    assert lines_of(spark, path) == wanted({name("al"): HEADER + "2,new\n"})


def test_names_beyond_ascii_and_a_folder_of_archives(spark, tmp_path):
    for i, state in enumerate(["nm", "pr"]):
        files = {f"all/openelections-data-{state}/2012/Doña{i}__general__precinct.csv": HEADER + "1,Ñ\n"}
        (tmp_path / f"{i}.zip").write_bytes(zipped(files).getvalue())
    (tmp_path / "readme.txt").write_text("no archive")
    rows = read_archive_members(spark, str(tmp_path)).filter("line_no = 1").collect()
    assert sorted((r.state, r.line) for r in rows) == [
        ("openelections-data-nm", "1,Ñ"), ("openelections-data-pr", "1,Ñ")]


def test_broken_archives_stop(spark, tmp_path):
    whole = zipped({name("al"): HEADER + "1,P\n" * 50}, zipfile.ZIP_STORED).getvalue()
    (tmp_path / "cut.zip").write_bytes(whole[:-30])
    with pytest.raises(ValueError, match="cut.zip"):
        read_archive_members(spark, str(tmp_path / "cut.zip"))
    (tmp_path / "text.zip").write_text("no archive")
    with pytest.raises(ValueError, match="text.zip"):
        read_archive_members(spark, str(tmp_path / "text.zip"))
    damaged = whole.replace(b"1,P\n1,P", b"1,Q\n1,P", 1)
    (tmp_path / "damaged.zip").write_bytes(damaged)
    with pytest.raises(Exception, match="CRC"):
        read_archive_members(spark, str(tmp_path / "damaged.zip")).collect()


def test_archives_that_only_the_cluster_can_open(spark, tmp_path):
    """A mount that Python knows nothing of."""
    files = {name("al"): HEADER + "1,P\n", name("ga"): HEADER + "2,PK\x03\x04\n"}
    (tmp_path / "far").mkdir()
    (tmp_path / "far" / "a.zip").write_bytes(zipped(files, zipfile.ZIP_STORED).getvalue())
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.tally.link./far", f"file://{tmp_path}/far")
    for path in ("viewfs://tally/far/a.zip", "viewfs://tally/far"):
        assert lines_of(spark, path) == wanted(files)
    rows, skipped = ingest_election_archive(spark, "viewfs://tally/far")
    assert sorted((r.votes, r.precinct) for r in rows.collect()) == [(1, "P"), (2, "PK\x03\x04")]
    assert skipped.count() == 0


def test_one_scan_of_lines_for_all_layouts(spark, tmp_path):
    folder = tmp_path / "ny" / "2012"
    folder.mkdir(parents=True)
    for width in (2, 5, 11, 30):
        names = [f"c{i}" for i in range(width - 2)] + ["precinct", "votes"]
        (folder / f"w{width}.csv").write_text(",".join(names) + "\n" + ",".join("x" * (width - 2)) + (
            "," if width > 2 else "") + f"P{width},{width}\n")
    scans = []

    def staged(df, label, stage=source.stage):
        if label == "conformed":
            scans.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan text"))
        return stage(df, label)

    from tallyframe.sources import election_csv

    before, election_csv.stage = election_csv.stage, staged
    try:
        rows = ingest_election_csvs(spark, str(tmp_path)).rows
    finally:
        election_csv.stage = before
    assert sorted((r.precinct, r.votes) for r in rows.collect()) == [("P11", 11), ("P2", 2), ("P30", 30), ("P5", 5)]
    assert scans == [1]
    assert rows.select(F.sum("votes")).first()[0] == 48
