import gzip
import io
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyframe.plans import staging
from tallyframe.sources import (
    election_csv,
    ingest_election_archive,
    ingest_election_csvs,
    ingest_placements,
    read_archive_members,
    read_placements_csv,
    read_results,
    write_members,
    write_placements,
    write_results,
)
from tallyframe.sources.archive import _line_blocks, member_of_interest
from tallyframe.sources.tables import RESULTS_SCHEMA


@pytest.fixture
def history(tmp_path):
    text = ("timestamp,user_id,pixel_color,coordinate\n"
            '2022-04-04 00:53:51.577 UTC,abc==,#00CCC0,"826,1048"\n'
            '2022-04-05 00:53:53 UTC,def==,#94B3FF,"583,1031"\n'
            'yesterday,ghi==,#000000,"1,2"\n'
            '2022-04-04 10:00:00.1 UTC,,,\n')
    path = tmp_path / "history.csv.gzip"
    path.write_bytes(gzip.compress(text.encode()))
    return str(path)


def test_ingest_placements(spark, history, tmp_path):
    out = str(tmp_path / "table")
    df = ingest_placements(spark, history, out)
    got = df.select(F.col("ts").cast("string"), "user_id", "pixel_color", "coordinate",
                    F.col("event_date").cast("string")).collect()
    assert sorted(map(tuple, got)) == [
        ("2022-04-04 00:53:51.577", "abc==", "#00CCC0", "826,1048", "2022-04-04"),
        ("2022-04-04 10:00:00.1", None, None, None, "2022-04-04"),
        ("2022-04-05 00:53:53", "def==", "#94B3FF", "583,1031", "2022-04-05"),
    ]
    # A second conversion leaves the table alone.
    again = ingest_placements(spark, str(tmp_path / "*.gzip"), out)
    assert again.inputFiles() == df.inputFiles()


def test_bad_time_can_fail(spark, history):
    with pytest.raises(Exception, match="invalid timestamp: yesterday"):
        read_placements_csv(spark, history, on_bad_time="fail").collect()
    with pytest.raises(ValueError):
        read_placements_csv(spark, history, on_bad_time="keep")


def test_columns_are_taken_by_name(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text("coordinate,extra,user_id,pixel_color,timestamp\n"
                    '"1,2",z,u,#FFF,2022-04-04 00:53:51 UTC\n')
    row = read_placements_csv(spark, str(path)).first()
    assert (row.user_id, row.pixel_color, row.coordinate) == ("u", "#FFF", "1,2")


def test_files_of_other_order_stop_the_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text('timestamp,user_id,pixel_color,coordinate\n'
                                    '2022-04-04 00:53:51 UTC,u,#FFF,"1,2"\n')
    (tmp_path / "b.csv").write_text('user_id,timestamp,pixel_color,coordinate\n'
                                    'u,2022-04-04 00:53:51 UTC,#FFF,"1,2"\n')
    with pytest.raises(Exception, match="header"):
        read_placements_csv(spark, str(tmp_path)).collect()


def test_a_hot_date_is_split(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")
    try:
        df = spark.range(60_000).select(
            F.timestamp_seconds(1_650_000_000 + F.col("id")).alias("ts"),
            F.concat(F.lit("user"), F.xxhash64("id").cast("string")).alias("user_id"),
            F.when(F.col("id") % 3 == 0, F.lit("2022-04-01")).otherwise(
                F.concat(F.lit("2022-04-1"), (F.col("id") % 9).cast("string")))
            .cast("date").alias("event_date"))
        write_placements(df, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(path)
    assert stored.count() == 60_000
    files = [f for f in stored.inputFiles() if "event_date=2022-04-01" in f]
    assert len(files) > 1
    one = [r.ts for r in spark.read.parquet(files[0]).collect()]
    assert one == sorted(one)


def test_results_keep_their_types(spark, tmp_path):
    path = str(tmp_path / "results")
    rows = [("00", "P", "2012", "President", 5, "Other"), ("al", "P", "n/a", "Governor", 7, "Green")]
    df = spark.createDataFrame(rows, RESULTS_SCHEMA)
    write_results(df, path)
    write_results(df.limit(0), path)
    stored = read_results(spark, path)
    assert sorted(map(tuple, stored.collect())) == rows
    assert stored.schema == df.schema


FILES = {
    "openelections-data-al/2012/a.csv":
        "county,precinct,office,party,candidate,votes\n"
        'X,P1,President,DEM,"Doe, Jane",10\n'
        "\n"
        'X,"P ""2""",President,,"Roe",12.0\n'
        "X,,President,REP,Roe,\n",
    # other order, BOM, CRLF, no party
    "openelections-data-al/2016/b.csv":
        "﻿votes,precinct,office\r\n7,P1,Governor\r\nN/A,P2,Governor\r\n",
    # no votes; a repeated header is then a row of text
    "openelections-data-ga/2012/c.csv":
        "precinct,party,office\nP1,rep,President\nprecinct,party,office\n",
    "openelections-data-ga/2016/empty.csv": "office,precinct,party,votes\n",
    # files left out
    "openelections-data-ky/2012/thousands.csv":
        'office,precinct,party,votes\nPresident,P1,dem,5\nPresident,P2,dem,"1,234"\n',
    "openelections-data-ky/2012/fraction.csv":
        "office,precinct,party,votes\nPresident,P1,dem,12.5\n",
    "openelections-data-ky/2012/short.csv":
        "office,precinct,party,votes\nPresident,P1,dem,5\nPresident,P1,dem\n",
    "openelections-data-ky/2012/long.csv":
        "office,precinct,party,votes\nPresident,P1,dem,5,6\n",
    "openelections-data-ky/2012/twice.csv":
        "office,precinct,party,votes\nPresident,P1,dem,5\noffice,precinct,party,votes\n",
    "openelections-data-ky/2012/same.csv":
        "office,votes,party,votes\nPresident,1,dem,5\n",
    "openelections-data-ky/2012/notes.txt": "office,precinct,party,votes\nPresident,P9,dem,5\n",
}

ROWS = [
    ("", "P1", "rep", 0, "openelections-data-ga", "2012"),
    ("Governor", "P1", "", 7, "openelections-data-al", "2016"),
    ("Governor", "P2", "", None, "openelections-data-al", "2016"),
    ("President", "", "REP", None, "openelections-data-al", "2012"),
    ("President", 'P "2"', "", 12, "openelections-data-al", "2012"),
    ("President", "P1", "DEM", 10, "openelections-data-al", "2012"),
    ("President", "P1", "rep", 0, "openelections-data-ga", "2012"),
    ("office", "precinct", "party", 0, "openelections-data-ga", "2012"),
]
ROWS.remove(ROWS[0])
PROBLEMS = {
    "thousands.csv": ("vote count", 1), "fraction.csv": ("vote count", 1),
    "short.csv": ("field count", 1), "long.csv": ("field count", 1),
    "twice.csv": ("vote count", 1), "same.csv": ("repeated column", 1),
}


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.fixture
def tree(tmp_path):
    for name, text in FILES.items():
        path = tmp_path / "tree" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text.encode())
    return str(tmp_path / "tree")


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_ingest_tree(spark, tree, limits):
    rows, skipped = ingest_election_csvs(spark, tree, **limits)
    assert ordered(rows.collect()) == ordered(ROWS)
    assert rows.columns == ["office", "precinct", "party", "votes", "state", "year"]
    assert dict(rows.dtypes)["votes"] == "bigint"
    got = {r.file.rsplit("/", 1)[-1]: (r.problem, r.lines) for r in skipped.collect()}
    assert got == PROBLEMS


def test_ingest_file_of_many_splits(spark, tmp_path):
    folder = tmp_path / "openelections-data-oh" / "2020"
    folder.mkdir(parents=True)
    body = "".join(f"P{i},President,dem,{i}\n" for i in range(20_000))
    (folder / "big.csv").write_text("precinct,office,party,votes\n" + body)
    (folder / "small.csv").write_text("votes,party,precinct,office\n3,rep,Q,President\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        rows, skipped = ingest_election_csvs(spark, str(tmp_path))
        assert tuple(rows.agg(F.count("*"), F.sum("votes"), F.count_distinct("precinct")).first()) == (
            20_001, sum(range(20_000)) + 3, 20_001)
        assert skipped.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_no_sort_of_lines(spark, tmp_path, monkeypatch):
    """Only heads of files and counts by file get sorted, whatever the number of lines."""
    staged = {}

    def stage(df, label):
        staged[label] = df._jdf.queryExecution().executedPlan().toString()
        return staging.stage(df, label)

    monkeypatch.setattr(election_csv, "stage", stage)
    folder = tmp_path / "openelections-data-oh" / "2020"
    folder.mkdir(parents=True)
    for i in range(3):  # small files share a task; two headers come after blank lines
        body = "".join(f"P{n},{n}\n" for n in range(25_000)) + ("Q,1.5\nR,1,2\nS\n" if i == 2 else "")
        (folder / f"{i}.csv").write_text("\n" * i + f"precinct,votes\n{body}")
    heads = election_csv._first_lines(election_csv.read_csv_tree(spark, str(tmp_path))).collect()
    assert [(r.file[-5:], r.header, r.weight) for r in sorted(heads)] == [
        (f"{i}.csv", "precinct,votes", (folder / f"{i}.csv").stat().st_size) for i in range(3)]
    rows, skipped = ingest_election_csvs(spark, str(tmp_path))
    assert tuple(rows.agg(F.count("*"), F.sum("votes")).first()) == (50_000, 2 * sum(range(25_000)))
    assert [(r.problem, r.lines) for r in skipped.collect()] == [("field count", 3)]
    assert "MapInArrow" in staged["headers"].rpartition("Sort [")[2]
    assert re.search(r"HashAggregate\(keys=\[file#\d+, problem#\d+\]", staged["skipped"])


def test_hive_style_and_escaped_folders(spark, tmp_path):
    folder = tmp_path / "state=data of 100%+ny" / "year=2012"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("votes,precinct\n1,P\n")
    row = ingest_election_csvs(spark, str(tmp_path)).rows.first()
    assert (row.state, row.year, row.votes) == ("data of 100%+ny", "2012", 1)


@pytest.mark.parametrize("name, wanted", [
    ("m/openelections-data-al/2012/20121106__al__general__precinct.csv", ("openelections-data-al", "2012")),
    ("openelections-data-al/2012/20121106__al__general__autauga__precinct.csv", ("openelections-data-al", "2012")),
    ("openelections-data-al-master/2012/x__general__precinct.csv", ("openelections-data-al-master", "2012")),
    ("openelections-data-al/2012/x__special__general__precinct.csv", None),
    ("openelections-data-al/2012/x__general__county.csv", None),
    ("openelections-data-al/2012/x__general____precinct.csv", None),
    ("openelections-data-al/2012/x__primary__precinct.csv", None),
    ("openelections-data-al/2012/x__general__precinct.csv.bak", None),
    ("openelections-data-al/2012/counties/x__general__precinct.csv", None),
    ("openelections-data-al/x__general__precinct.csv", None),
    ("elsewhere/2012/x__general__precinct.csv", None),
])
def test_member_filter(name, wanted):
    assert member_of_interest(name) == wanted


@pytest.fixture
def archive(tmp_path):
    path = tmp_path / "archive.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in FILES.items():
            if name.endswith(".csv"):
                stem = name.removesuffix(".csv")
                z.writestr(f"all/{stem}__general__x__precinct.csv", text)
        z.writestr("all/openelections-data-al/2012/special__general__precinct.csv", "votes\n1\n")
    return str(path)


@pytest.mark.parametrize("group", [1, 1 << 30])
def test_archive_lines(spark, archive, group):
    lines = read_archive_members(spark, archive, groupBytes=group)
    got = lines.filter("file like '%/b\\_\\_general%'").orderBy("line_no").collect()
    assert [(r.line_no, r.line, r.state, r.year) for r in got] == [
        (0, "votes,precinct,office", "openelections-data-al", "2016"),
        (1, "7,P1,Governor", "openelections-data-al", "2016"),
        (2, "N/A,P2,Governor", "openelections-data-al", "2016")]
    files = sum(n.endswith(".csv") for n in FILES)
    assert lines.select("file").distinct().count() == files
    assert lines.rdd.getNumPartitions() == (files if group == 1 else 1)


def test_archive_equals_tree(spark, archive):
    rows, skipped = ingest_election_archive(spark, archive)
    assert ordered(rows.collect()) == ordered(ROWS)
    assert {r.file.rsplit("/", 1)[-1].split("__")[0] + ".csv": (r.problem, r.lines)
            for r in skipped.collect()} == PROBLEMS


def test_archive_fan_out(spark, archive, tmp_path):
    out = str(tmp_path / "lines")
    lines = read_archive_members(spark, archive)
    write_members(lines, out)
    stored = spark.read.parquet(out).filter("state = 'openelections-data-al' and year = 2012")
    assert stored.count() == 4


def test_archive_without_wanted_members(spark, tmp_path):
    path = tmp_path / "none.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("README.md", "x")
    assert read_archive_members(spark, str(path)).count() == 0
    rows, skipped = ingest_election_archive(spark, str(path))
    assert (rows.count(), skipped.count()) == (0, 0)


def test_files_that_are_not_utf8_are_reported(spark, tmp_path):
    folder = tmp_path / "tree" / "ny" / "2012"
    folder.mkdir(parents=True)
    header = b"votes,precinct\n"
    contents = {
        "bad": header + b"1,Caf\xe9\n2,B\n", "head": b"votes,precinct,\xff\n1,A,x\n",
        "good": b"\xef\xbb\xbf" + header + "3,Café\n".encode()}
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        for name, content in contents.items():
            (folder / f"{name}.csv").write_bytes(content)
            z.writestr(f"openelections-data-ny/2012/{name}__general__precinct.csv", content)
    for rows, skipped in (ingest_election_csvs(spark, str(tmp_path / "tree")), ingest_election_archive(spark, path)):
        assert [(r.votes, r.precinct) for r in rows.collect()] == [(3, "Café")]
        assert sorted((r.problem, r.lines) for r in skipped.collect()) == [("not UTF-8", 1)] * 2


def test_lines_across_blocks():
    lines = [b"a" * n for n in (1, 5, 70, 3, 2)]
    for end in (b"\n", b"\r\n", b"\r"):
        content = b"\xef\xbb\xbf" + (end + end).join(lines)
        for size in (4, 7, 1000):
            got = [line for block in _line_blocks(io.BytesIO(content), size) for line in block]
            assert got == lines, (end, size)


def test_percent_signs_in_archive_names(spark, tmp_path):
    path = str(tmp_path / "50% done+.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("openelections-data-ny/2012/x__general__90%__precinct.csv", "votes,precinct\n1,P\n")
    row = ingest_election_archive(spark, path).rows.first()
    assert (row.state, row.year, row.votes) == ("openelections-data-ny", "2012", 1)


def test_ingest_of_some_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("pixel_color,timestamp\nred,2022-04-01 12:00:00.5 UTC\n")
    rows = ingest_placements(spark, str(tmp_path / "a.csv"), str(tmp_path / "t"), columns=("pixel_color",))
    assert rows.columns == ["ts", "pixel_color", "event_date"]
    assert rows.count() == 1
