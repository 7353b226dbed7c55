import pytest

from tallyframe.operators import turnout_pre_post
from tallyframe.sources import with_state, write_table
from tallyframe.sources.election_csv import ingest_election_archive, ingest_election_csvs


def test_only_a_finished_table_is_kept(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    path = str(tmp_path / "t")
    write_table(rows.limit(1), path, ("k",))
    write_table(rows, path, ("k",))
    assert spark.read.parquet(path).count() == 1
    (tmp_path / "t" / "_SUCCESS").unlink()
    with pytest.raises(FileExistsError):
        write_table(rows, path, ("k",))
    write_table(rows, path, ("k",), mode="overwrite")
    assert spark.read.parquet(path).count() == 2


def test_names_lose_all_white_space(spark):
    rows = spark.createDataFrame([("\tOhio \n",), ("Utah",)], "NAME string")
    assert sorted(r.state for r in with_state(rows).collect()) == ["oh", "ut"]


def test_state_without_the_years_keeps_its_row(spark, plan, tmp_path):
    rows = spark.createDataFrame(
        [("00", "1996", 5), ("00", "2000", 7), ("00", "2004", 9), ("01", "2004", 9)],
        "state string, year string, votes bigint")
    path = str(tmp_path / "t")
    rows.write.partitionBy("state", "year").parquet(path)
    stored = spark.read.schema("votes bigint, state string, year string").parquet(path)
    got = turnout_pre_post(stored, ["00"], ["01"], 1996, 2000)
    assert sorted(map(tuple, got.collect())) == [("00", 5.0, 7.0, 2.0), ("01", None, None, None)]
    assert "try_cast" in plan(got).lower() or "cast(year" in plan(got)


def tree(root, files):
    for name, text in files.items():
        file = root / "openelections-data-oh" / "2000" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)


def test_a_wide_file_is_parsed_as_far_as_it_is_wanted(spark, tmp_path):
    wide = ",".join(f"x{i}" for i in range(700)) + ",votes"
    tree(tmp_path, {
        "a.csv": "office,precinct,party,votes\nP,p1,d,3\n",
        "b.csv": wide + "\n" + "," * 700 + "8\n",
        "c.csv": "office,precinct,party,votes," + ",".join(f"y{i}" for i in range(500)) + "\n"})
    got = ingest_election_csvs(spark, str(tmp_path))
    assert sorted((r.office, r.votes, r.state, r.year) for r in got.rows.collect()) == [
        ("", 8, "openelections-data-oh", "2000"), ("P", 3, "openelections-data-oh", "2000")]
    assert got.skipped.count() == 0


def test_percent_and_plus_in_archive_names(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "50% done+x.zip", "w") as z:
        z.writestr("openelections-data-oh/2000/x__general__90%__precinct.csv",
                   "office,precinct,party,votes\nP,p1,d,3\n")
    got = ingest_election_archive(spark, str(tmp_path / "50% done+x.zip")).rows.collect()
    assert [(r.state, r.year, r.votes) for r in got] == [("openelections-data-oh", "2000", 3)]
