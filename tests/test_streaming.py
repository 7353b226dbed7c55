import pytest
from tallyframe import operators as ops
from tallyframe.streaming import (
    append_to_table,
    count_hours_in_batches,
    read_hour_counts,
    read_placements_stream,
)

HEADER = "timestamp,user_id,pixel_color,coordinate\n"


def write(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(f'{t} UTC,{u},{c},"{p}"\n' for t, u, c, p in rows))


def test_files_are_taken_once(spark, tmp_path):
    folder, table, offsets = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "offsets")
    rows = [(f"2022-04-0{1 + i % 3} 0{i % 9}:00:00", f"u{i}", "#FFF", "1,2") for i in range(30)]

    def run():
        stream = read_placements_stream(spark, str(folder))
        append_to_table(stream, table, offsets, ["event_date"]).awaitTermination()
        return spark.read.parquet(table)

    write(folder, "a.csv", [*rows[:10], ("junk", "u", "#FFF", "1,2")])
    assert run().count() == 10
    write(folder, "b.csv", rows[10:])
    run()
    got = run()
    assert sorted(r.user_id for r in got.select("user_id").collect()) == sorted(r[1] for r in rows)
    assert got.filter("event_date = '2022-04-02'").count() == 10


def test_wrong_header_stops(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('user_id,timestamp,pixel_color,coordinate\nu,x,#FFF,"1,2"\n')
    query = append_to_table(read_placements_stream(spark, str(folder)), str(tmp_path / "t"),
                            str(tmp_path / "offsets"))
    with pytest.raises(Exception, match="header"):
        query.awaitTermination()


def test_late_files_and_open_hours_count(spark, tmp_path):
    folder, table, offsets = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "offsets")
    rows = [(f"2022-04-01 0{h}:{m:02d}:00", "u", c, "1,2")
            for h in range(6) for m, c in enumerate(["#FFF", " #fff ", "#000"] * (h + 1))]
    # The last hours come first.
    for h in (5, 0, 3, 1, 4, 2):
        write(folder, f"{h}.csv", [r for r in rows if r[0][12] == str(h)])
        stream = read_placements_stream(spark, str(folder))
        count_hours_in_batches(stream, "pixel_color", table, offsets).awaitTermination()
    from tallyframe.sources import read_placements_csv

    batch = ops.hourly_counts(read_placements_csv(spark, str(folder)), "pixel_color")
    got = read_hour_counts(spark, table, "pixel_color")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert spark.read.parquet(table).select("batch_id").distinct().count() == 6
