import pytest
from pyspark.sql import functions as F

from tallyframe import operators as ops
from tallyframe.fixtures import election
from tallyframe.sources import STATE_ABBREVIATIONS, load_population, read_results, write_results

RAW = "office string, precinct string, party string, votes bigint, state string, year string"
CLEAN = "state string, year string, office string, votes bigint"


def raw(spark, *rows):
    return spark.createDataFrame(rows, RAW)


@pytest.mark.parametrize("text, name", [
    ("r", "Republican"), (" REP ", "Republican"), ("Republican", "Republican"),
    ("D", "Democratic"), ("dem", "Democratic"), ("democrat", "Democratic"),
    ("Democratic", "Democratic"), ("LIB", "Libertarian"), ("l", "Libertarian"),
    ("Green", "Green"), ("g", "Green"), ("WFP", "Other"), ("", "Other"), (None, "Other"),
])
def test_party(spark, text, name):
    df = spark.createDataFrame([(text,)], "party string")
    label = df.select(ops.canonical_party().alias("party"))
    assert label.first()[0] == name
    if name in ("Republican", "Democratic", "Green"):
        assert label.select(ops.canonical_party()).first()[0] == name


def test_clean_rules(spark):
    df = raw(
        spark,
        ("President", "P1", "DEM", 5, "openelections-data-al ", "2012"),
        ("President", "P1", "dem", 5, "openelections-data-al", "2012"),  # same after cleaning
        ("President", "P1", None, 0, "openelections-data-al", "2012"),
        ("President", " TOTAL votes", "dem", 5, "openelections-data-al", "2012"),
        ("President", "Subtotal", "dem", 5, "openelections-data-al", "2012"),
        ("President", None, "dem", 5, "openelections-data-al", "2012"),
        ("President", "P1", "dem", -1, "openelections-data-al", "2012"),
        ("President", "P1", "dem", None, "openelections-data-al", "2012"),
    )
    got = sorted(map(tuple, ops.clean_results(df).collect()))
    assert got == [("al", "P1", "2012", "President", 0, "Other"),
                   ("al", "P1", "2012", "President", 5, "Democratic")]
    assert ops.clean_results(df, dedupe=False).count() == 3


def test_clean_golden(spark, medium):
    clean = ops.clean_results(election(spark, medium))
    assert clean.count() == 54_462
    assert ops.profile_categories(clean, "party").first().asDict() == {"party": "Democratic", "n": 18_069}


def test_profile(spark):
    df = raw(
        spark,
        ("President", "P1", "dem", 5, "al", "2012"), ("President", "P1", "dem", 5, "al", "2012"),
        ("President", "P1", "dem", 5, "al", "2012"), ("President", None, "rep", 9, "al", "2012"),
        ("President", None, "rep", 9, "al", "2012"), ("Governor", "P2", None, None, "ga", None),
        ("President", " ", "rep", 99, "ga", "2012"), ("President", "P3", "", 98, "ga", "2012"),
    )
    assert {r.column_name: r.missing_count for r in ops.profile_missing(df).collect()} == {
        "office": 0, "precinct": 2, "party": 1, "votes": 1, "state": 0, "year": 1}
    assert ops.profile_duplicates(df).first()[0] == 5
    assert ops.profile_duplicates(df.limit(0)).first()[0] == 0
    assert ops.profile_row_count(df).first()[0] == 8
    assert [(r.column_name, r.column_type) for r in ops.profile_schema(df).collect()] == [
        tuple(c.split()) for c in RAW.split(", ")]
    assert [tuple(r)[:4] for r in ops.profile_columns(df).collect()][1] == ("precinct", "string", 8, 2)
    assert tuple(ops.profile_numeric(df, "votes").first()) == (5, 99, pytest.approx(230 / 7))
    assert [tuple(r) for r in ops.profile_categories(df, "party").collect()] == [
        ("dem", 3), ("rep", 3), ("", 1)]
    top = ops.profile_top_rows(df, "votes", 5, where=F.col("office") == "President",
                               non_blank=("precinct", "party"))
    assert [r.votes for r in top.collect()] == [5, 5, 5]
    sums = ops.profile_top_groups(df, "state", "votes", 1)
    assert [tuple(r) for r in sums.collect()] == [("ga", 197)]


def test_missing_is_one_scan(spark, medium, plan):
    df = spark.read.parquet(f"{medium}/events.parquet")
    assert plan(ops.profile_missing(df)).count("FileScan") == 1


def test_did(spark):
    df = spark.createDataFrame([
        ("al", "2012", "President", 100), ("al", "2012", "Governor", 20), ("al", "2016", "President", 150),
        ("ga", "2012", "President", 10), ("ga", "n/a", "President", 10), ("ga", "2016", "President", 40),
        ("ky", "2012", "President", 70),  # never voted after
        ("wa", "2012", "President", 30), ("wa", "2016", "President", 35),
        ("mn", "2008", "President", 30),  # neither year
        ("tx", "2012", "President", 999),  # not asked for
    ], CLEAN)
    treated, control = ["al", "ga", "ky"], ["wa", "mn"]
    turnout = ops.turnout_pre_post(df, treated, control, 2012, 2016)
    assert {r.state: tuple(r)[1:] for r in turnout.collect()} == {
        "al": (120.0, 150.0, 30.0), "ga": (10.0, 40.0, 30.0), "ky": (70.0, None, None),
        "wa": (30.0, 35.0, 5.0), "mn": (None, None, None)}
    assert ops.did_effect(turnout, treated, control).first()[0] == 25.0
    long = ops.did_group_means(turnout, treated, 2012, 2016)
    assert {tuple(r)[:2]: r.turnout for r in long.collect()} == {
        ("Treated", "2012"): pytest.approx(200 / 3), ("Treated", "2016"): 95.0,
        ("Control", "2012"): 30.0, ("Control", "2016"): 35.0}
    president = ops.turnout_pre_post(df, treated, control, 2012, 2016, office="President")
    assert president.filter("state = 'al'").first().pre_turnout == 100.0


def test_turnout_rate_drops_outliers(spark, plan):
    states = [f"s{i:02d}" for i in range(20)]
    rows = [(s, "2016", "President", 500 + i) for i, s in enumerate(states)]
    rows += [("zz", "2016", "President", 90_000), ("s00", "2012", "President", 7),
             ("s00", "2016", "Governor", 7), ("none", "2016", "President", 0),
             ("unknown", "2016", "President", 5)]
    df = spark.createDataFrame(rows, CLEAN)
    pop = spark.createDataFrame([(s, 1000.0) for s in [*states, "zz", "none", "quiet"]],
                                "state string, POPESTIMATE2016 double")
    rates = ops.turnout_rate(df, pop, 2016)
    got = {r.state: (r.total_votes, r.turnout_rate) for r in rates.collect()}
    assert got == {s: (500 + i, (500 + i) / 1000) for i, s in enumerate(states)}
    assert ops.turnout_rate(df, pop, 2016, max_sigma=None).count() == 21
    means = ops.battleground_comparison(rates, ["s00", "s01", "zz"]).first()
    assert means.battleground_mean == pytest.approx(0.5005)
    assert means.non_battleground_mean == pytest.approx(0.5105)
    assert "CartesianProduct" not in plan(rates) and "NestedLoop" not in plan(rates)


def test_one_state_has_no_spread(spark):
    df = spark.createDataFrame([("al", "2016", "President", 5)], CLEAN)
    pop = spark.createDataFrame([("al", 10.0)], "state string, POPESTIMATE2016 double")
    assert ops.turnout_rate(df, pop, 2016).count() == 0


def test_population_csv(spark, tmp_path):
    path = tmp_path / "pop.csv"
    path.write_text("SUMLEV,NAME,POPESTIMATE2012,POPESTIMATE2016\n"
                    "10,United States,1,2\n40, New York ,19,20\n40,ALABAMA,4,x\n40,Puerto Rico,3,3\n")
    got = load_population(spark, str(path)).orderBy("state").collect()
    assert [(r.state, r.POPESTIMATE2012, r.POPESTIMATE2016) for r in got] == [
        ("al", 4.0, None), ("ny", 19.0, 20.0)]
    assert len(STATE_ABBREVIATIONS) == len(set(STATE_ABBREVIATIONS.values())) == 50
    path.write_text("STATE,POP\n1,2\n")
    with pytest.raises(ValueError):
        load_population(spark, str(path))


def test_year_prunes_partitions(spark, medium, tmp_path, plan):
    path = str(tmp_path / "results")
    write_results(ops.clean_results(election(spark, medium)), path)
    results = read_results(spark, path)
    pop = spark.createDataFrame([(f"{i:02d}", 1000.0) for i in range(25)],
                                "state string, POPESTIMATE2000 double")
    rates = ops.turnout_rate(results, pop, 2000)
    assert rates.count() == 25
    text = plan(rates)
    assert "PartitionFilters: [isnotnull(year" in text
    assert "EqualTo(office,President)" in text
    # Mean and deviation reuse the votes per state.
    assert "ReusedExchange" in text
