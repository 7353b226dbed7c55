"""Placement, election and population tables derived from the test tables."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.plans.staging import stage


# Stated, so that reading a table needs no job to infer them.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_placements(table(spark, sf_dir, "events"))


def arrivals(placements: DataFrame, count: int = 3, late: str = "1 day") -> list[DataFrame]:
    """The placements in the parts in which they arrive, by time.

    A seventh of the rows of the last ``late`` before a part ends come with the next one.
    """
    lo, hi = placements.agg(F.min("ts"), F.max("ts")).first()
    step = (hi - lo) / count
    edges = [lo + step * (i + 1) for i in range(count - 1)]
    kind = placements.schema["ts"].dataType
    part = F.lit(0)
    for edge in edges:
        end = F.lit(edge).cast(kind)
        is_late = (F.col("ts") >= end - F.expr(f"INTERVAL {late}")) & (F.pmod(F.xxhash64("ts", "user_id"), F.lit(7)) == 0)
        part = part + F.when((F.col("ts") >= end) | is_late, 1).otherwise(0)
    numbered = placements.withColumn("_part", part)
    return [numbered.filter(F.col("_part") == i).drop("_part") for i in range(count)]


def messy_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The placements with a NULL time, user or colour in some rows."""
    events = table(spark, sf_dir, "events")
    number = F.col("event_id")
    rows = _as_placements(events, "event_id")
    return rows.select(
        F.when(number % 10 != 0, F.col("ts")).alias("ts"), F.when(number % 8 != 1, F.col("user_id")).alias("user_id"),
        F.when(number % 9 != 2, F.col("pixel_color")).alias("pixel_color"), "coordinate")


def _as_placements(events: DataFrame, *kept: str) -> DataFrame:
    kind = F.col("event_type")
    form = F.col("event_id") % 3
    color = (
        F.when(form == 0, F.upper(kind))
        .when(form == 1, kind)
        .otherwise(F.concat(F.lit(" "), kind, F.lit(" ")))
    )
    x = F.floor(F.col("value") / 10).cast("int").cast("string")
    y = (F.col("user_id") % 10).cast("string")
    return events.select(
        "ts", "user_id", color.alias("pixel_color"), F.concat_ws(",", x, y).alias("coordinate"), *kept)


def _election_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw precinct rows, one per order line, with its keys."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    joined = (
        # Orders grow with the lines, so the two are shuffled at any size.
        lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    precinct = F.when(F.col("o_orderkey") % 50 == 0, "Total Votes").otherwise(
        F.concat_ws(" ", "c_mktsegment", (F.col("c_custkey") % 10).cast("string")))
    office = F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), "President")
    spellings = F.array(*map(F.lit, ("R", " dem ", "LIB", "green", "Democratic", "WFP")))
    return joined.select(
        office.otherwise("Governor").alias("office"),
        precinct.alias("precinct"),
        spellings[(F.col("o_custkey") % 6).cast("int")].alias("party"),
        F.col("l_quantity").cast("bigint").alias("votes"),
        F.concat(F.lit("openelections-data-"),
                 F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("state"),
        F.year("o_orderdate").cast("string").alias("year"),
        "l_orderkey", "l_partkey", "l_linenumber", "n_nationkey",
    )


RAW_COLUMNS = ("office", "precinct", "party", "votes", "state", "year")


def election(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw precinct rows, one per order line."""
    return _election_lines(spark, sf_dir).select(*RAW_COLUMNS)


def messy_election(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows with what cleaning and profiles are for: NULLs, blanks, negative votes, and a
    state with a thousand times the votes."""
    order, part = F.col("l_orderkey"), F.col("l_partkey") % 7
    votes = F.col("votes")
    return _election_lines(spark, sf_dir).withColumns({
        "office": F.when(order % 11 != 0, F.col("office")),
        "precinct": F.when(order % 13 == 0, None).when(order % 13 == 1, "").when(order % 13 == 2, "  ")
        .otherwise(F.col("precinct")),
        "party": F.when(part == 0, None).when(part == 1, " ").otherwise(F.col("party")),
        "votes": F.when(F.col("l_linenumber") == 3, -votes).when(order % 17 == 0, None)
        .when(F.col("n_nationkey") == 7, votes * 1000).otherwise(votes),
    }).select(*RAW_COLUMNS)


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    count = (F.count("*") * 10_000).cast("double")
    return people.groupBy(F.col("n_name").alias("NAME")).agg(
        count.alias("POPESTIMATE1996"), count.alias("POPESTIMATE2000"))


# NATION_24 is unknown on purpose.
NATION_STATES = {f"nation_{i}": f"{i:02d}" for i in range(24)}


# The same tables in the raw formats that the sources read.

_KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_placements_csv(rows: DataFrame, path: str) -> None:
    """Gzip CSV with text timestamps."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC"))
    rows.select(text.alias("timestamp"), "user_id", "pixel_color", "coordinate").write.csv(
        path, header=True, compression="gzip", **_KEEP_SPACES)


def write_messy_placements_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The same, with some times that are none: words, a bare date, another zone, no time."""
    rows = _as_placements(table(spark, sf_dir, "events"), "event_id")
    good = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC"))
    kind = F.col("event_id") % 10
    text = (
        F.when(kind == 0, "no time").when(kind == 1, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 2, F.replace(good, F.lit("UTC"), F.lit("+01:00"))).when(kind != 3, good)
    )
    rows.select(text.alias("timestamp"), "user_id", "pixel_color", "coordinate").write.csv(
        path, header=True, compression="gzip", **_KEEP_SPACES)


def write_election_tree(rows: DataFrame, root: str) -> None:
    """CSVs by state and year in three layouts, by state number.

    The last layout has no party. Vote counts of state 24 do not parse.
    """
    number = F.right("state", F.lit(2)).cast("int")
    votes = F.col("votes").cast("string")
    votes = F.when(number == 24, F.concat(votes, F.lit(",000"))).otherwise(votes).alias("votes")
    layouts = [
        ["office", "precinct", "party", votes],
        [F.lit("Lake, North").alias("county"), "precinct", votes, "party", "office"],
        ["precinct", "office", votes],
    ]
    rows = stage(rows, "election")
    for i, columns in enumerate(layouts):
        (
            rows.filter(number % 3 == i).select(*columns, "state", "year")
            .hint("rebalance", "state", "year")
            .write.partitionBy("state", "year")
            .csv(f"{root}/layout{i}", header=True, **_KEEP_SPACES)
        )


def write_election_archives(rows: DataFrame, folder: str) -> str:
    """One zip archive per task, with a member per state and year, and some to be ignored.

    Spark writes the archives, as lines of text of one each. Returns the pattern of their names.
    """
    def zipped(batches):
        task = TaskContext.get().partitionId()
        content = io.BytesIO()
        with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("notes/README.md", "not a table")
            z.writestr("r/openelections-data-00/2000/x__special__general__00__precinct.csv", "a\n")
            z.writestr("r/openelections-data-00/2000/x__general__00__county.csv", "a\n")
            place, member = None, None
            for batch in batches:
                for state, year, line in batch.itertuples(index=False):
                    if (state, year) != place:
                        if member is not None:
                            member.close()
                        place = state, year
                        file = f"{task}__general__{state[-2:]}__precinct.csv"
                        member = z.open(f"r/{state}/{year}/{file}", "w")
                        member.write(b"office,precinct,party,votes\n")
                    member.write(line.encode() + b"\n")
            if member is not None:
                member.close()
        yield pd.DataFrame({"archive": [content.getvalue()]})

    line = F.concat_ws(",", "office", "precinct", "party", F.col("votes").cast("string"))
    # The precinct spreads a state that holds much of the data.
    spread = rows.repartition("state", "year", "precinct")
    ordered = spread.select("state", "year", line.alias("line")).sortWithinPartitions("state", "year")
    ordered.mapInPandas(zipped, "archive binary").select(F.col("archive").cast("string")).write.text(folder)
    return f"{folder}/part-*"
