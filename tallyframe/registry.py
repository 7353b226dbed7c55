"""Every operator as a query over the test tables, with the SQL that checks it.

Doubles are rounded to six places on both sides. The SQL follows the definition
of each question, not the way the operator computes it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe import fixtures
from tallyframe import operators as ops
from tallyframe.functions import Box
from tallyframe.plans import new_staging_path, stage
from tallyframe.sources import (
    ingest_election_archive,
    ingest_election_csvs,
    ingest_placements,
    load_population as read_population,
    read_archive_members,
    read_results,
    with_state,
    write_members,
    write_results,
)
from tallyframe.sources.archive import LINE_SCHEMA
from tallyframe.streaming import (
    UserIds,
    append_to_table,
    compact_hour_counts,
    count_hours_in_batches,
    distinct_users_in_batches,
    first_time_users_so_far,
    first_times_in_batches,
    rank_by_distinct_users_so_far,
    read_hour_counts,
    read_placements_stream,
    read_sessions,
    sessions_in_batches,
)

Query = Callable[[SparkSession, str], DataFrame]

WEEK = ("2024-01-05 00", "2024-01-12 00")
NEWCOMERS = ("2024-01-01 12", "2024-01-12 00")
TOP_PERCENT = 10
MAX_MEAN_GAP = 32_000
BOXES = (Box(0, 4, 0, 4), Box(3, 20, 5, 9))
TREATED, CONTROL = ("00", "01", "02"), ("03", "04", "05")
PRE_YEAR, POST_YEAR = 1996, 2000
BATTLEGROUND = ("00", "05", "10", "15", "20")

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE[query.__name__] = sql
        return query

    return register


def _rounded(df: DataFrame) -> DataFrame:
    doubles = {f.name: F.round(f.name, 6) for f in df.schema if f.dataType.typeName() == "double"}
    return df.withColumns(doubles)


# The derived tables in SQL.

_PLACEMENTS = """
placements AS (
  SELECT ts, user_id,
         CASE event_id % 3 WHEN 0 THEN upper(event_type) WHEN 1 THEN event_type
              ELSE ' ' || event_type || ' ' END AS pixel_color,
         CAST(CAST(floor(value / 10) AS INTEGER) AS VARCHAR) || ','
           || CAST(user_id % 10 AS VARCHAR) AS coordinate
  FROM events
)"""

_IN_WEEK = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'"

_ELECTION = """
election AS (
  SELECT CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'President'
              ELSE 'Governor' END AS office,
         CASE WHEN o_orderkey % 50 = 0 THEN 'Total Votes'
              ELSE c_mktsegment || ' ' || CAST(c_custkey % 10 AS VARCHAR) END AS precinct,
         CASE o_custkey % 6 WHEN 0 THEN 'R' WHEN 1 THEN ' dem ' WHEN 2 THEN 'LIB'
              WHEN 3 THEN 'green' WHEN 4 THEN 'Democratic' ELSE 'WFP' END AS party,
         CAST(l_quantity AS BIGINT) AS votes,
         'openelections-data-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state,
         CAST(year(o_orderdate) AS VARCHAR) AS year
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

_MESSY = """
election AS (
  SELECT CASE WHEN l_orderkey % 11 <> 0 THEN
              CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'President'
                   ELSE 'Governor' END END AS office,
         CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 13 = 1 THEN ''
              WHEN l_orderkey % 13 = 2 THEN '  ' WHEN o_orderkey % 50 = 0 THEN 'Total Votes'
              ELSE c_mktsegment || ' ' || CAST(c_custkey % 10 AS VARCHAR) END AS precinct,
         CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 7 = 1 THEN ' '
              ELSE CASE o_custkey % 6 WHEN 0 THEN 'R' WHEN 1 THEN ' dem ' WHEN 2 THEN 'LIB'
                   WHEN 3 THEN 'green' WHEN 4 THEN 'Democratic' ELSE 'WFP' END END AS party,
         CASE WHEN l_linenumber = 3 THEN -CAST(l_quantity AS BIGINT) WHEN l_orderkey % 17 = 0 THEN NULL
              WHEN n_nationkey = 7 THEN 1000 * CAST(l_quantity AS BIGINT)
              ELSE CAST(l_quantity AS BIGINT) END AS votes,
         'openelections-data-' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state,
         CAST(year(o_orderdate) AS VARCHAR) AS year
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

_CLEANING = """,
spellings(spelling, canonical) AS (
  VALUES ('r', 'Republican'), ('rep', 'Republican'), ('republican', 'Republican'),
         ('d', 'Democratic'), ('dem', 'Democratic'), ('democrat', 'Democratic'),
         ('democratic', 'Democratic'), ('lib', 'Libertarian'), ('l', 'Libertarian'),
         ('green', 'Green'), ('g', 'Green')
),
cleaned AS (
  SELECT right(trim(state), 2) AS state, precinct, year, office, votes,
         coalesce(canonical, 'Other') AS party
  FROM election LEFT JOIN spellings ON spelling = lower(trim(party))
  WHERE votes >= 0 AND NOT contains(lower(precinct), 'total')
  GROUP BY ALL
)"""

_CLEANED = _ELECTION + _CLEANING

_POPULATION = """
population AS (
  SELECT n_name AS name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state,
         10000.0 * count(*) AS people
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE n_nationkey < 24
  GROUP BY n_name, n_nationkey
)"""


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.clean_results(fixtures.election(spark, sf_dir))


def _population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_state(fixtures.population(spark, sf_dir), fixtures.NATION_STATES)


# Counts in a window.


def _counts_sql(key: str, limit: str = "") -> str:
    return f"""
WITH {_PLACEMENTS}
SELECT lower(trim({key})) AS {key}, count(*) AS n
FROM placements WHERE {_IN_WEEK} AND {key} IS NOT NULL
GROUP BY 1 ORDER BY n DESC, 1 {limit}"""


@_query(_counts_sql("pixel_color", "LIMIT 1"))
def top_color_in_window(spark, sf_dir):
    return ops.most_frequent(fixtures.placements(spark, sf_dir), "pixel_color", *WEEK)


@_query(_counts_sql("coordinate", "LIMIT 1"))
def top_coordinate_in_window(spark, sf_dir):
    return ops.most_frequent(fixtures.placements(spark, sf_dir), "coordinate", *WEEK)


@_query(_counts_sql("pixel_color"))
def color_counts(spark, sf_dir):
    return ops.value_counts(fixtures.placements(spark, sf_dir), "pixel_color", *WEEK)


@_query(_counts_sql("coordinate"))
def coordinate_counts(spark, sf_dir):
    return ops.value_counts(fixtures.placements(spark, sf_dir), "coordinate", *WEEK)


@_query(f"""
SELECT 'pixel_color' AS key, pixel_color AS value, n FROM ({_counts_sql("pixel_color", "LIMIT 1")})
UNION ALL
SELECT 'coordinate', coordinate, n FROM ({_counts_sql("coordinate", "LIMIT 1")})""")
def top_color_and_coordinate(spark, sf_dir):
    events = fixtures.placements(spark, sf_dir)
    return ops.most_frequent_each(events, ("pixel_color", "coordinate"), *WEEK)


def _top3_sql(key: str) -> str:
    return f"""
SELECT {key}, n, CAST(row_number() OVER (ORDER BY n DESC, {key}) AS INTEGER) AS rank
FROM ({_counts_sql(key, "LIMIT 3")})"""


@_query(_top3_sql("pixel_color"))
def top3_colors(spark, sf_dir):
    top = ops.top_values(fixtures.placements(spark, sf_dir), "pixel_color", 3, *WEEK)
    return ops.numbered(top, "pixel_color", row_bound=3)


@_query(_top3_sql("coordinate"))
def top3_coordinates(spark, sf_dir):
    top = ops.top_values(fixtures.placements(spark, sf_dir), "coordinate", 3, *WEEK)
    return ops.numbered(top, "coordinate", row_bound=3)


_TOP3 = f"""
top3 AS (
  SELECT lower(trim(coordinate)) AS coordinate FROM placements WHERE {_IN_WEEK}
  GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3
)"""

_HOURLY = """
hourly AS (
  SELECT date_trunc('hour', ts) AS hour, lower(trim(coordinate)) AS coordinate,
         count(*) AS changes
  FROM placements GROUP BY 1, 2
)"""


@_query(f"""
WITH {_PLACEMENTS}, {_TOP3}
SELECT date_trunc('hour', ts) AS hour, lower(trim(coordinate)) AS coordinate, count(*) AS changes
FROM placements
WHERE {_IN_WEEK} AND lower(trim(coordinate)) IN (SELECT coordinate FROM top3)
GROUP BY 1, 2""")
def hourly_changes_top_coordinates(spark, sf_dir):
    return ops.hourly_counts_of_top(fixtures.placements(spark, sf_dir), "coordinate", 3, *WEEK)


@_query(f"""
WITH {_PLACEMENTS}, {_HOURLY}
SELECT hour, round(median(changes), 6) AS median_changes FROM hourly GROUP BY hour""")
def hourly_median_changes(spark, sf_dir):
    return _rounded(ops.hourly_median(fixtures.placements(spark, sf_dir), "coordinate"))


@_query(f"WITH {_PLACEMENTS}, {_HOURLY} SELECT hour, coordinate, changes FROM hourly")
def changes_per_coordinate_hour(spark, sf_dir):
    return ops.hourly_counts(fixtures.placements(spark, sf_dir), "coordinate")


@_query(f"""
WITH {_PLACEMENTS}, {_HOURLY},
edges AS (SELECT min(changes) AS lo, max(changes) AS hi FROM hourly),
placed AS (
  SELECT CASE WHEN hi = lo THEN 25
              ELSE least((changes - lo) * 50 // (hi - lo), 49) END AS bin
  FROM hourly, edges
),
filled AS (SELECT bin, count(*) AS n FROM placed GROUP BY bin),
axis AS (
  SELECT CAST(bin AS INTEGER) AS bin,
         CASE WHEN hi = lo THEN lo - 0.5 ELSE CAST(lo AS DOUBLE) END AS lo,
         CASE WHEN hi = lo THEN 1.0 ELSE CAST(hi - lo AS DOUBLE) END AS span
  FROM edges, range(50) AS r(bin)
)
SELECT axis.bin, round(lo + span * axis.bin / 50, 6) AS bin_start,
       round(lo + span * (axis.bin + 1) / 50, 6) AS bin_end, coalesce(n, 0) AS n
FROM axis LEFT JOIN filled ON axis.bin = filled.bin""")
def changes_histogram(spark, sf_dir):
    return _rounded(ops.changes_histogram(fixtures.placements(spark, sf_dir), "coordinate"))


@_query(f"""
WITH {_PLACEMENTS}, {_TOP3}
SELECT * FROM (
  SELECT coordinate, pixel_color, n,
         CAST(row_number() OVER (PARTITION BY coordinate ORDER BY n DESC, pixel_color) AS INTEGER)
           AS place
  FROM (SELECT lower(trim(coordinate)) AS coordinate, lower(trim(pixel_color)) AS pixel_color,
               count(*) AS n
        FROM placements
        WHERE {_IN_WEEK} AND pixel_color IS NOT NULL
          AND lower(trim(coordinate)) IN (SELECT coordinate FROM top3)
        GROUP BY 1, 2))
WHERE place <= 2""")
def top2_colors_per_top_coordinate(spark, sf_dir):
    return ops.top_values_per_top_key(
        fixtures.placements(spark, sf_dir), "coordinate", "pixel_color", 3, 2, *WEEK)


# Users.


@_query(f"""
WITH {_PLACEMENTS}
SELECT pixel_color, count(DISTINCT user_id) AS distinct_users
FROM placements WHERE {_IN_WEEK} GROUP BY pixel_color""")
def colors_by_distinct_users(spark, sf_dir):
    return ops.rank_by_distinct_users(fixtures.placements(spark, sf_dir), "pixel_color", *WEEK)


_SESSIONS = """
flagged AS (
  SELECT user_id, ts,
         CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                   > INTERVAL 15 MINUTE THEN 1 ELSE 0 END AS opens
  FROM events
),
numbered AS (
  SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM flagged
),
spans AS (
  SELECT user_id, CAST(session AS BIGINT) AS session, min(ts) AS first_ts, max(ts) AS last_ts,
         count(*) AS events, epoch(max(ts)) - epoch(min(ts)) AS seconds
  FROM numbered GROUP BY 1, 2
)"""


@_query(f"""
WITH {_SESSIONS}
SELECT round(avg(seconds), 6) AS avg_session_length FROM spans WHERE events > 1""")
def avg_session_length(spark, sf_dir):
    return _rounded(ops.average_session_seconds(fixtures.placements(spark, sf_dir)))


@_query(f"""
WITH {_SESSIONS}
SELECT user_id, session, first_ts, last_ts, events, round(seconds, 6) AS seconds FROM spans""")
def user_sessions(spark, sf_dir):
    return _rounded(ops.sessions(fixtures.placements(spark, sf_dir)))


@_query(f"""
WITH {_SESSIONS.replace("INTERVAL 15 MINUTE", "INTERVAL 200 SECOND")}
SELECT user_id, session, first_ts, last_ts, events, round(seconds, 6) AS seconds FROM spans""")
def user_sessions_of_short_gaps(spark, sf_dir):
    return _rounded(ops.sessions(fixtures.placements(spark, sf_dir), gap_seconds_max=200, block_cells=64))


@_query(f"""
SELECT round(quantile_cont(c, 0.5), 6) AS p50, round(quantile_cont(c, 0.75), 6) AS p75,
       round(quantile_cont(c, 0.9), 6) AS p90, round(quantile_cont(c, 0.99), 6) AS p99
FROM (SELECT count(*) AS c FROM events WHERE {_IN_WEEK} GROUP BY user_id)""")
def placement_percentiles(spark, sf_dir):
    return _rounded(ops.placement_percentiles(fixtures.placements(spark, sf_dir), *WEEK))


@_query("""
SELECT count(*) AS first_time_user_count
FROM (SELECT user_id, min(ts) AS first_ts FROM events
      WHERE ts <= TIMESTAMP '2024-01-12 00:00:00' GROUP BY user_id)
WHERE first_ts BETWEEN TIMESTAMP '2024-01-01 12:00:00' AND TIMESTAMP '2024-01-12 00:00:00'""")
def first_time_users(spark, sf_dir):
    return ops.first_time_user_count(fixtures.placements(spark, sf_dir), *NEWCOMERS)


_DENSE = """
dense AS (
  SELECT user_id, row_number() OVER (ORDER BY min(ts), user_id) - 1 AS dense_id
  FROM events GROUP BY user_id
)"""


@_query(f"""
WITH {_PLACEMENTS}, {_DENSE}
SELECT ts, pixel_color, coordinate, dense_id AS user_id
FROM placements JOIN dense USING (user_id)""")
def encode_user_ids(spark, sf_dir):
    encoded, _ = ops.encode_user_ids(fixtures.placements(spark, sf_dir))
    return encoded


@_query(f"WITH {_DENSE} SELECT user_id, dense_id FROM dense")
def user_id_mapping(spark, sf_dir):
    _, mapping = ops.encode_user_ids(fixtures.placements(spark, sf_dir))
    return mapping


# Suspects.

_ACTIVE = f"""
ranked AS (
  SELECT user_id, count(*) AS pixel_placements,
         row_number() OVER (ORDER BY count(*) DESC, user_id) AS place,
         count(*) OVER () AS users
  FROM events GROUP BY user_id
),
active AS (
  SELECT user_id, pixel_placements FROM ranked
  WHERE place <= greatest(1, floor(users * {TOP_PERCENT} / 100.0))
)"""

_SUSPECTS = _ACTIVE + f""",
gaps AS (
  SELECT user_id, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap
  FROM events WHERE user_id IN (SELECT user_id FROM active)
),
suspects AS (
  SELECT user_id, avg(gap) AS avg_interval FROM gaps WHERE gap IS NOT NULL
  GROUP BY user_id HAVING avg(gap) < {MAX_MEAN_GAP}
)"""


def _suspects(events: DataFrame) -> DataFrame:
    return ops.suspicious_users(events, top_percent=TOP_PERCENT, max_mean_gap=MAX_MEAN_GAP)


@_query("SELECT count(DISTINCT user_id) AS total_users FROM events WHERE user_id IS NOT NULL")
def total_users(spark, sf_dir):
    return ops.total_users(fixtures.placements(spark, sf_dir))


@_query(f"WITH {_ACTIVE} SELECT user_id, pixel_placements FROM active")
def most_active_users(spark, sf_dir):
    return ops.most_active_users(fixtures.placements(spark, sf_dir), TOP_PERCENT)


@_query(f"WITH {_SUSPECTS} SELECT user_id, round(avg_interval, 6) AS avg_interval FROM suspects")
def suspicious_users(spark, sf_dir):
    return _rounded(_suspects(fixtures.placements(spark, sf_dir)))


@_query(f"""
WITH {_PLACEMENTS}, {_SUSPECTS}
SELECT coordinate, count(*) AS placements
FROM placements WHERE user_id IN (SELECT user_id FROM suspects)
GROUP BY coordinate ORDER BY 2 DESC, 1 LIMIT 20""")
def suspect_top_coordinates(spark, sf_dir):
    events = fixtures.placements(spark, sf_dir)
    return ops.top_coordinates_of(events, _suspects(events))


@_query(ORACLE["suspect_top_coordinates"])
def suspect_top_coordinates_of_many(spark, sf_dir):
    """As if the suspects were too many to broadcast: a Bloom filter, then a salted join."""
    events = fixtures.placements(spark, sf_dir)
    return ops.top_coordinates_of(events, _suspects(events), max_rows=0)


@_query(f"""
WITH {_PLACEMENTS}, {_SUSPECTS},
split AS (
  SELECT date_trunc('hour', ts) AS hour,
         CAST(split_part(coordinate, ',', 1) AS INTEGER) AS x,
         CAST(split_part(coordinate, ',', 2) AS INTEGER) AS y
  FROM placements WHERE user_id IN (SELECT user_id FROM suspects)
)
SELECT hour, count(*) AS bot_changes FROM split
WHERE (x BETWEEN 0 AND 4 AND y BETWEEN 0 AND 4) OR (x BETWEEN 3 AND 20 AND y BETWEEN 5 AND 9)
GROUP BY hour""")
def suspect_region_hourly(spark, sf_dir):
    events = fixtures.placements(spark, sf_dir)
    return ops.hourly_activity_in_regions(events, _suspects(events), BOXES)


# Precinct results.


@_query(f"WITH {_CLEANED} SELECT state, precinct, year, office, votes, party FROM cleaned")
def clean_election_results(spark, sf_dir):
    return _cleaned(spark, sf_dir)


@_query(f"""
WITH {_ELECTION}, size AS (SELECT count(*) AS total_rows FROM election)
SELECT column_name,
       CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS column_type,
       total_rows, CAST(0 AS BIGINT) AS missing_count
FROM (DESCRIBE SELECT 'o' AS office, 'p' AS precinct, 'p' AS party, CAST(1 AS BIGINT) AS votes,
             's' AS state, 'y' AS year), size""")
def profile_columns(spark, sf_dir):
    return ops.profile_columns(fixtures.election(spark, sf_dir))


@_query("""
SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' ELSE lower(column_type) END AS column_type
FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)""")
def profile_schema(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").drop("o_orderdate")
    return ops.profile_schema(orders).select("column_name", "column_type")


_ROUND_TRIP = f"""
WITH {_CLEANED} SELECT state, precinct, year, office, votes, party FROM cleaned"""


@_query(_ROUND_TRIP)
def write_and_read_results(spark, sf_dir):
    """Cleaned results by state and year; the second call finds the table finished."""
    path = new_staging_path(spark, "results")
    write_results(_cleaned(spark, sf_dir), path)
    write_results(_cleaned(spark, sf_dir).limit(0), path)
    return read_results(spark, path)


@_query(f"WITH {_CLEANED} SELECT count(*) AS total_rows FROM cleaned")
def profile_row_count(spark, sf_dir):
    return ops.profile_row_count(_cleaned(spark, sf_dir))


@_query(f"""
WITH {_CLEANED}
SELECT state, precinct, year, office, votes, party FROM cleaned
WHERE votes IS NOT NULL AND trim(precinct) <> '' AND trim(party) <> '' AND office = 'President'
ORDER BY votes DESC, state, precinct, year, office, party LIMIT 5""")
def profile_top_values(spark, sf_dir):
    return ops.profile_top_rows(
        _cleaned(spark, sf_dir), "votes", where=F.col("office") == "President",
        non_blank=("precinct", "party"))


@_query(f"""
WITH {_ELECTION},
missing AS (SELECT count(*) - count(COLUMNS(*)) FROM election),
named(office, precinct, party, votes, state, year) AS (FROM missing)
UNPIVOT named ON COLUMNS(*) INTO NAME column_name VALUE missing_count""")
def profile_missing(spark, sf_dir):
    return ops.profile_missing(fixtures.election(spark, sf_dir))


@_query(f"""
WITH {_ELECTION}
SELECT CAST(coalesce(sum(copies), 0) AS BIGINT) AS duplicate_count
FROM (SELECT office, precinct, party, votes, state, year, count(*) AS copies
      FROM election GROUP BY ALL)
WHERE copies > 1""")
def profile_duplicates(spark, sf_dir):
    return ops.profile_duplicates(fixtures.election(spark, sf_dir))


@_query(f"""
WITH {_CLEANED}
SELECT min(votes) AS min_votes, max(votes) AS max_votes, round(avg(votes), 6) AS avg_votes
FROM cleaned WHERE votes IS NOT NULL""")
def profile_numeric_summary(spark, sf_dir):
    return _rounded(ops.profile_numeric(_cleaned(spark, sf_dir), "votes"))


@_query(f"""
WITH {_CLEANED}
SELECT party, count(*) AS total_votes FROM cleaned WHERE party IS NOT NULL GROUP BY party""")
def profile_category_distribution(spark, sf_dir):
    return ops.profile_categories(_cleaned(spark, sf_dir), "party", name="total_votes")


@_query(f"""
WITH {_CLEANED}
SELECT state, CAST(sum(votes) AS BIGINT) AS total_votes FROM cleaned
WHERE votes IS NOT NULL GROUP BY state ORDER BY 2 DESC, 1 LIMIT 5""")
def profile_top_groups_by_sum(spark, sf_dir):
    return ops.profile_top_groups(_cleaned(spark, sf_dir), "state", "votes", name="total_votes")


@_query(f"""
WITH {_POPULATION}
SELECT name AS "NAME", people AS "POPESTIMATE1996", people AS "POPESTIMATE2000", state
FROM population""")
def load_population(spark, sf_dir):
    path = new_staging_path(spark, "population-csv")
    fixtures.population(spark, sf_dir).write.csv(path, header=True)
    return read_population(spark, path, fixtures.NATION_STATES)


_TURNOUT = _CLEANED + f""",
yearly AS (
  SELECT state, year, sum(votes) AS total FROM cleaned
  WHERE state IN ('00', '01', '02', '03', '04', '05') GROUP BY state, year
),
turnout AS (
  SELECT state,
         avg(total) FILTER (WHERE year = '{PRE_YEAR}') AS pre_turnout,
         avg(total) FILTER (WHERE year = '{POST_YEAR}') AS post_turnout
  FROM yearly GROUP BY state
)"""


def _turnout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.turnout_pre_post(
        _cleaned(spark, sf_dir), TREATED, CONTROL, PRE_YEAR, POST_YEAR)


@_query(f"""
WITH {_TURNOUT}
SELECT state, round(pre_turnout, 6) AS pre_turnout, round(post_turnout, 6) AS post_turnout,
       round(post_turnout - pre_turnout, 6) AS turnout_change
FROM turnout""")
def turnout_pre_post(spark, sf_dir):
    return _rounded(_turnout(spark, sf_dir))


@_query(f"""
WITH {_TURNOUT}
SELECT round(avg(post_turnout - pre_turnout) FILTER (WHERE state <= '02')
             - avg(post_turnout - pre_turnout) FILTER (WHERE state > '02'), 6) AS did_effect
FROM turnout""")
def did_effect(spark, sf_dir):
    return _rounded(ops.did_effect(_turnout(spark, sf_dir), TREATED, CONTROL))


@_query(f"""
WITH {_TURNOUT},
means AS (
  SELECT CASE WHEN state <= '02' THEN 'Treated' ELSE 'Control' END AS "group",
         avg(pre_turnout) AS before, avg(post_turnout) AS after
  FROM turnout GROUP BY 1
)
SELECT "group", '{PRE_YEAR}' AS period, round(before, 6) AS turnout FROM means
UNION ALL
SELECT "group", '{POST_YEAR}', round(after, 6) FROM means""")
def did_group_means_long(spark, sf_dir):
    turnout = _turnout(spark, sf_dir)
    return _rounded(ops.did_group_means(turnout, TREATED, PRE_YEAR, POST_YEAR))


_RATING = f""", {_POPULATION},
votes AS (
  SELECT state, CAST(sum(votes) AS BIGINT) AS total_votes FROM cleaned
  WHERE year = '{POST_YEAR}' AND office = 'President' GROUP BY state HAVING sum(votes) > 0
),
rated AS (
  SELECT state, total_votes, total_votes / people AS rate FROM votes JOIN population USING (state)
),
rates AS (
  SELECT state, total_votes, rate FROM rated, (SELECT avg(rate) AS m, stddev_samp(rate) AS s FROM rated)
  WHERE abs(rate - m) <= 3 * s
)"""

_RATES = _CLEANED + _RATING


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.turnout_rate(_cleaned(spark, sf_dir), _population(spark, sf_dir), POST_YEAR)


@_query(f"WITH {_RATES} SELECT state, total_votes, round(rate, 6) AS turnout_rate FROM rates")
def turnout_rate(spark, sf_dir):
    return _rounded(_rates(spark, sf_dir))


@_query(f"""
WITH {_RATES}
SELECT round(avg(rate) FILTER (WHERE CAST(state AS INTEGER) % 5 = 0), 6) AS battleground_mean,
       round(avg(rate) FILTER (WHERE CAST(state AS INTEGER) % 5 <> 0), 6) AS non_battleground_mean
FROM rates""")
def battleground_comparison(spark, sf_dir):
    return _rounded(ops.battleground_comparison(_rates(spark, sf_dir), BATTLEGROUND))


# The same rules on rows that they act on.


@_query(f"""
WITH {_MESSY}{_CLEANING} SELECT state, precinct, year, office, votes, party FROM cleaned""")
def clean_messy_results(spark, sf_dir):
    return ops.clean_results(fixtures.messy_election(spark, sf_dir))


@_query(f"""
WITH {_MESSY},
missing AS (SELECT count(*) - count(COLUMNS(*)) FROM election),
named(office, precinct, party, votes, state, year) AS (FROM missing)
UNPIVOT named ON COLUMNS(*) INTO NAME column_name VALUE missing_count""")
def profile_missing_of_messy_results(spark, sf_dir):
    return ops.profile_missing(fixtures.messy_election(spark, sf_dir))


@_query(f"""
WITH {_MESSY}
SELECT office, precinct, party, votes, state, year FROM election
WHERE votes IS NOT NULL AND trim(precinct) <> '' AND trim(party) <> '' AND votes % 2 = 1
ORDER BY votes DESC, office, precinct, party, state, year LIMIT 50""")
def profile_top_values_of_messy_results(spark, sf_dir):
    return ops.profile_top_rows(fixtures.messy_election(spark, sf_dir), "votes", 50,
                                where=F.col("votes") % 2 == 1, non_blank=("precinct", "party"))


@_query(f"""
WITH {_MESSY}
SELECT party, count(*) AS total_votes FROM election WHERE party IS NOT NULL GROUP BY party""")
def profile_categories_of_messy_results(spark, sf_dir):
    return ops.profile_categories(fixtures.messy_election(spark, sf_dir), "party", name="total_votes")


@_query(f"WITH {_MESSY}{_CLEANING}{_RATING} SELECT state, total_votes, round(rate, 6) AS turnout_rate FROM rates")
def turnout_rate_without_outlier(spark, sf_dir):
    cleaned = ops.clean_results(fixtures.messy_election(spark, sf_dir))
    return _rounded(ops.turnout_rate(cleaned, _population(spark, sf_dir), POST_YEAR))


_MESSY_PLACEMENTS = _PLACEMENTS.replace("SELECT ts, user_id,", """SELECT
         CASE WHEN event_id % 10 <> 0 THEN ts END AS ts, CASE WHEN event_id % 8 <> 1 THEN user_id END AS user_id,
         CASE WHEN event_id % 9 <> 2 THEN""").replace("END AS pixel_color", "END END AS pixel_color")


@_query(f"""
WITH {_MESSY_PLACEMENTS}
SELECT lower(trim(pixel_color)) AS pixel_color, count(*) AS n
FROM placements WHERE {_IN_WEEK} AND pixel_color IS NOT NULL GROUP BY 1""")
def color_counts_of_messy_placements(spark, sf_dir):
    return ops.value_counts(fixtures.messy_placements(spark, sf_dir), "pixel_color", *WEEK)


@_query(f"""
WITH {_MESSY_PLACEMENTS}
SELECT date_trunc('hour', ts) AS hour, lower(trim(pixel_color)) AS pixel_color, count(*) AS changes
FROM placements WHERE ts IS NOT NULL AND pixel_color IS NOT NULL GROUP BY 1, 2""")
def hourly_counts_of_messy_placements(spark, sf_dir):
    return ops.hourly_counts(fixtures.messy_placements(spark, sf_dir), "pixel_color")


@_query(f"""
WITH {_MESSY_PLACEMENTS}
SELECT pixel_color, count(DISTINCT user_id) AS distinct_users
FROM placements WHERE {_IN_WEEK} GROUP BY pixel_color""")
def distinct_users_of_messy_placements(spark, sf_dir):
    return ops.rank_by_distinct_users(fixtures.messy_placements(spark, sf_dir), "pixel_color", *WEEK)


# Ingest. The derived table is written in the raw format first, once a session, then read.


_TYPED_SQL = f"""
WITH {_PLACEMENTS}
SELECT ts, CAST(user_id AS VARCHAR) AS user_id, pixel_color, coordinate,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date
FROM placements"""


@lru_cache(maxsize=8)
def _placements_csv(spark: SparkSession, sf_dir: str) -> str:
    raw = new_staging_path(spark, "placements-csv")
    fixtures.write_placements_csv(fixtures.placements(spark, sf_dir), raw)
    return raw


def _utc(ts: str) -> Column:
    """Wall time in UTC of an instant, which the test tables use."""
    wall = F.col(ts).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), wall).alias(ts)


def _instant(ts: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(ts)).cast("timestamp")


def _typed(rows: DataFrame) -> DataFrame:
    return rows.select(_utc("ts"), "user_id", "pixel_color", "coordinate",
                       F.col("event_date").cast("string").alias("event_date"))


@_query(_TYPED_SQL)
def ingest_placements_csv(spark, sf_dir):
    raw = _placements_csv(spark, sf_dir)
    return _typed(ingest_placements(spark, raw, new_staging_path(spark, "placements")))


@_query(f"""
WITH {_PLACEMENTS}
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, pixel_color, count(*) AS n
FROM placements GROUP BY 1, 2""")
def ingest_placements_twice(spark, sf_dir):
    raw, path = _placements_csv(spark, sf_dir), new_staging_path(spark, "placements")
    for _ in range(2):  # the second call keeps the finished table
        rows = ingest_placements(spark, raw, path, columns=("pixel_color",))
    counts = rows.groupBy("event_date", "pixel_color").agg(F.count("*").alias("n"))
    return counts.withColumn("event_date", F.col("event_date").cast("string"))


@_query(_TYPED_SQL)
def ingest_placements_incrementally(spark, sf_dir):
    stream = read_placements_stream(spark, _placements_csv(spark, sf_dir))
    table = new_staging_path(spark, "placements")
    append_to_table(stream, table, new_staging_path(spark, "offsets"),
                    ["event_date"]).awaitTermination()
    return _typed(spark.read.parquet(table))


@_query(_TYPED_SQL)
def ingest_one_large_gzip(spark, sf_dir):
    raw = new_staging_path(spark, "placements-csv")
    fixtures.write_placements_csv(fixtures.placements(spark, sf_dir).coalesce(1), raw)
    return _typed(ingest_placements(spark, raw, new_staging_path(spark, "placements"), spread=True))


@_query(_TYPED_SQL.replace("FROM events", "FROM events WHERE event_id % 10 > 3"))
def ingest_placements_with_bad_times(spark, sf_dir):
    raw = new_staging_path(spark, "placements-csv")
    fixtures.write_messy_placements_csv(spark, sf_dir, raw)
    return _typed(ingest_placements(spark, raw, new_staging_path(spark, "placements")))


def _as_they_arrive(spark: SparkSession, sf_dir: str,
                    run: Callable[[DataFrame], StreamingQuery]) -> None:
    """Let ``run`` take the placements in parts, each by a query that goes on from the last."""
    folder = new_staging_path(spark, "arrivals")
    whole = fixtures.placements(spark, sf_dir).withColumn("ts", _instant("ts"))
    for part in fixtures.arrivals(whole):
        part.write.mode("append").parquet(folder)
        run(spark.readStream.schema(part.schema).parquet(folder)).awaitTermination()


@_query(f"""
WITH {_PLACEMENTS}, {_HOURLY}
SELECT hour, coordinate, changes FROM hourly""")
def hourly_counts_incrementally(spark, sf_dir):
    table, offsets = new_staging_path(spark, "hourly"), new_staging_path(spark, "offsets")
    _as_they_arrive(spark, sf_dir, lambda stream: count_hours_in_batches(stream, "coordinate", table, offsets))
    compact_hour_counts(spark, table, "coordinate")
    return read_hour_counts(spark, table, "coordinate").select(_utc("hour"), "coordinate", "changes")


@_query(ORACLE["user_sessions"])
def user_sessions_incrementally(spark, sf_dir):
    table, offsets = new_staging_path(spark, "sessions"), new_staging_path(spark, "offsets")
    _as_they_arrive(spark, sf_dir, lambda stream: sessions_in_batches(stream, table, offsets, lateness="1 day"))
    rows = read_sessions(spark, table, offsets)
    return _rounded(rows.withColumns({"first_ts": _utc("first_ts"), "last_ts": _utc("last_ts")}))


@_query(ORACLE["first_time_users"])
def first_time_users_incrementally(spark, sf_dir):
    table, offsets = new_staging_path(spark, "first-times"), new_staging_path(spark, "offsets")
    _as_they_arrive(spark, sf_dir, lambda stream: first_times_in_batches(stream, table, offsets))
    return first_time_users_so_far(spark, table, *NEWCOMERS)


# With so few users as in the test tables the sketches hold them all.
@_query(ORACLE["colors_by_distinct_users"])
def colors_by_distinct_users_incrementally(spark, sf_dir):
    table, offsets = new_staging_path(spark, "sketches"), new_staging_path(spark, "offsets")
    _as_they_arrive(spark, sf_dir, lambda stream: distinct_users_in_batches(stream, "pixel_color", table, offsets))
    return rank_by_distinct_users_so_far(spark, table, "pixel_color", *WEEK)


@_query(ORACLE["encode_user_ids"])
def encode_user_ids_incrementally(spark, sf_dir):
    """Parts by time, so that the ids are those of one pass."""
    whole = fixtures.placements(spark, sf_dir)
    ids = UserIds(spark, new_staging_path(spark, "user-ids"))
    parts = [stage(ids.encode(part, i), "encoded") for i, part in enumerate(fixtures.arrivals(whole, late="0 days"))]
    return reduce(DataFrame.unionByName, parts)


_CSV_ROWS = _ELECTION + """
SELECT office, precinct,
       CASE WHEN CAST(right(state, 2) AS INTEGER) % 3 = 2 THEN '' ELSE party END AS party,
       votes, state, year
FROM election WHERE right(state, 2) <> '24'"""


@lru_cache(maxsize=8)
def _election_tree(spark: SparkSession, sf_dir: str) -> str:
    root = new_staging_path(spark, "election-csv")
    fixtures.write_election_tree(fixtures.election(spark, sf_dir), root)
    return root


@_query(f"WITH {_CSV_ROWS}")
def ingest_election_tree(spark, sf_dir):
    return ingest_election_csvs(spark, _election_tree(spark, sf_dir)).rows


@_query(f"""
WITH {_ELECTION}
SELECT state, year, 'vote count' AS problem, count(*) AS lines
FROM election WHERE right(state, 2) = '24' GROUP BY state, year""")
def ingest_election_skipped(spark, sf_dir):
    skipped = ingest_election_csvs(spark, _election_tree(spark, sf_dir)).skipped
    # The names of the written files differ between runs, their folders do not.
    folder = F.split("file", "/")
    return skipped.groupBy(
        F.regexp_replace(F.element_at(folder, -3), "^state=", "").alias("state"),
        F.regexp_replace(F.element_at(folder, -2), "^year=", "").alias("year"), "problem",
    ).agg(F.sum("lines").alias("lines"))


@lru_cache(maxsize=8)
def _archive(spark: SparkSession, sf_dir: str) -> str:
    folder = new_staging_path(spark, "election-zip")
    return fixtures.write_election_archives(fixtures.election(spark, sf_dir), folder)


@_query(f"""
WITH {_ELECTION}
SELECT state, year, office || ',' || precinct || ',' || party || ',' || CAST(votes AS VARCHAR)
         AS line
FROM election""")
def archive_member_lines(spark, sf_dir):
    lines = read_archive_members(spark, _archive(spark, sf_dir))
    return lines.filter(F.col("line_no") > 0).select("state", "year", "line")


@_query(f"""
WITH {_ELECTION}
SELECT state, year, count(*) AS lines FROM election
WHERE year = '{POST_YEAR}' GROUP BY state, year""")
def archive_members_by_state_and_year(spark, sf_dir):
    path = new_staging_path(spark, "members")
    write_members(read_archive_members(spark, _archive(spark, sf_dir)), path)
    lines = spark.read.schema(LINE_SCHEMA).parquet(path).filter(F.col("year") == str(POST_YEAR))
    return lines.filter("line_no > 0").groupBy("state", "year").agg(F.count("*").alias("lines"))


@_query(f"""
WITH {_ELECTION}
SELECT state, year, office || ',' || precinct || ',' || party || ',' || CAST(votes AS VARCHAR)
         AS line
FROM election""")
def archive_members_written_and_read(spark, sf_dir):
    """All lines of all members, through the table by state and year."""
    path = new_staging_path(spark, "members")
    write_members(read_archive_members(spark, _archive(spark, sf_dir)), path)
    lines = spark.read.schema(LINE_SCHEMA).parquet(path)
    return lines.filter("line_no > 0 and valid").select("state", "year", "line")


@_query(f"WITH {_ELECTION} SELECT office, precinct, party, votes, state, year FROM election")
def ingest_election_archives(spark, sf_dir):
    return ingest_election_archive(spark, _archive(spark, sf_dir)).rows
