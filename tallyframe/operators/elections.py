"""Cleaning precinct results and comparing turnout between groups of states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.text import normalized

# The spellings of each party, and the office of turnout rates.
PARTY_SPELLINGS = {
    "Republican": ("r", "rep", "republican"),
    "Democratic": ("d", "dem", "democrat", "democratic"),
    "Libertarian": ("lib", "l"),
    "Green": ("green", "g"),
}
OTHER_PARTY = "Other"
RATE_OFFICE = "President"


def canonical_party(party: str | Column = "party") -> Column:
    """Canonical party name; NULL and unknown spellings are ``Other``."""
    names = [F.lit(v) for name, known in PARTY_SPELLINGS.items() for s in known for v in (s, name)]
    return F.coalesce(F.try_element_at(F.create_map(*names), normalized(party)), F.lit(OTHER_PARTY))


def clean_results(raw: DataFrame, *, dedupe: bool = True) -> DataFrame:
    """Precinct rows with a vote count, canonical state and party, each row once.

    Subtotal rows, and rows with a NULL precinct, NULL votes or negative votes, go.
    """
    kept = raw.filter(F.col("votes") >= 0).filter(~normalized("precinct").contains("total"))
    rows = kept.select(
        F.right(F.trim("state"), F.lit(2)).alias("state"),
        "precinct", "year", "office", "votes",
        canonical_party().alias("party"),
    )
    return rows.distinct() if dedupe else rows


def _year(column: str = "year") -> Column:
    return F.col(column).try_cast("int")


def turnout_pre_post(results: DataFrame, treated: Sequence[str], control: Sequence[str],
                     pre_year: int, post_year: int, *, office: str | None = None) -> DataFrame:
    """Votes of each treated and control state before and after, and the change."""
    rows = results.filter(F.col("state").isin(*treated, *control))
    if office is not None:
        rows = rows.filter(F.col("office") == office)
    # Reads no data column of a table by state and year.
    states = rows.select("state").distinct()
    asked = rows.filter(_year().isin(pre_year, post_year))
    per_year = asked.groupBy("state", "year").agg(F.sum("votes").alias("_votes"))

    def in_year(year: int) -> Column:
        return F.avg(F.when(_year() == year, F.col("_votes")))

    per_state = per_year.groupBy("state").agg(
        in_year(pre_year).alias("pre_turnout"), in_year(post_year).alias("post_turnout"))
    per_state = states.join(per_state, "state", "left")
    return per_state.withColumn("turnout_change", F.col("post_turnout") - F.col("pre_turnout"))


def did_effect(turnout: DataFrame, treated: Sequence[str], control: Sequence[str]) -> DataFrame:
    """Mean change of the treated states minus that of the control states, as one row."""

    def mean_change(states: Sequence[str]) -> Column:
        return F.avg(F.when(F.col("state").isin(*states), F.col("turnout_change")))

    return turnout.agg((mean_change(treated) - mean_change(control)).alias("did_effect"))


def did_group_means(turnout: DataFrame, treated: Sequence[str], pre_year: int,
                    post_year: int) -> DataFrame:
    """Mean turnout by group and period, in long form."""
    group = F.when(F.col("state").isin(*treated), "Treated").otherwise("Control")
    before, after = str(pre_year), str(post_year)
    means = turnout.groupBy(group.alias("group")).agg(
        F.avg("pre_turnout").alias(before), F.avg("post_turnout").alias(after))
    return means.unpivot("group", [before, after], "period", "turnout")


def turnout_rate(results: DataFrame, population: DataFrame, year: int, *,
                 office: str | None = RATE_OFFICE, max_sigma: float | None = 3.0) -> DataFrame:
    """Votes over population of each known state, without the outliers.

    ``population`` has ``state`` and ``POPESTIMATE<year>``. A state stays when its
    rate is within ``max_sigma`` sample standard deviations of the mean.
    """
    estimate = F.col(f"POPESTIMATE{year}")
    known = population.select("state", estimate.alias("_population"))
    rows = results.filter(_year() == year)
    if office is not None:
        rows = rows.filter(F.col("office") == office)
    totals = rows.groupBy("state").agg(F.sum("votes").alias("total_votes"))
    rates = (
        totals.filter(F.col("total_votes") > 0)
        # The states of the population table are the ones asked for.
        .join(known, "state")
        .select("state", "total_votes",
                F.try_divide(F.col("total_votes").cast("double"), F.col("_population"))
                .alias("turnout_rate"))
    )
    if max_sigma is None:
        return rates
    rate = F.col("turnout_rate")
    spread = rates.agg(F.stddev_samp(rate)).scalar()
    return rates.filter(F.abs(rate - rates.agg(F.avg(rate)).scalar()) <= max_sigma * spread)


def battleground_comparison(rates: DataFrame, battleground: Sequence[str]) -> DataFrame:
    """Mean turnout rate of the battleground states and of all others, as one row."""
    inside = F.col("state").isin(*battleground)
    rate = F.col("turnout_rate")
    return rates.agg(F.avg(F.when(inside, rate)).alias("battleground_mean"),
                     F.avg(F.when(~inside, rate)).alias("non_battleground_mean"))
