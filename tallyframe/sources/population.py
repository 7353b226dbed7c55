"""State population table."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.nulls import with_values
from tallyframe.functions.text import normalized

# Postal abbreviations of the states.
STATE_ABBREVIATIONS = {
    "alabama": "al",
    "alaska": "ak",
    "arizona": "az",
    "arkansas": "ar",
    "california": "ca",
    "colorado": "co",
    "connecticut": "ct",
    "delaware": "de",
    "florida": "fl",
    "georgia": "ga",
    "hawaii": "hi",
    "idaho": "id",
    "illinois": "il",
    "indiana": "in",
    "iowa": "ia",
    "kansas": "ks",
    "kentucky": "ky",
    "louisiana": "la",
    "maine": "me",
    "maryland": "md",
    "massachusetts": "ma",
    "michigan": "mi",
    "minnesota": "mn",
    "mississippi": "ms",
    "missouri": "mo",
    "montana": "mt",
    "nebraska": "ne",
    "nevada": "nv",
    "new hampshire": "nh",
    "new jersey": "nj",
    "new mexico": "nm",
    "new york": "ny",
    "north carolina": "nc",
    "north dakota": "nd",
    "ohio": "oh",
    "oklahoma": "ok",
    "oregon": "or",
    "pennsylvania": "pa",
    "rhode island": "ri",
    "south carolina": "sc",
    "south dakota": "sd",
    "tennessee": "tn",
    "texas": "tx",
    "utah": "ut",
    "vermont": "vt",
    "virginia": "va",
    "washington": "wa",
    "west virginia": "wv",
    "wisconsin": "wi",
    "wyoming": "wy",
}


def with_state(population: DataFrame, names: Mapping[str, str] = STATE_ABBREVIATIONS, *,
               name: str = "NAME") -> DataFrame:
    """Add ``state`` from the state's name and drop the rows of unknown names."""
    known = F.create_map(*map(F.lit, chain.from_iterable(names.items())))
    state = F.try_element_at(known, normalized(F.regexp_replace(name, r"^\s+|\s+$", "")))
    return with_values(population.withColumn("state", state), "state")


def load_population(spark: SparkSession, path: str,
                    names: Mapping[str, str] = STATE_ABBREVIATIONS) -> DataFrame:
    """Population CSV with its header and every ``POPESTIMATE<year>`` column as a number."""
    table = spark.read.option("header", True).csv(path)
    if "NAME" not in table.columns:
        raise ValueError(f"{path} has no NAME column")
    estimates = [c for c in table.columns if c.startswith("POPESTIMATE")]
    if not estimates:
        raise ValueError(f"{path} has no POPESTIMATE<year> column")
    numbers = {c: F.col(c).try_cast("double") for c in estimates}
    return with_state(table.withColumns(numbers), names)
