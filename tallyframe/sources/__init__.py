"""Readers and writers."""

from tallyframe.sources.archive import (
    member_lines,
    open_archives,
    read_archive_members,
    write_members,
)
from tallyframe.sources.election_csv import (
    Ingested,
    conform_lines,
    ingest_election_archive,
    ingest_election_csvs,
)
from tallyframe.sources.placements import (
    ingest_placements,
    read_placements_csv,
    write_placements,
)
from tallyframe.sources.population import STATE_ABBREVIATIONS, load_population, with_state
from tallyframe.sources.tables import read_results, write_results, write_table

__all__ = [
    "STATE_ABBREVIATIONS",
    "Ingested",
    "conform_lines",
    "ingest_election_archive",
    "ingest_election_csvs",
    "ingest_placements",
    "load_population",
    "member_lines",
    "open_archives",
    "read_archive_members",
    "read_placements_csv",
    "read_results",
    "with_state",
    "write_members",
    "write_placements",
    "write_results",
    "write_table",
]
