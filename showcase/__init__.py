"""Queries that run every operator over the test tables, with their SQL."""

from showcase import files, loads, merges, repairs, shaping, streams, tables

ENTRIES = {
    **merges.ENTRIES,
    **shaping.ENTRIES,
    **files.ENTRIES,
    **tables.ENTRIES,
    **streams.ENTRIES,
    **loads.ENTRIES,
    **repairs.ENTRIES,
}
