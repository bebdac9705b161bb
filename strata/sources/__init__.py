"""Readers for the provided tables, stand-in relations and sinks."""
from strata.sources.tables import Tables, read_table  # noqa: F401
