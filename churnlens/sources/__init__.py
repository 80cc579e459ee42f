"""Readers: raw CSV drops, the supplied test data, and written star-schema tables."""

from churnlens.sources.csv import read_raw_csv, read_raw_tables
from churnlens.sources.testdata import raw_tables_from_testdata
from churnlens.sources.silver import read_silver, read_star, register_views

__all__ = ["raw_tables_from_testdata", "read_raw_csv", "read_raw_tables", "read_silver", "read_star", "register_views"]
