"""Readers and writers."""

from statera.sources.banner import read_banner_table
from statera.sources.dump import read_dump
from statera.sources.files import ORDINAL, read_clean_csv, read_if_present, read_raw_csv
from statera.sources.sinks import conform, write_tables

__all__ = [
    "ORDINAL",
    "conform",
    "read_banner_table",
    "read_clean_csv",
    "read_dump",
    "read_if_present",
    "read_raw_csv",
    "write_tables",
]
