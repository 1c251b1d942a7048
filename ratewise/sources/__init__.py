"""Scans: driver tables, review files, the recommendation store, records."""

from ratewise.sources.tables import read_table  # noqa: F401
