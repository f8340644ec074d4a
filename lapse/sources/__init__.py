"""Scans and the derived input views (profile, ledger, economic series)."""

from lapse.sources.readers import econ_dimension, nan_to_null, parse_dates, read_table
from lapse.sources.views import Tables

__all__ = ["read_table", "nan_to_null", "parse_dates", "econ_dimension", "Tables"]
