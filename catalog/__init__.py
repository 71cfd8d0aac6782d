"""Registered queries and the SQL that checks them."""

from catalog import (  # noqa: F401
    aggregates,
    dedup,
    extract,
    jobs,
    labels,
    models,
    search,
    sources,
    text,
)
from catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
