"""Registered queries over the given tables, with the SQL that checks them."""

from pagemart.registry import extract, filters_joins, scalars, sources_links, stateful  # noqa: F401
from pagemart.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
