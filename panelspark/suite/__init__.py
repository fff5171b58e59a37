"""Registered queries over the given tables, each with equivalent SQL where SQL can say it."""

from . import build_queries, panel_queries, quality_queries, relational_queries, source_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
