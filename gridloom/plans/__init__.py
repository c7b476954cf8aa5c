"""Registered queries of the engine and their DuckDB counterparts."""

from . import catalog, columns, composite, mosaic, robust  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
