"""Registered queries and the SQL they are checked against."""

from . import access_queries, file_queries, validation_queries, zone_queries  # noqa: F401
from .registry import ORACLES, QUERIES, bind

__all__ = ["ORACLES", "QUERIES", "bind"]
