"""Registered queries over the star-schema tables."""

from . import catalogue, decisions, editorial, indexes, texts, upkeep  # noqa: F401  (register their queries)
from .flagship import flagship
from .registry import oracle_sql, queries

__all__ = ["flagship", "oracle_sql", "queries"]
