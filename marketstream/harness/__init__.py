"""Check set-up: the ``events`` table seen as a market feed, queries over it, and their SQL twins."""

from .oracles import oracle_sql
from .queries import flagship, queries

__all__ = ["flagship", "oracle_sql", "queries"]
