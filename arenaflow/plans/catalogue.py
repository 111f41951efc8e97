"""All queries of the core, and their SQL."""

from __future__ import annotations

from . import analysis, league, media, training
from .base import QUERIES as _QUERIES
from .base import SQL as _SQL

FLAGSHIP = "match_features"
QUERIES = {**training.QUERIES, **_QUERIES}
SQL = {**training.SQL, **_SQL}

__all__ = ["FLAGSHIP", "QUERIES", "SQL", "analysis", "league", "media"]
