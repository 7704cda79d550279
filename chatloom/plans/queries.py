"""All registered queries of the core and their SQL."""

from __future__ import annotations

from . import review  # noqa: F401  (registers its queries)
from .catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
