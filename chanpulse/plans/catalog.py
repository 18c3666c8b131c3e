"""Every registered query and its oracle SQL (import side effects fill the
registry)."""

from __future__ import annotations

from . import registered_analytics, registered_io, registered_jobs, registered_tables  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
