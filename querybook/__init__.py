"""Registered queries: each operator over the given tables, with its SQL where SQL can say it."""

from __future__ import annotations

from querybook import announcements, boards, disclosure, feeds, logs, pages, scalars, search, statements, streams  # noqa: F401
from querybook.base import BOOK

__all__ = ["BOOK"]
