"""Every registered query of the panel engine, with its SQL."""

from __future__ import annotations

from . import checking, cleaning, domain, filings, ingesting, measuring, panel, questions, relational, sampling  # noqa: F401  they register
from .registry import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
