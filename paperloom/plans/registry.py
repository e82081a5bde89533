"""All queries by name, and the SQL that checks them."""

from __future__ import annotations

from . import oracles, oracles_more, queries_more, queries_pages
from .queries import QUERIES


def queries() -> dict:
    return {q.__name__: q for q in (*QUERIES, *queries_more.QUERIES, *queries_pages.QUERIES)}


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in (oracles.sql() | oracles_more.sql() | queries_pages.SQL).items() if k in queries()}
