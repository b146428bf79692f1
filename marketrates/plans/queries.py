"""All registered queries and their SQL."""

from __future__ import annotations

from . import audit, checks, market, presentation, published, scalar  # noqa: F401  they register theirs
from .registry import Query, _oracles, _queries


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)
