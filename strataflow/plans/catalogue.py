"""All queries of the library by name, with their SQL counterparts."""

from __future__ import annotations

from . import curves, extraction, governance, knowledge, mapping, quality, records, relational, resolution, tables, wells  # noqa: F401  they register their queries
from .registry import ORACLES, QUERIES, Query

FLAGSHIP = "rig_summary"


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
