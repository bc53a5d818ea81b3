"""The queries over the standard tables, with their DuckDB SQL."""

from __future__ import annotations

from . import q_annotation, q_features, q_hits, q_markup, q_more, q_relational, q_structure, q_text, q_trees  # noqa: F401 - they register their queries
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
