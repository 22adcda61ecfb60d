"""All registered queries."""

from __future__ import annotations

from siltstone.workload import (  # noqa: F401
    column_queries,
    model_queries,
    profile_queries,
    relation_queries,
    series_queries,
    stage_queries,
    state_queries,
)
from siltstone.workload.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
