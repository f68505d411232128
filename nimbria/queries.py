"""All registered queries outside the training-data operators: name -> (query, SQL or None)."""

from __future__ import annotations

from nimbria.plans import grid_queries, interval_queries, planning_queries, product_queries, sequence_queries, source_queries, spatial_queries
from nimbria.streaming import queries as streaming

ALL = {**product_queries.QUERIES, **spatial_queries.QUERIES, **grid_queries.QUERIES, **interval_queries.QUERIES, **source_queries.QUERIES, **planning_queries.QUERIES, **sequence_queries.QUERIES, **streaming.QUERIES}


def queries() -> dict:
    return {name: query for name, (query, _) in ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in ALL.items() if sql}
