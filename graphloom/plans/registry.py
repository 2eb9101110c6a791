"""All registered queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from graphloom.plans import data_quality, graph_queries, library_queries, merge_queries, plan_queries, retrieval_queries, store_queries, text_queries

MODULES = (data_quality, graph_queries, merge_queries, retrieval_queries, plan_queries, text_queries, library_queries, store_queries)
FLAGSHIP = "r11_mode_hybrid"


def queries() -> dict[str, Callable]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
