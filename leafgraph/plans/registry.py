"""All queries of the library, and the SQL that each must agree with."""

from __future__ import annotations

from leafgraph.plans import graph_queries, layout_queries, nested_queries, qa_queries, text_queries

_MODULES = [graph_queries, layout_queries, text_queries, qa_queries, nested_queries]


def all_queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def all_oracles() -> dict:
    return {k: v for m in _MODULES for k, v in m.ORACLE.items()}
