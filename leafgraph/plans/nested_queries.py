"""Queries over raw graph JSON (problem 5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafgraph.operators.nested import graph_links, graph_tables, json_elements
from leafgraph.sources.tables import table


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "graph_json", "record_id", "payload")


QUERIES = {
    "p5_found": lambda s, d: graph_links(_raw(s, d)),
    "p5_documents": lambda s, d: graph_tables(_raw(s, d))["documents"],
    "p5_nodes": lambda s, d: graph_tables(_raw(s, d))["nodes"],
    "p5_edges": lambda s, d: graph_tables(_raw(s, d))["edges"],
    "p5_neighbors": lambda s, d: graph_tables(_raw(s, d))["neighbors"],
    "p5_elements": lambda s, d: json_elements(_raw(s, d)),
}

#: Payloads as JSON values, out of marks and of strings that hold JSON; then one row per graph document.
_DOCS = """
WITH stripped AS (SELECT record_id, ltrim(payload, chr(65279) || ' ') AS p FROM graph_json),
once AS (SELECT record_id, CASE WHEN json_valid(p) AND json_type(p) = 'VARCHAR' THEN ltrim((p ->> '$'), chr(65279) || ' ') ELSE p END AS p FROM stripped),
valid AS (SELECT record_id, p::JSON AS p FROM once WHERE json_valid(p) AND json_type(p) = 'OBJECT'),
placed AS (
  SELECT record_id, 0 AS doc_pos, p FROM valid WHERE (p -> 'documents') IS NULL
  UNION ALL
  SELECT record_id, CAST(i AS INTEGER), (p -> 'documents' -> CAST(i AS INTEGER))
  FROM (SELECT record_id, p, unnest(range(json_array_length(p, '$.documents')::BIGINT)) AS i FROM valid WHERE (p -> 'documents') IS NOT NULL)
),
opened AS (SELECT record_id, doc_pos, CASE WHEN (p -> 'nodes') IS NULL AND (p -> 'data') IS NOT NULL THEN (p -> 'data') ELSE p END AS p FROM placed),
docs AS (
  SELECT record_id, doc_pos, p AS doc, CASE WHEN (p -> 'nodes') IS NULL AND (p -> 'graph') IS NOT NULL THEN (p -> 'graph') ELSE p END AS g FROM opened
),
graphs AS (SELECT * FROM docs WHERE (g -> 'nodes') IS NOT NULL OR (g -> 'edges') IS NOT NULL OR (g -> 'adjacency') IS NOT NULL),
node AS (
  SELECT record_id, doc_pos, CAST(i AS INTEGER) AS pos, (g -> 'nodes' -> CAST(i AS INTEGER)) AS n
  FROM (SELECT record_id, doc_pos, g, unnest(range(coalesce(json_array_length(g, '$.nodes')::BIGINT, 0))) AS i FROM graphs)
),
edge AS (
  SELECT record_id, doc_pos, CAST(i AS INTEGER) AS pos, (g -> 'edges' -> CAST(i AS INTEGER)) AS e
  FROM (SELECT record_id, doc_pos, g, unnest(range(coalesce(CASE WHEN json_type(g, '$.edges') = 'ARRAY' THEN json_array_length(g, '$.edges')::BIGINT END, 0))) AS i FROM graphs)
),
lists AS (
  SELECT record_id, doc_pos, CAST(k AS BIGINT) AS node, json_extract((g -> 'adjacency'), '$."' || k || '"') AS l
  FROM (SELECT record_id, doc_pos, g, unnest(json_keys(g, '$.adjacency')) AS k FROM graphs WHERE json_type(g, '$.adjacency') = 'OBJECT')
  UNION ALL
  SELECT record_id, doc_pos, CAST((a ->> 'node') AS BIGINT), (a -> 'neighbors')
  FROM (SELECT record_id, doc_pos, (g -> 'adjacency' -> CAST(i AS INTEGER)) AS a
        FROM (SELECT record_id, doc_pos, g, unnest(range(json_array_length(g, '$.adjacency')::BIGINT)) AS i FROM graphs WHERE json_type(g, '$.adjacency') = 'ARRAY'))
),
neighbor AS (
  SELECT DISTINCT record_id, doc_pos, CAST(i AS INTEGER) AS pos, node, CAST((l ->> CAST(i AS INTEGER)) AS BIGINT) AS neighbor
  FROM (SELECT record_id, doc_pos, node, l, unnest(range(json_array_length(l)::BIGINT)) AS i FROM lists)
)
"""

ORACLE = {
    "p5_found": _DOCS
    + """
SELECT record_id, doc_pos, 'document' AS child_kind, 0 AS pos, coalesce(TRY_CAST((doc -> 'metadata' ->> 'num_nodes') AS BIGINT), -1) AS key_a,
       coalesce(TRY_CAST((doc -> 'metadata' ->> 'num_edges') AS BIGINT), -1) AS key_b FROM graphs
UNION ALL
SELECT record_id, doc_pos, 'node', pos, coalesce(TRY_CAST((n ->> 'node_id') AS BIGINT), pos), -1 FROM node
UNION ALL
SELECT record_id, doc_pos, 'edge', pos, coalesce(TRY_CAST((e ->> 'source') AS BIGINT), -1), coalesce(TRY_CAST((e ->> 'target') AS BIGINT), -1) FROM edge
UNION ALL
SELECT record_id, doc_pos, 'neighbor', pos, node, neighbor FROM neighbor
""",
    "p5_documents": _DOCS
    + """
SELECT record_id, doc_pos, (doc ->> 'version') AS version, (doc ->> 'created_at') AS created_at, (doc -> 'metadata' ->> 'source_image') AS source_image,
       TRY_CAST((doc -> 'metadata' ->> 'num_regions') AS BIGINT) AS num_regions, TRY_CAST((doc -> 'metadata' ->> 'num_nodes') AS BIGINT) AS num_nodes,
       TRY_CAST((doc -> 'metadata' ->> 'num_edges') AS BIGINT) AS num_edges FROM graphs
""",
    "p5_edges": _DOCS
    + """
SELECT record_id, doc_pos, pos, TRY_CAST((e ->> 'source') AS BIGINT) AS source, TRY_CAST((e ->> 'target') AS BIGINT) AS target, (e ->> 'relation') AS relation,
       TRY_CAST((e ->> 'score') AS DOUBLE) AS score, (e ->> 'category') AS category FROM edge
""",
    "p5_neighbors": _DOCS + "SELECT record_id, doc_pos, pos, node, neighbor FROM neighbor",
}
