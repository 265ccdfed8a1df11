"""Queries over region graphs of the scanned pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafgraph.functions import geometry as g
from leafgraph.operators import graph as G
from leafgraph.sources.dataset import DEMO_REGIONS, demo_regions, regions_of_payload
from leafgraph.sources.tables import table


def nodes(s, d):
    return G.graph_nodes(table(s, d, "graph_visualization_output"))


def edges(s, d):
    return G.graph_edges(nodes(s, d))


def rounded(df, *names, places=6):
    return df.withColumns({n: F.round(n, places) for n in names})


def _flat_documents(docs):
    """Every part of the nested documents as text, so that both engines compare them whole."""
    units = lambda x, n: F.floor(x * n + 0.5).cast("long").cast("string")
    at = lambda x: F.concat_ws(",", *(units(x[i][j], 1000.0) for i in (0, 2) for j in (0, 1)))
    show = lambda c, f: F.array_join(F.transform(c, f), "¶")
    nodes_text = show("nodes", lambda n: F.concat_ws("|", n["node_id"].cast("string"), F.coalesce(n["region_type"], F.lit("-")), at(n["bbox"]), F.coalesce(units(n["score"], 10000.0), F.lit("-")), n["text"]))
    edges_text = show("edges", lambda e: F.concat_ws("|", e["source"].cast("string"), e["target"].cast("string"), e["relation"], units(e["score"], 10000.0), e["category"]))
    entries = F.array_sort(F.transform(F.map_entries("adjacency"), lambda x: F.struct(x["key"].cast("int").alias("k"), x["value"].alias("v"))))
    adjacency = show(entries, lambda x: F.concat(x["k"].cast("string"), F.lit(":"), F.array_join(x["v"].cast("array<string>"), ",")))
    return docs.select("doc_id", "page_no", "version", "metadata.source_image", "metadata.num_regions", "metadata.num_nodes", "metadata.num_edges", nodes_text.alias("nodes"), edges_text.alias("edges"), adjacency.alias("adjacency"))


def _payloads(s, d):
    """Each page as a stored result: its regions under ``layout``, at the top, or (every third page) nowhere."""
    rows = G.latest(table(s, d, "graph_visualization_output", "doc_id", "page_no", "node_id", "region_type", "bbox", "score", "text", "created_at", "region_id"), ("doc_id", "page_no", "node_id"), ("created_at", "region_id"))
    block = F.struct("bbox", F.array(F.struct(F.coalesce("text", F.lit("")).alias("text"))).alias("lines")).alias("block")
    pages = rows.filter("doc_id IS NOT NULL AND page_no IS NOT NULL AND node_id IS NOT NULL").groupBy("doc_id", "page_no").agg(F.array_sort(F.collect_list(F.struct("node_id", "region_type", "score", block))).alias("regions"))
    third = F.pmod("page_no", F.lit(3))
    payload = F.when(third == 0, F.to_json(F.struct(F.struct("regions").alias("layout")))).when(third == 1, F.to_json(F.struct("regions"))).otherwise(F.lit('{"ocr": {}}'))
    return pages.select("doc_id", "page_no", payload.alias("payload"))


QUERIES = {
    "graph_nodes": lambda s, d: rounded(nodes(s, d), "xmin", "ymin", "xmax", "ymax"),
    "graph_edges_topk": lambda s, d: rounded(edges(s, d), "score"),
    "graph_relations": lambda s, d: rounded(G.relations(nodes(s, d)), "score"),
    "graph_semantic_edges": lambda s, d: rounded(edges(s, d).filter(F.col("relation").isin("is_caption_of", "has_caption", "explains", "has_explanation")), "score"),
    "graph_adjacency": lambda s, d: G.adjacency(edges(s, d)).select("doc_id", "page_no", "source", F.array_join(F.col("neighbors").cast("array<string>"), ",").alias("neighbors")),
    "graph_undirected_adjacency": lambda s, d: G.undirected_adjacency(nodes(s, d), edges(s, d)),
    "graph_degree_stats": lambda s, d: rounded(G.degree_stats(nodes(s, d), edges(s, d)), "avg_out", "avg_in"),
    "edge_score_stats": lambda s, d: rounded(G.score_stats(edges(s, d)), "mean", "lower_quartile", "median", "upper_quartile", "least", "greatest", "deviation"),
    "edge_scores_by_relation": lambda s, d: rounded(G.score_stats(edges(s, d), "relation"), "mean", "lower_quartile", "median", "upper_quartile", "least", "greatest", "deviation"),
    "edge_score_histogram": lambda s, d: G.score_histogram(edges(s, d)),
    "relation_distribution": lambda s, d: rounded(G.share_of_total(edges(s, d), "relation"), "percent"),
    "region_type_distribution": lambda s, d: rounded(G.share_of_total(nodes(s, d), "region_type"), "percent"),
    "top_edges": lambda s, d: rounded(G.edge_ends(nodes(s, d), edges(s, d)).orderBy(F.desc("score"), "doc_id", "page_no", "source", "target", "relation").limit(20), "score").drop("rank"),
    "canvas_extent": lambda s, d: G.canvas(nodes(s, d)),
    "demo_graph": lambda s, d: rounded(G.graph_edges(demo_regions(s)), "score"),
    "stored_regions": lambda s, d: regions_of_payload(_payloads(s, d)).select("doc_id", "page_no", "node_id", "region_type", "score", "text", F.coalesce(F.size("bbox"), F.lit(-1)).alias("corners")),
    "graph_documents": lambda s, d: _flat_documents(G.graph_documents(nodes(s, d), edges(s, d))),
}


def _beside(first: str, shared: str, gap: str) -> str:
    return f"CASE WHEN {first} AND {shared} >= 0.3 THEN 0.6e0 * {shared} + 0.4e0 * greatest(0e0, 1e0 - greatest(0e0, {gap}) / 500e0) ELSE 0e0 END"


def _ov(a: str, b: str, lo: str, hi: str) -> str:
    least = f"least({a}.{hi} - {a}.{lo}, {b}.{hi} - {b}.{lo})"
    return f"(CASE WHEN {least} > 0 THEN greatest(0e0, least({a}.{hi}, {b}.{hi}) - greatest({a}.{lo}, {b}.{lo})) / {least} ELSE 0e0 END)"


def _left(a: str, b: str) -> str:
    return _beside(f"({a}.xmin + {a}.xmax) / 2 < ({b}.xmin + {b}.xmax) / 2", _ov(a, b, "ymin", "ymax"), f"{b}.xmin - {a}.xmax")


def _above(a: str, b: str) -> str:
    return _beside(f"({a}.ymin + {a}.ymax) / 2 < ({b}.ymin + {b}.ymax) / 2", _ov(a, b, "xmin", "xmax"), f"{b}.ymin - {a}.ymax")


def _area(a: str) -> str:
    return f"(({a}.xmax - {a}.xmin) * ({a}.ymax - {a}.ymin))"


def _inside(a: str, b: str) -> str:
    return f"CASE WHEN {a}.xmin >= {b}.xmin AND {a}.ymin >= {b}.ymin AND {a}.xmax <= {b}.xmax AND {a}.ymax <= {b}.ymax AND {_area(b)} <> 0 THEN 1e0 - {_area(a)} / {_area(b)} ELSE 0e0 END"


_DIST = "sqrt(((a.xmin + a.xmax) / 2 - (b.xmin + b.xmax) / 2) ** 2 + ((a.ymin + a.ymax) / 2 - (b.ymin + b.ymax) / 2) ** 2)"

NODES_SQL = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, page_no, node_id ORDER BY created_at DESC NULLS LAST, region_id DESC) AS rn FROM graph_visualization_output
),
nodes AS (
  SELECT doc_id, page_no, node_id, region_type, list_min(list_transform(bbox, lambda p: p[1])) AS xmin, list_min(list_transform(bbox, lambda p: p[2])) AS ymin,
         list_max(list_transform(bbox, lambda p: p[1])) AS xmax, list_max(list_transform(bbox, lambda p: p[2])) AS ymax, score,
         substr(replace(coalesce(text, ''), chr(10), ' '), 1, 200) AS text,
         coalesce(region_type = 'text' AND len(string_split(coalesce(text, ''), chr(10))) <= 3 AND length(replace(coalesce(text, ''), chr(10), '')) < 150, false) AS is_short, coalesce(text, '') AS whole
  FROM ranked WHERE rn = 1 AND bbox IS NOT NULL AND doc_id IS NOT NULL AND page_no IS NOT NULL AND node_id IS NOT NULL
)
"""

_OBJ_A, _OBJ_B = "coalesce(a.region_type IN ('figure', 'table'), false)", "coalesce(b.region_type IN ('figure', 'table'), false)"


def edges_sql(names: tuple[str, ...] = ("pairs", "scored", "relations", "kept", "edges")) -> str:
    """SQL tables from ``nodes`` to ``edges``, by these names."""
    pairs, scored, relations, kept, edges = names
    return f""",
{pairs} AS (
  SELECT a.doc_id, a.page_no, a.node_id AS source, b.node_id AS target, {_left("a", "b")} AS s0, {_left("b", "a")} AS s1, {_above("a", "b")} AS s2, {_above("b", "a")} AS s3,
         {_inside("a", "b")} AS s4, {_inside("b", "a")} AS s5, {_DIST} AS dist, a.is_short AS sa, b.is_short AS sb, {_OBJ_A} AS oa, {_OBJ_B} AS ob, a.region_type AS ta, b.region_type AS tb
  FROM nodes a JOIN nodes b ON a.doc_id = b.doc_id AND a.page_no = b.page_no AND a.node_id <> b.node_id
),
{scored} AS (
  SELECT *, CASE WHEN dist <= 200 THEN greatest(0e0, 1e0 - dist / 200e0) ELSE 0e0 END AS s6,
         CASE WHEN sa AND ob AND s2 > 0 THEN 0.9e0 * s2 WHEN sa AND ob AND s3 > 0 THEN 0.8e0 * s3 WHEN oa AND sb AND s3 > 0 THEN 0.9e0 * s3 WHEN oa AND sb AND s2 > 0 THEN 0.8e0 * s2
              WHEN dist < 200 AND ((ta = 'table' AND tb = 'text' AND NOT sb) OR (ta = 'text' AND tb = 'table' AND NOT sa)) THEN 0.7e0 * (1e0 - dist / 200e0) ELSE 0e0 END AS s7,
         CASE WHEN sa AND ob AND (s2 > 0 OR s3 > 0) THEN 'is_caption_of' WHEN oa AND sb AND (s2 > 0 OR s3 > 0) THEN 'has_caption'
              WHEN dist < 200 AND ta = 'table' AND tb = 'text' AND NOT sb THEN 'has_explanation' WHEN dist < 200 AND ta = 'text' AND tb = 'table' AND NOT sa THEN 'explains' END AS cap
  FROM {pairs}
),
{relations} AS (
  SELECT doc_id, page_no, source, target, 0 AS rel_ord, 'left_of' AS relation, s0 AS score, 'spatial' AS category FROM {scored}
  UNION ALL SELECT doc_id, page_no, source, target, 1, 'right_of', s1, 'spatial' FROM {scored}
  UNION ALL SELECT doc_id, page_no, source, target, 2, 'above', s2, 'spatial' FROM {scored}
  UNION ALL SELECT doc_id, page_no, source, target, 3, 'below', s3, 'spatial' FROM {scored}
  UNION ALL SELECT doc_id, page_no, source, target, 4, 'inside', s4, 'spatial' FROM {scored}
  UNION ALL SELECT doc_id, page_no, source, target, 5, 'contains', s5, 'spatial' FROM {scored}
  UNION ALL SELECT doc_id, page_no, source, target, 6, 'nearest_neighbor', s6, 'proximity' FROM {scored}
  UNION ALL SELECT doc_id, page_no, source, target, 7, cap, s7, 'semantic' FROM {scored} WHERE cap IS NOT NULL
),
{kept} AS (SELECT * FROM {relations} WHERE score >= 0.2),
{edges} AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_no, source ORDER BY score DESC, target, rel_ord) AS rank FROM {kept}) WHERE rank <= 5
)
"""

EDGES_SQL = NODES_SQL + edges_sql()

_E = "SELECT doc_id, page_no, source, target, relation, round(score, 6) AS score, category, rank FROM edges"
_STATS = "count(*) AS edges, round(avg(score), 6) AS mean, round(quantile_cont(score, 0.25), 6) AS lower_quartile, round(median(score), 6) AS median, round(quantile_cont(score, 0.75), 6) AS upper_quartile, round(min(score), 6) AS least, round(max(score), 6) AS greatest, round(stddev_pop(score), 6) AS deviation"

ORACLE = {
    "graph_nodes": NODES_SQL + "SELECT * FROM nodes",
    "graph_edges_topk": EDGES_SQL + _E,
    "graph_relations": EDGES_SQL + "SELECT doc_id, page_no, source, target, rel_ord, relation, round(score, 6) AS score, category FROM kept",
    "graph_semantic_edges": EDGES_SQL + _E + " WHERE relation IN ('is_caption_of', 'has_caption', 'explains', 'has_explanation')",
    "graph_adjacency": EDGES_SQL + "SELECT doc_id, page_no, source, string_agg(target::VARCHAR, ',' ORDER BY rank) AS neighbors FROM edges GROUP BY ALL",
    "graph_undirected_adjacency": EDGES_SQL
    + """, both_ways AS (
  SELECT doc_id, page_no, source AS node_id, target AS neighbor, rank, 0 AS back, source AS s FROM edges
  UNION ALL SELECT doc_id, page_no, target, source, rank, 1, source FROM edges)
SELECT doc_id, page_no, node_id, neighbor, row_number() OVER (PARTITION BY doc_id, page_no, node_id ORDER BY s, rank, back) - 1 AS at FROM both_ways SEMI JOIN nodes USING (doc_id, page_no, node_id)""",
    "graph_degree_stats": EDGES_SQL
    + """, o AS (SELECT doc_id, page_no, source AS node_id, count(*) AS o FROM edges GROUP BY ALL), i AS (SELECT doc_id, page_no, target AS node_id, count(*) AS i FROM edges GROUP BY ALL)
SELECT n.doc_id, n.page_no, count(*) AS nodes, round(avg(coalesce(o, 0)), 6) AS avg_out, max(coalesce(o, 0)) AS max_out, round(avg(coalesce(i, 0)), 6) AS avg_in, max(coalesce(i, 0)) AS max_in
FROM nodes n LEFT JOIN o USING (doc_id, page_no, node_id) LEFT JOIN i USING (doc_id, page_no, node_id) GROUP BY n.doc_id, n.page_no""",
    "edge_score_stats": EDGES_SQL + f"SELECT {_STATS} FROM edges",
    "edge_scores_by_relation": EDGES_SQL + f"SELECT relation, {_STATS} FROM edges GROUP BY relation",
    "edge_score_histogram": EDGES_SQL
    + """, ends AS (SELECT min(score) AS lo, max(score) AS hi FROM edges)
SELECT CAST(least(floor((score - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS edges FROM edges, ends GROUP BY 1""",
    "relation_distribution": EDGES_SQL + "SELECT relation, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM edges GROUP BY relation",
    "region_type_distribution": NODES_SQL + "SELECT region_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM nodes GROUP BY region_type",
    "top_edges": EDGES_SQL
    + """SELECT e.doc_id, e.page_no, source, target, relation, round(e.score, 6) AS score, category, a.region_type AS source_type, a.text AS source_text, b.region_type AS target_type, b.text AS target_text
FROM edges e JOIN nodes a ON e.doc_id = a.doc_id AND e.page_no = a.page_no AND source = a.node_id JOIN nodes b ON e.doc_id = b.doc_id AND e.page_no = b.page_no AND target = b.node_id
ORDER BY e.score DESC, e.doc_id, e.page_no, source, target, relation LIMIT 20""",
    "canvas_extent": NODES_SQL + "SELECT doc_id, page_no, max(xmax) + 50 AS width, max(ymax) + 50 AS height FROM nodes GROUP BY ALL",
    "demo_graph": f"WITH nodes AS (SELECT 'demo' AS doc_id, 1 AS page_no, * FROM (VALUES {', '.join(str((k, *r[:5], r[6].replace(chr(39), chr(39) * 2), False)) for k, r in enumerate(DEMO_REGIONS))}) v(node_id, region_type, xmin, ymin, xmax, ymax, text, is_short))"
    + edges_sql()
    + "SELECT doc_id, page_no, source, target, relation, round(score, 6) AS score, category, rank FROM edges",
    "stored_regions": """WITH newest AS (SELECT * FROM graph_visualization_output WHERE doc_id IS NOT NULL AND page_no IS NOT NULL AND node_id IS NOT NULL AND page_no % 3 < 2
  QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, node_id ORDER BY created_at DESC NULLS LAST, region_id DESC) = 1)
SELECT doc_id, page_no, CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY node_id) - 1 AS INTEGER) AS node_id, region_type, score, coalesce(text, '') AS text, CAST(coalesce(len(bbox), -1) AS INTEGER) AS corners FROM newest""",
    "graph_documents": EDGES_SQL
    + """, adj AS (SELECT doc_id, page_no, source, string_agg(target::VARCHAR, ',' ORDER BY rank) AS v FROM edges GROUP BY ALL),
a AS (SELECT doc_id, page_no, string_agg(source || ':' || v, '¶' ORDER BY source) AS adjacency FROM adj GROUP BY ALL),
e AS (SELECT doc_id, page_no, count(*) AS m, string_agg(concat_ws('|', source, target, relation, CAST(CAST(floor(score * 10000e0 + 0.5e0) AS BIGINT) AS VARCHAR), category), '¶' ORDER BY source, rank) AS edges FROM edges GROUP BY ALL),
n AS (SELECT doc_id, page_no, count(*) AS num_nodes, string_agg(concat_ws('|', node_id, coalesce(region_type, '-'), concat_ws(',', CAST(floor(xmin * 1000e0 + 0.5e0) AS BIGINT), CAST(floor(ymin * 1000e0 + 0.5e0) AS BIGINT), CAST(floor(xmax * 1000e0 + 0.5e0) AS BIGINT), CAST(floor(ymax * 1000e0 + 0.5e0) AS BIGINT)),
  coalesce(CAST(CAST(floor(score * 10000e0 + 0.5e0) AS BIGINT) AS VARCHAR), '-'), text), '¶' ORDER BY node_id) AS nodes FROM nodes GROUP BY ALL)
SELECT doc_id, page_no, '1.0.0' AS version, doc_id || '_' || page_no || '.png' AS source_image, CAST(num_nodes AS INTEGER) AS num_regions, CAST(num_nodes AS INTEGER) AS num_nodes, CAST(coalesce(m, 0) AS INTEGER) AS num_edges, nodes, coalesce(edges, '') AS edges, coalesce(adjacency, '') AS adjacency
FROM n LEFT JOIN e USING (doc_id, page_no) LEFT JOIN a USING (doc_id, page_no)""",
}
