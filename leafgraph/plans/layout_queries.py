"""Queries of the layout stage over rendered pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafgraph.operators import graph as G
from leafgraph.operators import layout as L
from leafgraph.operators import stats
from leafgraph.operators.pages import full_export, page_results
from leafgraph.functions.textnorm import WS
from leafgraph.plans.graph_queries import edges_sql, rounded
from leafgraph.plans.render import DOCUMENT_TOKENS_SQL, ORDER_TOKENS_SQL, REGION_TOKENS_SQL, document_tokens, order_tokens, region_pages, region_tokens
from leafgraph.plans.text_queries import _CLOCK_SQL

_LINE = ("doc_id", "line_id", "text", "xmin", "ymin", "xmax", "ymax", "tokens")


def _doc_layout(s, d):
    return L.analyze(document_tokens(s, d))


def _order_layout(s, d):
    return L.analyze(order_tokens(s, d))


def _page_layout(s, d):
    return L.analyze(region_tokens(s, d))


def _region_rows(result):
    return rounded(result["regions"].select("doc_id", "region_id", "block_id", "region_type", "score"), "score")


def _scores(s, d, kind):
    return rounded(_doc_layout(s, d)["hypotheses"].filter(F.col("region_type") == kind).select("doc_id", "block_id", "score", "flag"), "score")


def _variants(s, d):
    """Recognition of each document as it is, and without tokens that are signs only, side by side."""
    t = document_tokens(s, d)
    both = t.withColumn("variant", F.lit("plain")).unionByName(t.filter(F.col("text").rlike(r"[\p{L}\p{N}]")).withColumn("variant", F.lit("cleaned")))
    return rounded(stats.variants(stats.recognition(both, "doc_id", "variant"), "doc_id", "variant", ["plain", "cleaned"], "num_lines", "avg_confidence"), "plain_avg_confidence", "cleaned_avg_confidence")


def _export_counts(export):
    joined = lambda c, f: F.array_join(F.transform(c, f), "|")
    return export.select(
        "doc_id", "version", "ocr.num_tokens", joined("ocr.tokens", lambda x: x["text"]).alias("tokens"), "layout.num_lines", joined("layout.lines", lambda x: x["text"]).alias("lines"), "layout.num_blocks",
        joined("layout.blocks", lambda x: x["lines"].cast("string")).alias("blocks"), "layout.num_regions", "graph.num_nodes", joined("layout.regions", lambda x: x["region_type"]).alias("regions"), "graph.num_edges",
        joined("graph.edges", lambda x: F.concat_ws(">", x["source"].cast("string"), x["target"].cast("string"))).alias("edges"),
    )


QUERIES = {
    "doc_medians": lambda s, d: rounded(L.medians(document_tokens(s, d), "doc_id"), "char_width", "line_height"),
    "recognition": lambda s, d: rounded(stats.recognition(document_tokens(s, d), "doc_id").select("doc_id", "num_lines", "avg_confidence", F.length("text").alias("chars")), "avg_confidence"),
    "lines": lambda s, d: L.lines(L.tokens_of_lines(document_tokens(s, d))).select(*_LINE),
    "blocks": lambda s, d: _doc_layout(s, d)["block_lines"].select("doc_id", "line_id", "block_id", "pos", "text", "is_form"),
    "order_form_lines": lambda s, d: _order_layout(s, d)["block_lines"].select("doc_id", "line_id", "block_id", "text", "is_form", "form_key", "form_value"),
    "kv_pattern": lambda s, d: rounded(L.key_values(_order_layout(s, d)["block_lines"]), "keyvalue_ratio", "avg_key_length"),
    "dbscan_columns": lambda s, d: rounded(L.column_islands(order_tokens(s, d).withColumn("cx", (F.col("xmin") + F.col("xmax")) / 2), F.lit(50.0), "doc_id"), "center"),
    "table_score": lambda s, d: _scores(s, d, "table"),
    "form_score": lambda s, d: _scores(s, d, "form"),
    "figure_score": lambda s, d: _scores(s, d, "figure"),
    "text_score": lambda s, d: _scores(s, d, "text"),
    "regions_top2": lambda s, d: _region_rows(_doc_layout(s, d)),
    "order_regions": lambda s, d: _region_rows(_order_layout(s, d)),
    "page_lines": lambda s, d: L.lines(L.tokens_of_lines(L.usable(region_tokens(s, d)))).select(*_LINE),
    "page_failures": lambda s, d: L.layout_failures(region_tokens(s, d)),
    "page_blocks": lambda s, d: rounded(_page_layout(s, d)["block_lines"].select("doc_id", "line_id", "block_id", "pos", "text", "xmin", "xmax", "is_form", "form_key", "form_value"), "xmin", "xmax"),
    "page_scores": lambda s, d: rounded(_page_layout(s, d)["hypotheses"].select("doc_id", "block_id", "region_type", "score", "flag"), "score"),
    "page_regions": lambda s, d: _region_rows(_page_layout(s, d)),
    "page_graphs": lambda s, d: rounded(G.graph_edges(L.region_nodes(_page_layout(s, d))), "score"),
    "box_iou": lambda s, d: rounded(G.overlaps(L.region_nodes(_page_layout(s, d))), "iou"),
    "recognition_variants": lambda s, d: _variants(s, d),
    "page_results": lambda s, d: page_results(region_pages(s, d)).select("doc_id", "success", "error", "num_regions", "num_nodes", "num_edges"),
    "full_export": lambda s, d: _export_counts(full_export(region_pages(s, d))),
}

_STRIP = lambda x: f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"
_KEY = r"[A-Za-z][A-Za-z0-9\s\-_/.]{0,35}"
_CENTER = "abs((a.{0}min + a.{0}max) / 2 - (b.{0}min + b.{0}max) / 2)"


def _shared(axis: str) -> str:
    """Overlap of a and b on an axis, as a share of the lesser extent."""
    lo, hi = axis + "min", axis + "max"
    least = f"least(a.{hi} - a.{lo}, b.{hi} - b.{lo})"
    return f"(CASE WHEN {least} > 0 THEN greatest(0e0, least(a.{hi}, b.{hi}) - greatest(a.{lo}, b.{lo})) / {least} ELSE 0e0 END)"


#: Lines of any page: pairs of tokens without any bins, joined to components by a recursive query.
_LINES_SQL = f""", usable AS (SELECT * FROM tokens WHERE doc_id NOT IN (SELECT doc_id FROM tokens WHERE xmin IS NULL OR ymin IS NULL OR xmax IS NULL OR ymax IS NULL)),
m AS (SELECT doc_id, median((xmax - xmin) / length(text)) AS cw, median(ymax - ymin) AS mh FROM usable GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id, a.token_id AS a, b.token_id AS b FROM usable a JOIN m ON m.doc_id = a.doc_id JOIN usable b ON a.doc_id = b.doc_id AND a.token_id <> b.token_id
  WHERE least(abs(a.xmax - b.xmin), abs(b.xmax - a.xmin)) < 3 * cw AND ({_shared("y")} >= 0.5 OR {_CENTER.format("y")} < 0.3e0 * mh)),
reach AS (SELECT doc_id, token_id AS id, token_id AS root FROM usable UNION SELECT r.doc_id, p.b, r.root FROM reach r JOIN pairs p ON p.doc_id = r.doc_id AND p.a = r.id WHERE r.root < p.b),
labels AS (SELECT doc_id, id AS token_id, min(root) AS label FROM reach GROUP BY doc_id, id),
raw_lines AS (SELECT doc_id, label, string_agg(text, ' ' ORDER BY (xmin + xmax) / 2, token_id) AS text, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, count(*) AS tokens
  FROM usable JOIN labels USING (doc_id, token_id) GROUP BY doc_id, label),
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY (ymin + ymax) / 2, label) - 1 AS INTEGER) AS line_id FROM raw_lines)
"""

#: Lines with fields marked. A line of several is cut at its colons: between two, the value ends where the rest can be a label.
_FORM_SQL = (
    _LINES_SQL
    + rf""", marked AS (SELECT *, len(regexp_extract_all(text, '{_KEY}:')) AS labels_n, {_STRIP("text")} AS t FROM numbered),
pieces_of AS (SELECT *, string_split(t, ':') AS parts FROM marked WHERE labels_n >= 2 AND NOT regexp_matches(text, '\d{{1,2}}:\d{{2}}')),
cut AS (SELECT doc_id, line_id, t, i, parts, len(parts) AS m, length(array_to_string(parts[1:i], ':')) AS colon,
  CASE WHEN i = 1 THEN '' ELSE regexp_extract(parts[i] || ':', '^(\s*[^:]+?)\s+({_KEY}):$', 2) END AS split_key,
  regexp_extract(parts[i] || ':', '({_KEY}):$', 1) AS any_key,
  regexp_extract(parts[i + 1] || ':', '^(\s*[^:]+?)\s+({_KEY}):$', 1) AS split_value FROM (SELECT *, unnest(range(1, len(parts))) AS i FROM pieces_of)),
fields AS (SELECT doc_id, line_id, i, t, colon, CASE WHEN split_key <> '' THEN split_key ELSE any_key END AS key, CASE WHEN i = m - 1 THEN parts[m] ELSE split_value END AS value FROM cut),
good AS (SELECT *, count(*) OVER (PARTITION BY doc_id, line_id) AS n, row_number() OVER (PARTITION BY doc_id, line_id ORDER BY i) - 1 AS part,
  (colon - length(key)) / length(t) AS lo, (colon + 1 + length(value)) / length(t) AS hi FROM fields WHERE key <> '' AND value <> ''),
form_text AS (SELECT doc_id, line_id, t, trim(regexp_extract(t, '^([A-Za-z][A-Za-z0-9\s\-_/.]{{0,38}}):\s*(.+)$', 1)) AS key, {_STRIP(r"regexp_extract(t, '^([A-Za-z][A-Za-z0-9\s\-_/.]{0,38}):\s*(.+)$', 2)")} AS value FROM marked),
one_field AS (SELECT doc_id, line_id, key, value FROM form_text WHERE key <> '' AND value <> '' AND length(key) <= 35 AND length(key) - length(replace(key, ' ', '')) <= 4 AND NOT regexp_matches(t, '{_CLOCK_SQL}')),
all_lines AS (
  SELECT doc_id, line_id AS from_line, CAST(0 AS BIGINT) AS part, text, xmin, xmax, ymin, ymax, labels_n < 2 AND f.key IS NOT NULL AS is_form, CASE WHEN labels_n < 2 THEN f.key END AS form_key, CASE WHEN labels_n < 2 THEN f.value END AS form_value, label, tokens
  FROM marked l LEFT JOIN one_field f USING (doc_id, line_id) WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.doc_id = l.doc_id AND g.line_id = l.line_id AND g.n >= 2)
  UNION ALL
  SELECT l.doc_id, l.line_id, g.part, {_STRIP("g.key")} || ': ' || {_STRIP("g.value")}, l.xmin + (l.xmax - l.xmin) * lo, l.xmin + (l.xmax - l.xmin) * hi, l.ymin, l.ymax, true, {_STRIP("g.key")}, {_STRIP("g.value")}, NULL, 0
  FROM marked l JOIN good g ON g.doc_id = l.doc_id AND g.line_id = l.line_id WHERE g.n >= 2),
form_rows AS (SELECT * EXCLUDE (from_line, part), CAST(row_number() OVER (PARTITION BY doc_id ORDER BY from_line, part) - 1 AS INTEGER) AS line_id FROM all_lines)
"""
)

_BLOCKS_SQL = (
    _FORM_SQL
    + f""", widths AS (SELECT doc_id, median(xmax - xmin) AS lw FROM form_rows GROUP BY doc_id),
line_pairs AS (
  SELECT a.doc_id, a.line_id AS a, b.line_id AS b FROM form_rows a JOIN widths w ON w.doc_id = a.doc_id JOIN form_rows b ON a.doc_id = b.doc_id AND a.line_id <> b.line_id
  WHERE least(abs(a.ymax - b.ymin), abs(b.ymax - a.ymin)) < 20 AND a.is_form = b.is_form AND (abs(a.xmin - b.xmin) < 0.05e0 * lw OR (NOT a.is_form AND {_shared("x")} >= 0.3))),
line_reach AS (SELECT doc_id, line_id AS id, line_id AS root FROM form_rows UNION SELECT r.doc_id, p.b, r.root FROM line_reach r JOIN line_pairs p ON p.doc_id = r.doc_id AND p.a = r.id WHERE r.root < p.b),
block_of AS (SELECT doc_id, id AS line_id, min(root) AS block FROM line_reach GROUP BY doc_id, id),
block_rows AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, block_id ORDER BY (ymin + ymax) / 2, line_id) - 1 AS INTEGER) AS pos FROM (
  SELECT f.*, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY block) - 1 AS INTEGER) AS block_id FROM form_rows f JOIN block_of USING (doc_id, line_id)))
"""
)

_KV_SQL = rf""", kv_text AS (SELECT doc_id, block_id, t, {_STRIP(r"regexp_extract(t, '^([^:]{1,50}):\s*(.+)$', 1)")} AS key, {_STRIP(r"regexp_extract(t, '^([^:]{1,50}):\s*(.+)$', 2)")} AS value FROM (SELECT *, {_STRIP("text")} AS t FROM block_rows)),
kv_lines AS (SELECT *, NOT regexp_matches(t, '{_CLOCK_SQL}') AND regexp_matches(t, '^([^:]{{1,50}}):\s*(.+)$') AND key <> '' AND length(key) < 50 AND value <> '' AND NOT regexp_matches(key, '{_CLOCK_SQL}') AS hit FROM kv_text),
kv AS (SELECT doc_id, block_id, count_if(hit) AS keyvalue_lines, count(*) AS n_lines, coalesce(avg(length(key)) FILTER (hit), 0) AS avg_key_length, count_if(hit) / count(*) AS keyvalue_ratio, count_if(hit) / count(*) >= 0.4 AND count_if(hit) >= 2 AS has_pattern FROM kv_lines GROUP BY ALL)
"""

_CELL = lambda v, lo, hi: f"coalesce(CAST(trunc(({v} - {lo}) / nullif({hi} - {lo}, 0) * 20) AS INTEGER), 0)"
_SCORES_SQL = (
    _BLOCKS_SQL
    + _KV_SQL
    + rf""", gaps AS (SELECT *, length(text) AS len, (ymin + ymax) / 2 - lag((ymin + ymax) / 2) OVER (PARTITION BY doc_id, block_id ORDER BY pos) AS gap FROM block_rows),
shape AS (SELECT doc_id, block_id, count(*) AS n, min(xmin) AS xmin, min(ymin) AS ymin, max(xmax) AS xmax, max(ymax) AS ymax, avg(len) AS avg_len, stddev_pop(len) AS sd_len, avg(xmin) AS m_left, stddev_pop(xmin) AS sd_left, avg(xmax) AS m_right, stddev_pop(xmax) AS sd_right,
  count_if(len < 40) / count(*) AS short, count_if(len > 60) / count(*) AS long, avg(gap) AS m_gap, stddev_pop(gap) AS sd_gap, avg(tokens) FILTER (tokens > 0) AS m_tok, stddev_pop(tokens) FILTER (tokens > 0) AS sd_tok, count_if(tokens >= 2) / count(*) AS multi FROM gaps GROUP BY ALL),
inside AS (SELECT u.*, b.block_id, b.line_id, (u.xmin + u.xmax) / 2 AS cx FROM usable u JOIN labels USING (doc_id, token_id) JOIN block_rows b ON b.doc_id = u.doc_id AND b.label = labels.label),
spaced AS (SELECT *, greatest(50e0, 5 * median((xmax - xmin) / length(text)) OVER (PARTITION BY doc_id, block_id)) AS wide, greatest(30e0, 3 * median((xmax - xmin) / length(text)) OVER (PARTITION BY doc_id, block_id)) AS slim,
  cx - lag(cx) OVER (PARTITION BY doc_id, block_id ORDER BY cx, token_id) AS step FROM inside),
runs AS (SELECT *, sum(CASE WHEN coalesce(step > wide, true) THEN 1 ELSE 0 END) OVER w AS r1, sum(CASE WHEN coalesce(step > slim, true) THEN 1 ELSE 0 END) OVER w AS r2 FROM spaced WINDOW w AS (PARTITION BY doc_id, block_id ORDER BY cx, token_id ROWS UNBOUNDED PRECEDING)),
columns_of AS (SELECT doc_id, block_id, r1, avg(cx) AS center FROM runs GROUP BY ALL HAVING count(*) >= 2),
col_n AS (SELECT doc_id, block_id, count(*) AS num_cols FROM columns_of GROUP BY ALL),
text_n AS (SELECT doc_id, block_id, count(*) AS text_cols FROM (SELECT doc_id, block_id, r2 FROM runs GROUP BY ALL HAVING count(*) >= 2) GROUP BY ALL),
aligned_n AS (SELECT r.doc_id, r.block_id, count(DISTINCT line_id) AS aligned FROM runs r JOIN columns_of c ON c.doc_id = r.doc_id AND c.block_id = r.block_id AND abs(r.cx - c.center) < r.wide GROUP BY ALL),
on_grid AS (SELECT i.*, s.xmin + 0.7e0 * (s.xmax - s.xmin) AS right_from, {_STRIP("text")} AS bare, {_CELL("i.xmin", "s.xmin", "s.xmax")} AS x1, {_CELL("i.xmax", "s.xmin", "s.xmax")} AS x2, {_CELL("i.ymin", "s.ymin", "s.ymax")} AS y1, {_CELL("i.ymax", "s.ymin", "s.ymax")} AS y2
  FROM inside i JOIN shape s ON s.doc_id = i.doc_id AND s.block_id = i.block_id),
tok_n AS (SELECT doc_id, block_id, count(*) AS token_n, count_if(regexp_matches(bare, '^-?\d+\.?\d*$') AND length(bare) <= 6) AS ticks, count_if(xmin > right_from) AS right_n FROM on_grid GROUP BY ALL),
full_n AS (SELECT doc_id, block_id, count(DISTINCT (x, y)) AS full_cells FROM (SELECT doc_id, block_id, x, unnest(range(greatest(y1, 5), least(y2, 14) + 1)) AS y FROM (SELECT *, unnest(range(greatest(x1, 5), least(x2, 14) + 1)) AS x FROM on_grid)) GROUP BY ALL),
seen AS (SELECT s.*, keyvalue_ratio AS colon, has_pattern, coalesce(num_cols, 0) AS num_cols, coalesce(text_cols, 0) AS text_cols, coalesce(aligned, 0) / n AS stable, coalesce(token_n, 0) AS token_n, coalesce(ticks, 0) AS ticks, coalesce(right_n, 0) AS right_n, coalesce(full_cells, 0) AS full_cells
  FROM shape s JOIN kv USING (doc_id, block_id) LEFT JOIN col_n USING (doc_id, block_id) LEFT JOIN text_n USING (doc_id, block_id) LEFT JOIN aligned_n USING (doc_id, block_id) LEFT JOIN tok_n USING (doc_id, block_id) LEFT JOIN full_n USING (doc_id, block_id)),
measured AS (SELECT *, n >= 2 AND token_n >= 5 AS can_table, coalesce(greatest(0e0, 1 - sd_tok / greatest(m_tok, 1e0)), 0e0) AS consistency, CASE WHEN m_gap > 0 THEN sd_gap / m_gap ELSE 1e0 END AS spread, 1 - least(1e0, sd_left / greatest(m_left, 1e0)) AS l, 1 - least(1e0, sd_right / greatest(m_right, 1e0)) AS r,
  sd_len / greatest(avg_len, 1e0) AS uneven, coalesce(1 - least(1e0, sd_gap / greatest(m_gap, 1e0)), 0e0) AS even, xmin = xmax OR ymin = ymax AS flat, 1 - full_cells / 100 AS empty FROM seen),
judged AS (SELECT *, l >= 0.8 AND r >= 0.7 AND long >= 0.5 AND avg_len > 50 AS justified, (colon >= 0.25 AND short >= 0.3 AND uneven > 0.25) OR (colon >= 0.1 AND l >= 0.65 AND r < 0.65 AND short >= 0.25) AS true_form FROM measured),
boosted AS (SELECT *, CASE WHEN n < 2 THEN 0e0 WHEN has_pattern THEN -0.3e0 WHEN justified THEN 0.4e0 * (l + r) / 2 + 0.3e0 * long + 0.3e0 * least(1e0, avg_len / 100) WHEN true_form THEN -0.2e0 ELSE 0e0 END AS boost, CASE WHEN justified THEN 0.3e0 ELSE 0e0 END AS jb FROM judged),
scores AS (
  SELECT doc_id, block_id, 0 AS type_ord, 'table' AS region_type, CASE WHEN can_table THEN 0.3e0 * num_cols / 10 + 0.25e0 * stable + 0.2e0 * consistency + 0.15e0 * multi + 0.1e0 * (1 - least(1e0, spread)) ELSE 0e0 END AS score,
    can_table AND num_cols >= 2 AND ((stable >= 0.5 AND spread < 0.4) OR (consistency >= 0.6 AND multi >= 0.6) OR (num_cols >= 3 AND stable >= 0.4)) AS flag, xmin, ymin, xmax, ymax FROM boosted
  UNION ALL SELECT doc_id, block_id, 1, 'form', CASE WHEN n < 2 THEN 0e0 WHEN has_pattern THEN 0.9e0 + 0.1e0 * colon WHEN justified THEN 0e0 WHEN true_form THEN 0.4e0 * colon + 0.3e0 * short + 0.2e0 * uneven + 0.1e0 * l ELSE 0.3e0 * colon + 0.2e0 * l END,
    n >= 2 AND (has_pattern OR (true_form AND NOT justified)), xmin, ymin, xmax, ymax FROM boosted
  UNION ALL SELECT doc_id, block_id, 2, 'figure', CASE WHEN flat THEN 0e0 ELSE 0.5e0 * empty + 0.3e0 * least(1e0, ticks / 10) + CASE WHEN right_n >= 3 THEN 0.2e0 ELSE 0e0 END END, NOT flat AND empty >= 0.3 AND (ticks >= 5 OR right_n >= 3), xmin, ymin, xmax, ymax FROM boosted
  UNION ALL SELECT doc_id, block_id, 3, 'text', CASE WHEN n < 2 THEN 0e0 ELSE least(1e0, 0.5e0 * least(1e0, avg_len / 100) + 0.5e0 * even + jb + boost) END,
    n >= 2 AND ((avg_len >= 30 AND even >= 0.6 AND text_cols <= 2) OR jb > 0 OR boost > 0), xmin, ymin, xmax, ymax FROM boosted),
top_two AS (SELECT *, row_number() OVER (PARTITION BY doc_id, block_id ORDER BY round(score, 9) DESC, type_ord) AS rank FROM scores),
page_regions AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY block_id, rank) - 1 AS INTEGER) AS region_id FROM top_two WHERE rank <= 2 AND score >= CASE region_type WHEN 'table' THEN 0.25 WHEN 'form' THEN 0.2 WHEN 'figure' THEN 0.25 ELSE 0.65 END)
"""
)

_ORDER_LINES = ORDER_TOKENS_SQL + ", l AS (SELECT doc_id, CAST((ymin - 50) / 24 AS INTEGER) AS line_id, string_agg(text, ' ' ORDER BY xmin) AS text FROM tokens GROUP BY doc_id, ymin) "

_REGIONS = "SELECT doc_id, region_id, block_id, region_type, round(score, 6) AS score FROM page_regions"
#: The regions as graph nodes, and their edges.
_GRAPH_SQL = (
    _SCORES_SQL
    + """, texts_of AS (SELECT doc_id, block_id, count(*) AS n, sum(length(text)) AS c, string_agg(text, ' ' ORDER BY pos) AS text FROM block_rows GROUP BY ALL),
nodes AS (SELECT doc_id, 1 AS page_no, region_id AS node_id, region_type, xmin, ymin, xmax, ymax, score, substr(text, 1, 200) AS text, region_type = 'text' AND n <= 3 AND c < 150 AS is_short FROM page_regions JOIN texts_of USING (doc_id, block_id))
"""
    + edges_sql(("node_pairs", "scored", "related", "kept", "edges"))
)

ORACLE = {
    "doc_medians": DOCUMENT_TOKENS_SQL + "SELECT doc_id, round(median((xmax - xmin) / length(text)), 6) AS char_width, round(median(ymax - ymin), 6) AS line_height FROM tokens GROUP BY doc_id",
    "recognition": DOCUMENT_TOKENS_SQL + "SELECT doc_id, CAST(count(*) AS INTEGER) AS num_lines, 0.9 AS avg_confidence, CAST(sum(length(text)) + count(*) - 1 AS INTEGER) AS chars FROM tokens GROUP BY doc_id",
    "lines": DOCUMENT_TOKENS_SQL + _LINES_SQL + "SELECT doc_id, line_id, text, xmin, ymin, xmax, ymax, tokens FROM numbered",
    # An order's four lines are labels with values at one left edge, eight apart: four form lines in one block.
    "order_form_lines": _ORDER_LINES + "SELECT doc_id, line_id, 0 AS block_id, text, true AS is_form, regexp_extract(text, '^([^:]+): (.+)$', 1) AS form_key, regexp_extract(text, '^([^:]+): (.+)$', 2) AS form_value FROM l",
    "blocks": DOCUMENT_TOKENS_SQL + _BLOCKS_SQL + "SELECT doc_id, line_id, block_id, pos, text, is_form FROM block_rows",
    **{f"{k}_score": DOCUMENT_TOKENS_SQL + _SCORES_SQL + f"SELECT doc_id, block_id, round(score, 6) AS score, flag FROM scores WHERE region_type = '{k}'" for k in L.KINDS},
    "regions_top2": DOCUMENT_TOKENS_SQL + _SCORES_SQL + _REGIONS,
    "order_regions": ORDER_TOKENS_SQL + _SCORES_SQL + _REGIONS,
    "page_lines": REGION_TOKENS_SQL + _LINES_SQL + "SELECT doc_id, line_id, text, xmin, ymin, xmax, ymax, tokens FROM numbered",
    "page_failures": REGION_TOKENS_SQL + "SELECT DISTINCT doc_id, 'token without a box' AS error FROM tokens WHERE xmin IS NULL OR ymin IS NULL OR xmax IS NULL OR ymax IS NULL",
    "page_blocks": REGION_TOKENS_SQL + _BLOCKS_SQL + "SELECT doc_id, line_id, block_id, pos, text, round(xmin, 6) AS xmin, round(xmax, 6) AS xmax, is_form, form_key, form_value FROM block_rows",
    "page_scores": REGION_TOKENS_SQL + _SCORES_SQL + "SELECT doc_id, block_id, region_type, round(score, 6) AS score, flag FROM scores",
    "page_regions": REGION_TOKENS_SQL + _SCORES_SQL + _REGIONS,
    "page_graphs": REGION_TOKENS_SQL + _GRAPH_SQL + "SELECT doc_id, page_no, source, target, relation, round(score, 6) AS score, category, rank FROM edges",
    "box_iou": REGION_TOKENS_SQL
    + _GRAPH_SQL
    + """, sized AS (SELECT *, (xmax - xmin) * (ymax - ymin) AS area FROM nodes),
inter AS (SELECT a.doc_id, a.page_no, a.node_id AS source, b.node_id AS target, greatest(0e0, least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * greatest(0e0, least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) AS i,
  a.area AS sa, b.area AS sb FROM sized a JOIN sized b ON a.doc_id = b.doc_id AND a.page_no = b.page_no AND a.node_id <> b.node_id)
SELECT doc_id, page_no, source, target, round(i / (sa + sb - i), 6) AS iou FROM inter WHERE sa + sb - i > 0 AND i > 0""",
    "recognition_variants": DOCUMENT_TOKENS_SQL
    + "SELECT doc_id, CAST(count(*) AS INTEGER) AS plain_num_lines, 0.9 AS plain_avg_confidence, CAST(nullif(count_if(regexp_matches(text, '[\\p{L}\\p{N}]')), 0) AS INTEGER) AS cleaned_num_lines, CASE WHEN count_if(regexp_matches(text, '[\\p{L}\\p{N}]')) > 0 THEN 0.9 END AS cleaned_avg_confidence FROM tokens GROUP BY doc_id",
    "page_results": REGION_TOKENS_SQL
    + _GRAPH_SQL
    + """, pages AS (SELECT DISTINCT doc_id FROM tokens), failed AS (SELECT DISTINCT doc_id FROM tokens WHERE xmin IS NULL OR ymin IS NULL OR xmax IS NULL OR ymax IS NULL),
n AS (SELECT doc_id, count(*) AS n FROM nodes GROUP BY doc_id), e AS (SELECT doc_id, count(*) AS e FROM edges GROUP BY doc_id)
SELECT doc_id, f.doc_id IS NULL AS success, CASE WHEN f.doc_id IS NOT NULL THEN 'token without a box' END AS error, CAST(coalesce(n, 0) AS INTEGER) AS num_regions, CAST(coalesce(n, 0) AS INTEGER) AS num_nodes, CAST(coalesce(e, 0) AS INTEGER) AS num_edges
FROM pages p LEFT JOIN failed f USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN e USING (doc_id)""",
    "full_export": REGION_TOKENS_SQL
    + _GRAPH_SQL
    + """, t AS (SELECT doc_id, count(*) AS num_tokens, string_agg(text, '|' ORDER BY token_id) AS tokens FROM usable GROUP BY doc_id), li AS (SELECT doc_id, count(*) AS num_lines, string_agg(text, '|' ORDER BY line_id) AS lines FROM form_rows GROUP BY doc_id),
bl AS (SELECT doc_id, count(*) AS num_blocks, string_agg(lines::VARCHAR, '|' ORDER BY block_id) AS blocks FROM (SELECT doc_id, block_id, count(*) AS lines FROM block_rows GROUP BY ALL) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS num_nodes, string_agg(region_type, '|' ORDER BY node_id) AS regions FROM nodes GROUP BY doc_id), e AS (SELECT doc_id, count(*) AS num_edges, string_agg(source || '>' || target, '|' ORDER BY source, rank) AS edges FROM edges GROUP BY doc_id)
SELECT doc_id, '1.0.0' AS version, CAST(num_tokens AS INTEGER) AS num_tokens, tokens, CAST(num_lines AS INTEGER) AS num_lines, lines, CAST(num_blocks AS INTEGER) AS num_blocks, blocks, CAST(coalesce(num_nodes, 0) AS INTEGER) AS num_regions, CAST(coalesce(num_nodes, 0) AS INTEGER) AS num_nodes, coalesce(regions, '') AS regions,
  CAST(coalesce(num_edges, 0) AS INTEGER) AS num_edges, coalesce(edges, '') AS edges FROM t JOIN li USING (doc_id) JOIN bl USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN e USING (doc_id)""",
    "kv_pattern": _ORDER_LINES
    + """SELECT doc_id, 0 AS block_id, count(*) AS keyvalue_lines, count(*) AS n_lines, round(avg(length(regexp_extract(text, '^([^:]+):', 1))), 6) AS avg_key_length, 1.0 AS keyvalue_ratio, true AS has_pattern FROM l GROUP BY doc_id""",
    "dbscan_columns": ORDER_TOKENS_SQL
    + """, p AS (SELECT doc_id, token_id, (xmin + xmax) / 2 AS cx FROM tokens), g AS (SELECT *, coalesce(cx - lag(cx) OVER w > 50, true) AS fresh FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY cx, token_id)),
c AS (SELECT *, sum(CAST(fresh AS BIGINT)) OVER (PARTITION BY doc_id ORDER BY cx, token_id ROWS UNBOUNDED PRECEDING) AS cluster FROM g)
SELECT doc_id, CAST(cluster AS BIGINT) AS cluster, round(avg(cx), 6) AS center, count(*) AS n FROM c GROUP BY doc_id, cluster HAVING count(*) >= 2""",
}
