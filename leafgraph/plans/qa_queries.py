"""Queries of question generation over the scanned pages, and of the question rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafgraph.functions.textnorm import WS
from leafgraph.functions.tokens import STARTERS
from leafgraph.functions import tokens as T
from leafgraph.operators import graph as G
from leafgraph.operators import qa as Q
from leafgraph.operators import stats
from leafgraph.operators.stored import questions_of_payloads
from leafgraph.plans.graph_queries import EDGES_SQL, edges, nodes, rounded
from leafgraph.plans.text_queries import _CATEGORY, _CLOCK_SQL
from leafgraph.sources.dataset import first_of_split, image_bytes, labels, random_rows, read_csv, read_images, read_json_documents, read_parquet, split_counts, split_of_file, still_to_do, with_file_rows
from leafgraph.sources.sinks import write_csv, write_documents, write_images
from leafgraph.sources.tables import fresh_path, table


def _plain(df):
    """Lists as text, so that rows compare by value."""
    return df.withColumns({"evidence_region_ids": F.array_join(F.col("evidence_region_ids").cast("array<string>"), ","), "evidence_quotes": F.array_join("evidence_quotes", "¶")})


def _whole(s, d):
    """Nodes with their whole text, line breaks and all."""
    return nodes(s, d).withColumn("text", F.col("whole")).drop("whole")


def _all(s, d):
    return Q.generate_qas(_whole(s, d), edges(s, d))


def _split(c="split"):
    s = F.lower(F.trim(c))
    return F.when(s == "val", "validation").otherwise(s)


def _qa_rows(s, d):
    return table(s, d, "qa_pairs")


def _labels(s, d):
    rows = table(s, d, "source_rows", "questionid", "question", "docid", "answers", "file_name", "loaded_at")
    return labels(with_file_rows(rows, "file_name", "loaded_at", "questionid", "docid", "question"))


def _labels_csv(s, d):
    """The labels, written as CSV by split and read again."""
    path = fresh_path(s, "labels")
    write_csv(_labels(s, d), path, by="split")
    return read_csv(s, path, "question_id long, question string, doc_id string, image_filename string, image_path string, answers string, split string")


def _graph_files(s, d):
    """Every payload as a file of its own, and the files read again."""
    path = fresh_path(s, "graphs")
    write_documents(table(s, d, "graph_json", "record_id", "payload").filter("payload IS NOT NULL"), path, "record_id", "payload")
    return read_json_documents(s, path)


def _image_files(s, d):
    """Images as files by split, and the folders listed again."""
    path = fresh_path(s, "images")
    t = table(s, d, "source_rows", "file_name", "questionid", "image")
    rows = t.select(split_of_file(F.col("file_name")).alias("split"), F.concat(F.col("questionid").cast("string"), F.lit(".png")).alias("name"), image_bytes(t).alias("content"))
    write_images(rows.filter("name IS NOT NULL"), path, "split", "name", "content")
    return read_images(s, path).groupBy("split").agg(F.count("*").alias("images"))


def _images(s, d):
    rows = table(s, d, "source_rows", "file_name", "questionid", "image")
    return rows.select(split_of_file(F.col("file_name")).alias("split"), F.col("questionid").cast("string").alias("image_id"), F.when(F.col("image").isNull(), "no image").alias("error"))


_FLAGS = ("has_fields", "has_quotes", "long_question", "short_answer", "consistent", "not_vague", "not_region_reference", "not_trivial")


def _fields(s, d):
    return Q.form_fields(table(s, d, "documents", "doc_id", "text"), "doc_id")


def _rows(s, d):
    lines = table(s, d, "graph_visualization_output", "region_id", "text").select("region_id", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    return lines.select("region_id", "line", Q.split_row(F.col("t")).alias("cells")).select("region_id", "line", F.size("cells").alias("n"), F.array_join("cells", "¶").alias("cells"))


def _prompts(s, d):
    n = _whole(s, d)
    pairs = Q.model_pairs(n, edges(s, d))
    end = lambda p: n.select("doc_id", "page_no", F.col("node_id").alias(p), F.col("region_type").alias(p + "_t"), F.col("text").alias(p + "_x"))
    both = pairs.join(end("source"), ["doc_id", "page_no", "source"]).join(end("target"), ["doc_id", "page_no", "target"])
    template = F.lit('Compare {source_type} {source_id} with {target_type} {target_id}: "{source_text}" / "{target_text}". Reply as {"answer": ""}.')
    a, b = ({"id": F.col(p), "type": F.col(p + "_t"), "text": F.col(p + "_x")} for p in ("source", "target"))
    return both.select("doc_id", "page_no", "source", "target", "template", Q.prompt(template, a, b).alias("prompt"))


QUERIES = {
    "form_fields": _fields,
    "split_rows": _rows,
    "form_qas": lambda s, d: _plain(Q.form_qas(_whole(s, d))),
    "table_qas": lambda s, d: _plain(Q.table_qas(_whole(s, d))),
    "figure_qas": lambda s, d: _plain(Q.figure_qas(_whole(s, d))),
    "titles": lambda s, d: Q.titles(_whole(s, d), edges(s, d)).select("doc_id", "page_no", "node_id", "category", "title_id", "title"),
    "title_qas": lambda s, d: _plain(Q.title_qas(_whole(s, d), edges(s, d))),
    "summary_qas": lambda s, d: _plain(Q.summary_qas(_whole(s, d))),
    "generated_qas": lambda s, d: _plain(_all(s, d)),
    "generated_csv": lambda s, d: Q.csv_rows(_all(s, d), F.lit("train")),
    "model_pairs": lambda s, d: Q.model_pairs(_whole(s, d), edges(s, d)),
    "model_prompts": _prompts,
    "qa_dedupe": lambda s, d: Q.first_questions(_qa_rows(s, d).select("doc_id", "row_no", "question"), ["doc_id"], ["row_no"], 10).select("doc_id", "row_no", "idx"),
    "qa_quality": lambda s, d: Q.quality_flags(_qa_rows(s, d)).select("row_no", *_FLAGS, "kept"),
    "answer_kinds": lambda s, d: _qa_rows(s, d).groupBy(Q.answer_kind(F.col("answer")).alias("kind")).agg(F.count("*").alias("n")),
    "answer_detectors": lambda s, d: _qa_rows(s, d).select("row_no", F.array_join(Q.detected(F.col("answer")), ",").alias("kinds"), Q.boolean_value(F.col("answer")).alias("boolean")),
    "rule_templates": lambda s, d: _qa_rows(s, d).select("row_no", F.array_join(Q.matching_templates(F.col("question")), ",").alias("templates")),
    "edge_templates": lambda s, d: G.edge_ends(nodes(s, d), edges(s, d)).groupBy(Q.template_key(T.region_category(F.col("source_type")), T.region_category(F.col("target_type"))).alias("template")).agg(F.count("*").alias("n")),
    "evidence_nodes": lambda s, d: Q.evidence_nodes(_all(s, d), nodes(s, d)),
    "qa_batch": lambda s, d: stats.question_batch(nodes(s, d), edges(s, d), _all(s, d)),
    "qa_batch_summary": lambda s, d: rounded(stats.batch_summary(stats.question_batch(nodes(s, d), edges(s, d), _all(s, d))), "average"),
    "column_counts": lambda s, d: Q.column_modes(_whole(s, d)),
    "json_replies": lambda s, d: table(s, d, "events", "event_id", "props").select("event_id", Q.json_in_text(F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```")))["k"].alias("k")),
    "reasoning_dist": lambda s, d: rounded(stats.value_shares(_qa_rows(s, d), "reasoning_type", F.coalesce(F.lower("reasoning_type"), F.lit("unknown"))), "percent"),
    "reasoning_top": lambda s, d: rounded(stats.ranked_shares(_qa_rows(s, d).groupBy(F.coalesce(F.lower("reasoning_type"), F.lit("unknown")).alias("reasoning_type")).agg(F.count("*").alias("n")), "reasoning_type"), "percent"),
    "qa_rollup": lambda s, d: stats.question_rollup(_qa_rows(s, d).select(_split().alias("split"), "doc_id", F.col("question").isNull().alias("failed")), "split", "doc_id", "failed"),
    "batch_rollup": lambda s, d: stats.batch_rollup(_images(s, d), "split", "error"),
    "batch_errors": lambda s, d: stats.batch_errors(_images(s, d), "split", "image_id", "error"),
    "dataset_stats": lambda s, d: rounded(stats.dataset_stats(nodes(s, d).select("doc_id", "page_no").distinct(), nodes(s, d), edges(s, d), nodes(s, d).select(T.word_count(F.col("whole")).alias("tokens"))), "v"),
    "run_statistics": lambda s, d: rounded(stats.run_statistics(_images(s, d), _qa_rows(s, d).select(_split().alias("split"), "doc_id", F.col("question").isNull().alias("failed"), F.lower("reasoning_type").alias("reasoning_type"))), "value"),
    "labels_csv": _labels_csv,
    "stored_qas": lambda s, d: _plain(questions_of_payloads(table(s, d, "graph_json", "record_id", "payload"))),
    "random_labels": lambda s, d: random_rows(table(s, d, "source_rows", "questionid", "docid"), 20, 7),
    "labels_export": _labels,
    "split_counts": lambda s, d: split_counts(table(s, d, "source_rows", "file_name"), split_of_file(F.col("file_name"))),
    "image_sizes": lambda s, d: (lambda t: t.select(split_of_file(F.col("file_name")).alias("split"), F.length(image_bytes(t)).alias("b")).groupBy("split").agg(F.count("b").alias("images"), F.sum("b").alias("bytes")))(table(s, d, "source_rows", "file_name", "image")),
    "first_files": lambda s, d: first_of_split(table(s, d, "graph_json", "record_id", "split", "file_name"), "split", "record_id", 5),
    "skip_existing": lambda s, d: still_to_do(table(s, d, "source_rows", "docid").select(F.concat("docid", F.lit(".png")).alias("image_file")).filter("image_file IS NOT NULL").distinct(), table(s, d, "qa_pairs", "image_file", "answer", "split").filter((_split() == "test") & F.col("answer").isNotNull()), "image_file"),
    "parquet_scan": lambda s, d: read_parquet(s, f"{d}/qa_pairs.parquet", "row_no", "qa_id"),
    "graph_files": _graph_files,
    "image_files": _image_files,
}

_COLLAPSED = f"trim(regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g'))"
_STRIP = lambda x: f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"
_QA_COLS = "question, answer, evidence_region_ids, evidence_quotes, reasoning_type"
_SPLIT_SQL = "CASE WHEN lower(trim(split)) = 'val' THEN 'validation' ELSE lower(trim(split)) END"
_FILE_SPLIT = "CASE WHEN contains(lower(file_name), 'train') THEN 'train' WHEN contains(lower(file_name), 'test') THEN 'test' WHEN contains(lower(file_name), 'val') THEN 'validation' ELSE 'others' END"


def _cells(r: str) -> str:
    """SQL for the cells of a stripped row without bars at its ends."""
    parts = lambda pattern: f"list_filter(list_transform(regexp_split_to_array({r}, '{pattern}'), lambda c: {_STRIP('c')}), lambda c: c <> '')"
    bare = f"trim(regexp_replace({r}, '{WS}+', ' ', 'g'))"
    ws = f"string_split({bare}, ' ')"
    return rf"""(CASE WHEN contains({r}, '|') THEN {parts(r"\|")} WHEN contains({r}, chr(9)) THEN {parts(r"\t")}
      WHEN contains({r}, '  ') AND len({parts(WS + "{2,}")}) >= 2 THEN {parts(WS + "{2,}")} WHEN {r} = '' THEN CAST([] AS VARCHAR[])
      WHEN len({ws}) >= 3 AND regexp_matches({ws}[-1], '\d') THEN [array_to_string({ws}[1:-2], ' '), {ws}[-1]] ELSE [{r}] END)"""


_ROW = rf"regexp_replace({_STRIP('t')}, '^\|+|\|+$', '', 'g')"
_PARSED = lambda text: f"list_filter(list_transform(list_filter(string_split({text}, chr(10)), lambda t: {_STRIP('t')} <> ''), lambda t: {_cells('(' + _ROW + ')')}), lambda r: len(r) >= 2)"
_LABEL = f"""length(key) BETWEEN 1 AND 30 AND length(key) - length(replace(key, ' ', '')) <= 4 AND NOT contains(key, '  ')
  AND lower(string_split(trim(regexp_replace(key, '{WS}+', ' ', 'g')), ' ')[1]) NOT IN ({", ".join(f"'{w}'" for w in STARTERS)}) AND NOT regexp_matches(key, '{_CLOCK_SQL}')"""
_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _fields_sql(source: str) -> str:
    """SQL tables that end in form_fields (lid, id, line, field, key, value), the fields of the texts of ``source`` (id, text)."""
    return rf"""form_lines AS (SELECT id, CAST(i - 1 AS INTEGER) AS line, {_STRIP("parts[i]")} AS t FROM (SELECT id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT id, regexp_split_to_array(text, '{_BREAKS}') AS parts FROM {source}))),
labelled AS (SELECT *, row_number() OVER () AS lid, list_filter(range(1, length(t) + 1), lambda i: t[i] = ':') AS spots FROM form_lines WHERE contains(t, ':') AND NOT regexp_matches(t, '{_CLOCK_SQL}')),
walk AS (
  SELECT lid, t, spots, 1 AS k, 0 AS past, 0 AS n, CAST(NULL AS VARCHAR) AS key, 0 AS start, 0 AS colon FROM labelled WHERE len(spots) > 1
  UNION ALL
  SELECT lid, t, spots, k + 1, CASE WHEN ok THEN spots[k] ELSE past END, CASE WHEN ok THEN n + 1 ELSE n END, CASE WHEN ok THEN key END, past + skip, spots[k] FROM (
    SELECT *, {_LABEL} AS ok FROM (
      SELECT lid, t, spots, k, past, n, skip, {_STRIP("substr(seg, skip + 1)")} AS key FROM (
        SELECT *, CASE WHEN past > 0 THEN length(regexp_extract(seg, '^(.*[\p{{Ll}}\p{{Nd}}.,;] +)\p{{Lu}}', 1)) ELSE 0 END AS skip
        FROM (SELECT lid, t, spots, k, past, n, substr(t, CAST(past + 1 AS INTEGER), CAST(spots[k] - past - 1 AS INTEGER)) AS seg FROM walk WHERE k <= len(spots)))))),
labels AS (SELECT lid, t, n, key, colon, coalesce(lead(start) OVER (PARTITION BY lid ORDER BY n), length(t)) AS stop FROM walk WHERE key IS NOT NULL),
several AS (SELECT lid, n, key, {_STRIP("substr(t, CAST(colon + 1 AS INTEGER), CAST(stop - colon AS INTEGER))")} AS value FROM labels),
single AS (SELECT * FROM (SELECT lid, 1 AS n, {_STRIP("substr(t, 1, CAST(spots[1] - 1 AS INTEGER))")} AS key, {_STRIP("substr(t, CAST(spots[1] + 1 AS INTEGER))")} AS value FROM labelled WHERE len(spots) = 1) WHERE {_LABEL} AND value <> ''),
form_fields AS (
  SELECT l.id, l.line, CAST(row_number() OVER (PARTITION BY l.lid ORDER BY f.n) - 1 AS INTEGER) AS field, f.key, f.value
  FROM (SELECT * FROM single UNION ALL SELECT * FROM several WHERE value <> '' AND NOT regexp_matches(value, '{_CLOCK_SQL}')) f JOIN labelled l USING (lid))
"""


_TYPED = (
    "\nWITH RECURSIVE" + EDGES_SQL.strip().removeprefix("WITH")
    + f""", typed AS (SELECT * EXCLUDE (text, whole), whole AS text, (SELECT {_CATEGORY} FROM (SELECT lower(coalesce(region_type, '')) AS t)) AS category, {_COLLAPSED.replace("text", "whole")} AS flat FROM nodes),
counted AS (SELECT *, CASE WHEN flat = '' THEN 0 ELSE len(string_split(flat, ' ')) END AS words FROM typed),
near AS (SELECT doc_id, page_no, node_id AS title_id, flat AS title, ymin AS t1, ymax AS t2 FROM counted WHERE category = 'text' AND words BETWEEN 2 AND 25),
cand AS (SELECT c.doc_id, c.page_no, c.node_id, c.category, c.text, c.flat, n.title_id, n.title, e.rank, t2 < c.ymin AS up, CASE WHEN t2 < c.ymin THEN c.ymin - t2 ELSE t1 - c.ymax END AS dist,
  contains(lower(title), 'table') OR contains(lower(title), 'figure') OR contains(lower(title), 'fig.') OR contains(lower(title), 'tab.') OR contains(lower(title), 'chart')
  OR (t2 < c.ymin AND contains(lower(title), 'exhibit')) OR (NOT t2 < c.ymin AND (contains(lower(title), 'source') OR contains(lower(title), 'note'))) AS word
  FROM typed c JOIN edges e ON c.doc_id = e.doc_id AND c.page_no = e.page_no AND c.node_id = e.source JOIN near n ON n.doc_id = e.doc_id AND n.page_no = e.page_no AND n.title_id = e.target
  WHERE c.category IN ('table', 'figure') AND (t2 < c.ymin OR t1 > c.ymax)),
best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, node_id ORDER BY word DESC, dist, up DESC, rank) = 1)
"""
)
_WORD_PAIRS = """, me AS (SELECT doc_id, page_no, node_id, category FROM counted WHERE category IN ('table', 'figure')),
fitting AS (SELECT m.*, e.target AS other FROM me m JOIN edges e ON m.doc_id = e.doc_id AND m.page_no = e.page_no AND m.node_id = e.source JOIN counted o ON o.doc_id = e.doc_id AND o.page_no = e.page_no AND o.node_id = e.target
  WHERE o.category = 'text' AND ((m.category = 'table' AND o.words >= 20) OR (m.category = 'figure' AND o.words BETWEEN 5 AND 50)) QUALIFY row_number() OVER (PARTITION BY m.doc_id, m.page_no, m.node_id ORDER BY e.rank) = 1),
pairs_of AS (SELECT doc_id, page_no, CASE WHEN category = 'table' THEN other ELSE node_id END AS source, CASE WHEN category = 'table' THEN node_id ELSE other END AS target,
  CASE WHEN category = 'table' THEN 'text_table_validation' ELSE 'figure_caption_mapping' END AS template FROM fitting)
"""
#: Every question of every generator, with lists as lists.
_QUESTIONS = (
    _TYPED
    + ", forms AS (SELECT {d: doc_id, p: page_no, n: node_id} AS id, text FROM typed WHERE category = 'form'), "
    + _fields_sql("forms")
    + f""", q_form AS (SELECT id.d AS doc_id, id.p AS page_no, id.n AS node_id, CAST(row_number() OVER (PARTITION BY id ORDER BY line, field) - 1 AS INTEGER) AS place, 'What is the ' || key || '?' AS question, value AS answer, [id.n] AS regions, [key || ': ' || value] AS quotes,
  'lookup' AS reasoning_type, 'Extracted value for ''' || key || ''' from form field.' AS reasoning_explanation FROM form_fields QUALIFY place < 5),
parsed AS (SELECT doc_id, page_no, node_id, {_PARSED("text")} AS rows FROM typed WHERE category = 'table'),
full_tables AS (SELECT * FROM parsed WHERE len(rows) > 0),
cellq AS (SELECT doc_id, page_no, node_id, rows, rows[k] AS r, row_number() OVER (PARTITION BY doc_id, page_no, node_id ORDER BY k) AS n
  FROM (SELECT *, unnest(range(2, least(len(rows), 4) + 1)) AS k FROM full_tables) WHERE rows[k][2] <> ''),
q_table AS (SELECT doc_id, page_no, node_id, 0 AS place, 'What are the column headers in the table?' AS question, array_to_string(rows[1], ', ') AS answer, [node_id] AS regions, [array_to_string(rows[1], ' | ')] AS quotes, 'lookup' AS reasoning_type,
  'The header row contains the table''s column names.' AS reasoning_explanation FROM full_tables
UNION ALL SELECT doc_id, page_no, node_id, 1, 'How many data rows are in the table (excluding the header)?', CAST(len(rows) - 1 AS VARCHAR), [node_id], ['Data rows detected: ' || (len(rows) - 1)], 'lookup', 'Counted the number of non-header rows parsed from the table.' FROM full_tables
UNION ALL SELECT doc_id, page_no, node_id, CAST(n + 1 AS INTEGER), 'What is the ' || rows[1][2] || ' for ' || r[1] || '?', r[2], [node_id], [array_to_string(r, ' | ')], 'lookup', 'Looked up the cell at the intersection of the selected row and column.' FROM cellq WHERE n <= 3),
q_figure AS (SELECT doc_id, page_no, node_id, 0 AS place, 'What does the figure show?' AS question, flat AS answer, [node_id] AS regions, [substr(text, 1, 300)] AS quotes, 'lookup' AS reasoning_type,
  'Answered using the figure''s extracted description text.' AS reasoning_explanation FROM typed WHERE category = 'figure' AND flat <> ''),
titled AS (SELECT *, {_PARSED("text")} AS rows FROM best),
q_title AS (SELECT doc_id, page_no, node_id, 0 AS place, CASE WHEN category = 'table' THEN 'What information does ''' || title || ''' present?' ELSE 'What does ''' || title || ''' illustrate?' END AS question,
  CASE WHEN category = 'table' AND len(rows) > 0 THEN 'The table shows data with columns: ' || array_to_string(rows[1], ', ') || '.' || CASE WHEN len(rows) > 1 THEN ' It contains ' || (len(rows) - 1) || ' data rows.' ELSE '' END
       WHEN category = 'table' THEN substr(flat, 1, 200) WHEN flat <> '' THEN flat ELSE 'The figure illustrates the referenced data.' END AS answer,
  [title_id, node_id] AS regions, [title, substr(flat, 1, 300)] AS quotes, 'coreference' AS reasoning_type, 'Connected the title/caption with its ' || category || ' content.' AS reasoning_explanation FROM titled),
q_summary AS (SELECT doc_id, page_no, node_id, CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY length(text) DESC, node_id) - 1 AS INTEGER) AS place, 'What is the main topic or content discussed in this section?' AS question,
  array_to_string(string_split(flat, ' ')[1:30], ' ') || CASE WHEN words > 30 THEN '...' ELSE '' END AS answer, [node_id] AS regions, [substr(flat, 1, 300)] AS quotes, 'comprehension' AS reasoning_type,
  'Summarized the main content from the text region.' AS reasoning_explanation FROM counted WHERE category = 'text' AND words >= 30 QUALIFY place < 3),
texts AS (SELECT *, 1 AS part, node_id AS major, place AS minor FROM q_title UNION ALL SELECT *, 2, place, 0 FROM q_summary),
everything AS (
  SELECT *, 0 AS part, node_id AS major, place AS minor FROM (SELECT * FROM q_form UNION ALL SELECT * FROM q_table UNION ALL SELECT * FROM q_figure)
  UNION ALL SELECT * FROM (SELECT * FROM texts QUALIFY row_number() OVER (PARTITION BY doc_id, page_no ORDER BY part, major, minor) <= 5)),
firsts AS (SELECT *, {_COLLAPSED.replace("text", "question")} AS q FROM everything),
generated AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id, page_no ORDER BY part, major, minor) - 1 AS INTEGER) AS idx FROM (
  SELECT * FROM firsts WHERE q <> '' QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, q ORDER BY part, major, minor) = 1) QUALIFY idx < 10)
"""
)
_LISTS = "array_to_string(regions, ',') AS evidence_region_ids, array_to_string(quotes, '¶') AS evidence_quotes"
_OF = lambda name: _QUESTIONS + f"SELECT doc_id, page_no, node_id, place, question, answer, {_LISTS}, reasoning_type, reasoning_explanation FROM {name}"
_REJECTS = {f"not_{k}": "NOT (" + " OR ".join(f"contains(lower(coalesce(question, '')), '{p}')" for p in v) + ")" for k, v in Q.REJECTED.items()}
_TERMS = lambda x: rf"list_distinct(list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> ''))"
_HITS = lambda table, c: "concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches({c}, '{p.replace(chr(39), chr(39) * 2)}') THEN '{k}' END" for k, p in table.items()) + ")"

ORACLE = {
    "split_rows": f"""
WITH l AS (SELECT region_id, CAST(i - 1 AS INTEGER) AS line, parts[i] AS t FROM (SELECT region_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM graph_visualization_output WHERE text IS NOT NULL)),
r AS (SELECT region_id, line, {_ROW} AS r FROM l), c AS (SELECT region_id, line, {_cells("r")} AS cells FROM r)
SELECT region_id, line, CAST(len(cells) AS INTEGER) AS n, array_to_string(cells, '¶') AS cells FROM c""",
    "form_fields": "WITH RECURSIVE texts AS (SELECT doc_id AS id, text FROM documents WHERE text IS NOT NULL), " + _fields_sql("texts") + "SELECT id AS doc_id, line, field, key, value FROM form_fields",
    "form_qas": _OF("q_form"),
    "table_qas": _OF("q_table"),
    "figure_qas": _OF("q_figure"),
    "titles": _TYPED + "SELECT doc_id, page_no, node_id, category, title_id, title FROM best",
    "title_qas": _OF("q_title"),
    "summary_qas": _OF("q_summary"),
    "generated_qas": _QUESTIONS + f"SELECT doc_id, page_no, node_id, idx, question, answer, {_LISTS}, reasoning_type, reasoning_explanation FROM generated",
    "generated_csv": _QUESTIONS
    + """SELECT 'train' AS split, doc_id || '_' || page_no AS doc_id, doc_id || '_' || page_no || '.png' AS image_file, doc_id || '_' || page_no || '_' || idx AS qa_id, question, answer, reasoning_type, reasoning_explanation,
  CAST(to_json(regions) AS VARCHAR) AS evidence_region_ids, CAST(to_json(quotes) AS VARCHAR) AS evidence_quotes FROM generated""",
    "evidence_nodes": _QUESTIONS
    + """, named AS (SELECT doc_id, page_no, idx, regions, unnest(range(len(regions))) AS place FROM generated)
SELECT g.doc_id, g.page_no, g.idx, CAST(g.place AS INTEGER) AS place, n.node_id, n.region_type, n.xmin, n.ymin, n.xmax, n.ymax FROM named g JOIN nodes n ON n.doc_id = g.doc_id AND n.page_no = g.page_no AND n.node_id = g.regions[g.place + 1]""",
    "qa_batch": _QUESTIONS
    + """, batch AS (SELECT n.doc_id, n.page_no, n.nodes, coalesce(e.edges, 0) AS edges, coalesce(q.qas_generated, 0) AS qas_generated FROM (SELECT doc_id, page_no, count(*) AS nodes FROM nodes GROUP BY ALL) n
LEFT JOIN (SELECT doc_id, page_no, count(*) AS edges FROM edges GROUP BY ALL) e USING (doc_id, page_no) LEFT JOIN (SELECT doc_id, page_no, count(*) AS qas_generated FROM generated GROUP BY ALL) q USING (doc_id, page_no))
SELECT * FROM batch""",
    "qa_batch_summary": _QUESTIONS
    + "SELECT count(*) AS documents, sum(q) AS questions, round(avg(q), 6) AS average FROM (SELECT coalesce(q, 0) AS q FROM (SELECT DISTINCT doc_id, page_no FROM nodes) LEFT JOIN (SELECT doc_id, page_no, count(*) AS q FROM generated GROUP BY ALL) USING (doc_id, page_no))",
    "column_counts": _TYPED
    + f""", table_rows AS (SELECT doc_id, page_no, node_id, list_transform(list_filter(regexp_split_to_array(text, '{_BREAKS}'), lambda t: {_STRIP("t")} <> ''), lambda t: len({_cells("(" + _ROW + ")")})) AS ns FROM typed WHERE category = 'table'),
sizes AS (SELECT doc_id, page_no, node_id, ns[i] AS n, i FROM (SELECT *, unnest(range(1, len(ns) + 1)) AS i FROM table_rows) WHERE ns[i] > 0),
by_size AS (SELECT doc_id, page_no, node_id, n, count(*) AS rows, min(i) AS place FROM sizes GROUP BY ALL)
SELECT doc_id, page_no, node_id, CAST(first(n ORDER BY rows DESC, place) AS INTEGER) AS columns, CAST(coalesce(sum(rows) FILTER (n >= 2), 0) AS BIGINT) AS table_rows FROM by_size GROUP BY ALL""",
    "model_pairs": _TYPED + _WORD_PAIRS + "SELECT * FROM pairs_of",
    "model_prompts": _TYPED
    + _WORD_PAIRS
    + """SELECT p.doc_id, p.page_no, p.source, p.target, p.template, 'Compare ' || coalesce(a.region_type, 'TextBlock') || ' ' || p.source || ' with ' || coalesce(b.region_type, 'TextBlock') || ' ' || p.target || ': "' || a.text || '" / "' || b.text || '". Reply as {"answer": ""}.' AS prompt
FROM pairs_of p JOIN typed a ON a.doc_id = p.doc_id AND a.page_no = p.page_no AND a.node_id = p.source JOIN typed b ON b.doc_id = p.doc_id AND b.page_no = p.page_no AND b.node_id = p.target""",
    "edge_templates": _TYPED
    + """, both_ends AS (SELECT a.category AS a, b.category AS b FROM edges e JOIN typed a ON a.doc_id = e.doc_id AND a.page_no = e.page_no AND a.node_id = e.source JOIN typed b ON b.doc_id = e.doc_id AND b.page_no = e.page_no AND b.node_id = e.target)
SELECT CASE WHEN least(a, b) = 'table' AND greatest(a, b) = 'text' THEN 'text_table_validation' WHEN least(a, b) = 'figure' AND greatest(a, b) = 'text' THEN 'figure_caption_mapping' WHEN a = 'text' AND b = 'text' THEN 'text_text_coreference'
  WHEN a = 'table' AND b = 'table' THEN 'table_table_crosscheck' WHEN least(a, b) = 'form' AND greatest(a, b) = 'text' THEN 'form_conclusion' END AS template, count(*) AS n FROM both_ends GROUP BY 1""",
    "qa_quality": f"""WITH f AS (SELECT row_no, {_STRIP("coalesce(question, '')")} <> '' AND {_STRIP("coalesce(answer, '')")} <> '' AND evidence_region_ids IS NOT NULL AND evidence_quotes IS NOT NULL AND reasoning_type IS NOT NULL AS has_fields,
  coalesce(len(from_json(_j, '["VARCHAR"]')) > 0, false) AS has_quotes, {_COLLAPSED.replace("text", "question")} <> '' AND len(string_split({_COLLAPSED.replace("text", "question")}, ' ')) >= 5 AS long_question, length(coalesce(answer, '')) <= 500 AS short_answer,
  CASE WHEN len({_TERMS("coalesce(answer, '')")}) = 0 THEN true ELSE len(list_intersect({_TERMS("coalesce(answer, '')")}, {_TERMS("coalesce(array_to_string(from_json(_j, '[\"VARCHAR\"]'), ' '), '')")})) / len({_TERMS("coalesce(answer, '')")}) >= 0.3 END AS consistent,
  {", ".join(f"{v} AS {k}" for k, v in _REJECTS.items())} FROM (SELECT *, CASE WHEN json_valid(evidence_quotes) THEN CAST(evidence_quotes AS JSON) END AS _j FROM qa_pairs))
SELECT *, {" AND ".join(_FLAGS)} AS kept FROM f""",
    "answer_detectors": f"""SELECT row_no, {_HITS(Q.DETECTORS, "coalesce(answer, '')")} AS kinds, CASE WHEN v IN ('✓', '☑', 'checked', 'yes', 'true') THEN 'yes' WHEN v IN ('✗', '☐', 'unchecked', 'no', 'false') THEN 'no' END AS boolean
FROM (SELECT *, lower({_STRIP("coalesce(answer, '')")}) AS v FROM qa_pairs)""",
    "answer_kinds": f"""SELECT CASE WHEN contains(k, 'date') THEN 'date' WHEN contains(k, 'amount') THEN 'amount' WHEN k <> '' THEN 'address' WHEN v IN ('✓', '☑', 'checked', 'yes', 'true', '✗', '☐', 'unchecked', 'no', 'false') THEN 'boolean' ELSE 'text' END AS kind, count(*) AS n
FROM (SELECT {_HITS(Q.DETECTORS, "coalesce(answer, '')")} AS k, lower({_STRIP("coalesce(answer, '')")}) AS v FROM qa_pairs) GROUP BY 1""",
    "rule_templates": f"""SELECT row_no, {_HITS({k: "(?i)" + p for k, p in Q.TEMPLATES.items()}, "coalesce(question, '')")} AS templates FROM qa_pairs""",
    "qa_dedupe": f"""
WITH q AS (SELECT doc_id, row_no, trim(regexp_replace(coalesce(question, ''), '{WS}+', ' ', 'g')) AS q FROM qa_pairs),
f AS (SELECT doc_id, min(row_no) AS row_no FROM q WHERE q <> '' GROUP BY doc_id, q)
SELECT doc_id, row_no, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY row_no) - 1 AS INTEGER) AS idx FROM f QUALIFY idx < 10""",
    "json_replies": "SELECT event_id, props ->> 'k' AS k FROM (SELECT event_id, props::JSON AS props FROM events)",
    "reasoning_dist": "SELECT coalesce(lower(reasoning_type), 'unknown') AS reasoning_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM qa_pairs GROUP BY 1",
    "reasoning_top": "SELECT coalesce(lower(reasoning_type), 'unknown') AS reasoning_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM qa_pairs GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10",
    "qa_rollup": f"""WITH q AS (SELECT {_SPLIT_SQL} AS split, doc_id, question IS NULL AS failed FROM qa_pairs)
SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE coalesce(split, 'unknown') END AS split, count(DISTINCT doc_id) AS documents, count_if(NOT failed) AS questions, count_if(failed) AS errors, round(count_if(NOT failed) / count(DISTINCT doc_id), 2) AS average FROM q GROUP BY ROLLUP (split)""",
    "batch_rollup": f"""WITH r AS (SELECT {_FILE_SPLIT} AS split, image IS NOT NULL AS ok FROM source_rows)
SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE coalesce(split, 'unknown') END AS split, count(*) AS processed, count_if(ok) AS success, count_if(NOT ok) AS failed FROM r GROUP BY ROLLUP (split)""",
    "batch_errors": f"SELECT coalesce({_FILE_SPLIT}, 'unknown') AS split, CAST(questionid AS VARCHAR) AS image_id, 'no image' AS error FROM source_rows WHERE image IS NULL",
    "dataset_stats": EDGES_SQL
    + f""", t AS (SELECT (SELECT count(DISTINCT (doc_id, page_no)) FROM nodes) AS documents, (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges,
  (SELECT sum(CASE WHEN w = '' THEN 0 ELSE len(string_split(w, ' ')) END) FROM (SELECT {_COLLAPSED.replace("text", "whole")} AS w FROM nodes)) AS tokens)
SELECT what, '' AS name, round(CAST(v AS DOUBLE), 6) AS v FROM (SELECT unnest([{{'what': 'documents', 'v': CAST(documents AS DOUBLE)}}, {{'what': 'nodes', 'v': nodes}}, {{'what': 'edges', 'v': edges}}, {{'what': 'tokens', 'v': tokens}},
  {{'what': 'average_nodes', 'v': nodes / documents}}, {{'what': 'average_edges', 'v': edges / documents}}, {{'what': 'average_tokens', 'v': tokens / documents}}], recursive := true) FROM t)
UNION ALL SELECT 'region_type', coalesce(region_type, 'unknown'), count(*) FROM nodes GROUP BY ALL
UNION ALL SELECT 'relation', relation, count(*) FROM edges GROUP BY ALL UNION ALL SELECT 'category', category, count(*) FROM edges GROUP BY ALL""",
    "run_statistics": f"""WITH i AS (SELECT {_FILE_SPLIT} AS split, image IS NOT NULL AS ok FROM source_rows), q AS (SELECT {_SPLIT_SQL} AS split, doc_id, question IS NULL AS failed FROM qa_pairs),
g AS (SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE coalesce(split, 'unknown') END AS split, count(*) AS processed, count_if(ok) AS success, count_if(NOT ok) AS failed FROM i GROUP BY ROLLUP (split)),
k AS (SELECT CASE WHEN grouping(split) = 1 THEN 'all' ELSE coalesce(split, 'unknown') END AS split, count(DISTINCT doc_id) AS documents, count_if(NOT failed) AS questions, count_if(failed) AS errors, round(count_if(NOT failed) / count(DISTINCT doc_id), 2) AS average FROM q GROUP BY ROLLUP (split))
SELECT 'graph_processing' AS section, split, name, CAST(value AS DOUBLE) AS value FROM (UNPIVOT g ON processed, success, failed INTO NAME name VALUE value)
UNION ALL SELECT 'qa_generation', split, name, value FROM (UNPIVOT (SELECT split, CAST(documents AS DOUBLE) AS documents, CAST(questions AS DOUBLE) AS questions, CAST(errors AS DOUBLE) AS errors, average FROM k) ON documents, questions, errors, average INTO NAME name VALUE value)
UNION ALL SELECT 'reasoning_type', 'all', lower(reasoning_type), count(*) FROM qa_pairs WHERE reasoning_type IS NOT NULL GROUP BY 3""",
    "split_counts": f"SELECT s.split, count(r.split) AS n FROM (VALUES ('train'), ('test'), ('validation')) s(split) LEFT JOIN (SELECT {_FILE_SPLIT} AS split FROM source_rows) r USING (split) GROUP BY s.split",
    "labels_export": f"""
WITH r AS (SELECT *, {_FILE_SPLIT} AS split, row_number() OVER (PARTITION BY file_name ORDER BY loaded_at NULLS FIRST, questionid NULLS FIRST, docid NULLS FIRST, question NULLS FIRST) - 1 AS row FROM source_rows),
n AS (SELECT *, coalesce(CAST(questionid AS VARCHAR) || '.png', docid || '_' || row || '.png', split || '_' || row || '.png') AS name FROM r)
SELECT questionid AS question_id, question, docid AS doc_id, split, name AS image_filename, split || '/' || name AS image_path, CAST(to_json(answers) AS VARCHAR) AS answers FROM n""",
    "image_sizes": f"SELECT {_FILE_SPLIT} AS split, count(image.bytes) AS images, sum(octet_length(image.bytes)) AS bytes FROM source_rows GROUP BY 1",
    "first_files": "SELECT record_id, split, file_name FROM graph_json QUALIFY row_number() OVER (PARTITION BY split ORDER BY record_id) <= 5",
    "skip_existing": "SELECT DISTINCT docid || '.png' AS image_file FROM source_rows WHERE docid IS NOT NULL AND docid || '.png' NOT IN (SELECT image_file FROM qa_pairs WHERE image_file IS NOT NULL AND answer IS NOT NULL AND lower(trim(split)) = 'test')",
    "parquet_scan": "SELECT row_no, qa_id, 'qa_pairs.parquet' AS file FROM qa_pairs",
    "graph_files": "SELECT record_id || '.json' AS file_name, payload FROM graph_json WHERE payload IS NOT NULL",
    "image_files": f"SELECT split, count(DISTINCT name) AS images FROM (SELECT {_FILE_SPLIT} AS split, questionid || '.png' AS name FROM source_rows WHERE questionid IS NOT NULL AND image.bytes IS NOT NULL) GROUP BY split",
}
# What was written as CSV and read again are the labels, but that empty texts and nulls are one.
ORACLE["labels_csv"] = f"""SELECT question_id, nullif(question, '') AS question, nullif(doc_id, '') AS doc_id, split, image_filename, image_path, answers FROM ({ORACLE["labels_export"]})"""
