"""Queries of normalisation, matching and token kinds, over the question rows and the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafgraph.config import NormConfig
from leafgraph.functions import textnorm as N
from leafgraph.functions import tokens as T
from leafgraph.operators import stats
from leafgraph.plugins import target_size
from leafgraph.plans.render import ORDER_TOKENS_SQL, order_tokens
from leafgraph.sources.tables import table


def _qa(s, d, *columns):
    return table(s, d, "qa_pairs", "row_no", *columns)


def _mapped(column, **out):
    return lambda s, d: _qa(s, d, column).select("row_no", *(f(F.col(column)).alias(k) for k, f in out.items()))


def _spans(s, d):
    q = _qa(s, d, "answer", "evidence_quotes").filter("answer IS NOT NULL AND evidence_quotes IS NOT NULL")
    q = q.select("row_no", N.normalize(F.col("answer")).alias("a"), N.normalize(F.col("evidence_quotes")).alias("c"))
    return q.select("row_no", N.answer_span(F.col("a"), F.col("c")).alias("x")).select("row_no", "x.start", "x.stop", F.round("x.similarity", 6).alias("similarity"))


def _order_types(s, d):
    return T.classify_tokens(order_tokens(s, d), ["doc_id"]).select("doc_id", "token_id", "text", "token_type")


def _clock_texts(s, d):
    """Times of events written in several ways, among texts that are none."""
    ways = ("HH:mm", "h:mm a", "HH:mm:ss", "yyyy-MM-dd HH:mm", "HHmm")
    e = table(s, d, "events", "event_id", "ts")
    text = F.lit(None).cast("string")
    for k, way in enumerate(ways):
        text = F.when(F.col("event_id") % len(ways) == k, F.date_format("ts", way)).otherwise(text)
    return e.select("event_id", text.alias("text"))


def _sizes(s, d):
    w, h = (F.col("p_partkey") * 37) % 6000 + 1, F.col("p_size") * 113
    new_w, new_h = target_size(w, h)
    return table(s, d, "part", "p_partkey", "p_size").select("p_partkey", new_w.cast("long").alias("width"), new_h.cast("long").alias("height"))


QUERIES = {
    "ws_norm": _mapped("question", text=N.collapse),
    "ocr_fix": _mapped("answer", text=N.fix_ocr),
    "unicode_nfc": _mapped("answer", text=N.nfc),
    "accents_removed": _mapped("answer", text=N.remove_accents),
    "numbers_normalized": _mapped("answer", text=N.normalize_numbers),
    "punctuation_removed": _mapped("answer", text=N.remove_punctuation),
    "normalized_default": _mapped("question", text=N.normalize),
    "normalized_for_matching": _mapped("answer", text=N.for_matching),
    "normalized_for_display": _mapped("question", text=N.for_display),
    "jaccard_pairs": lambda s, d: _qa(s, d, "question", "answer").select("row_no", N.normalize(F.col("question")).alias("q"), N.normalize(F.col("answer")).alias("a")).select("row_no", F.round(N.jaccard(F.col("q"), F.col("a")), 6).alias("similarity")),
    "similarity_matching": lambda s, d: _qa(s, d, "question", "answer").select("row_no", F.round(N.similarity(F.col("question"), F.col("answer")), 6).alias("similarity")),
    "answer_span": _spans,
    "token_types": _mapped("answer", token_type=T.token_type),
    "token_type_hist": lambda s, d: stats.token_histogram(_qa(s, d, "answer"), F.col("answer")),
    "time_values": lambda s, d: _clock_texts(s, d).filter(T.is_time_value(F.col("text"))),
    "order_tokens_normalized": lambda s, d: N.normalized_rows(order_tokens(s, d).select("doc_id", "token_id", "text")),
    "sentence_counts": lambda s, d: table(s, d, "documents", "doc_id", "text").select("doc_id", F.size(N.sentences(F.col("text"))).alias("pieces")),
    "target_sizes": lambda s, d: _sizes(s, d),
    "form_value_override": _order_types,
    "form_lines": lambda s, d: table(s, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "t")).select("doc_id", "line", T.form_line(F.col("t")).alias("f")).filter("f IS NOT NULL").select("doc_id", "line", "f.key", "f.value"),
    "region_categories": lambda s, d: table(s, d, "graph_visualization_output", "region_id", "region_type").select("region_id", T.region_category(F.col("region_type")).alias("category")),
    "long_texts": lambda s, d: table(s, d, "graph_visualization_output", "region_id", "text").filter(T.is_long_text(F.col("text"), 40)).select("region_id", T.word_count(F.col("text")).alias("words")),
}

_WS = N.WS.replace("\\", "\\")


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"


def _ocr(x: str) -> str:
    t = f"translate({x}, '{N.OCR_FROM}', '{N.OCR_TO}')"
    t = rf"regexp_replace({t}, '(\d)I(\d)', '\11\2', 'g')"
    t = rf"regexp_replace({t}, '^I(\d)', '1\1')"
    return rf"regexp_replace({t}, '(\d)I$', '\11')"


def _norm(x: str, lower: bool = True) -> str:
    t = _ocr(f"nfc_normalize(coalesce({x}, ''))")
    return _collapse(f"lower({t})" if lower else t)


def _words(x: str) -> str:
    return f"(CASE WHEN {x} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({x}, ' ') END)"


def _jaccard(a: str, b: str) -> str:
    return f"""(CASE WHEN {a} = {b} THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0
      ELSE len(list_intersect({_words(a)}, {_words(b)})) * 1.0 / len(list_distinct(list_concat({_words(a)}, {_words(b)}))) END)"""


_LETTER = r"[\p{L}\p{M}\p{Nd}\p{Nl}_]"


def _bare(x: str) -> str:
    """Without punctuation; apostrophes and hyphens stay between letters, which is marked first as RE2 can't look around."""
    t = rf"regexp_replace({x}, '[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Nl}}_\s\p{{Z}}''\-]', ' ', 'g')"
    for sign, mark, instead in (("''", 2, ""), ("-", 3, " ")):
        for _ in range(2):
            t = rf"regexp_replace({t}, '({_LETTER}){sign}({_LETTER})', '\1' || chr({mark}) || '\2', 'g')"
        t = f"replace(replace({t}, '{sign}', '{instead}'), chr({mark}), '{sign}')"
    return t


def _match(x: str) -> str:
    t = f"regexp_replace({_ocr(f"nfc_normalize(coalesce({x}, ''))")}, '[$€£¥₹]', '', 'g')"
    t = _unabbreviated(t)
    for _ in range(2):
        t = rf"regexp_replace({t}, '(\d),(\d{{3}})', '\1\2', 'g')"
    t = rf"regexp_replace({t}, '(\d)%', '\1', 'g')"
    return _collapse(_bare(f"lower({t})"))


def _unabbreviated(x: str) -> str:
    """Numbers with K, M or B written out, piece by piece: a computed replacement is no matter for one pattern."""
    number, letter = (rf"regexp_extract(m, '(?i)^([\d,.]+)\s*([KMB])$', {k})" for k in (1, 2))
    factor = f"CASE upper({letter}) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 ELSE 1e9 END"
    full = f"coalesce(CAST(CAST(trunc(TRY_CAST(replace({number}, ',', '') AS DOUBLE) * {factor}) AS BIGINT) AS VARCHAR), m)"
    marked = rf"string_split(regexp_replace({x}, '(?i)([\d,.]+\s*[KMB])\b', chr(4) || '\1' || chr(4), 'g'), chr(4))"
    return f"array_to_string(list_transform({marked}, lambda m, i: CASE WHEN i % 2 = 0 THEN {full} ELSE m END), '')"


_TIME_CASE = r"regexp_matches(t, '\d{1,2}:\d{2}')"
_DATE = "|".join(T._DATES)
_KINDS = rf"""CASE WHEN t = '' THEN 'empty' WHEN {_TIME_CASE} THEN 'time' WHEN regexp_matches(t, '(?i){_DATE}') THEN 'date'
  WHEN regexp_matches(t, '{T._KEY}') OR regexp_replace(lower(t), ':+$', '') IN ({", ".join(f"'{k}'" for k in T.KEYWORDS)}) THEN 'form_key'
  WHEN regexp_matches(t, '{T._CODE}') THEN 'code' WHEN regexp_matches(t, '{T._NUMBER}') THEN 'number' ELSE 'text' END"""
_TRIMMED = f"regexp_replace(coalesce(answer, ''), '^{_WS}+|{_WS}+$', '', 'g') AS t"
_CLOCK_SQL = T._CLOCK
_CATEGORY = """CASE WHEN t = 'form' THEN 'form' WHEN t = 'table' THEN 'table' WHEN t IN ('figure', 'chart', 'plot', 'graph') THEN 'figure' WHEN contains(t, 'table') THEN 'table'
  WHEN contains(t, 'form') THEN 'form' WHEN contains(t, 'fig') OR contains(t, 'chart') OR contains(t, 'plot') THEN 'figure' ELSE 'text' END"""
_COUNT = f"len({_words('t')})"

ORACLE = {
    "ws_norm": f"SELECT row_no, {_collapse('question')} AS text FROM qa_pairs",
    "ocr_fix": f"SELECT row_no, {_ocr('answer')} AS text FROM qa_pairs",
    "unicode_nfc": "SELECT row_no, nfc_normalize(answer) AS text FROM qa_pairs",
    "accents_removed": "SELECT row_no, strip_accents(answer) AS text FROM qa_pairs",
    # 1.5K and the like would need a computed replacement; the rows hold none, and equality over all rows shows it.
    "numbers_normalized": r"SELECT row_no, regexp_replace(regexp_replace(regexp_replace(regexp_replace(answer, '[$€£¥₹]', '', 'g'), '(\d),(\d{3})', '\1\2', 'g'), '(\d),(\d{3})', '\1\2', 'g'), '(\d)%', '\1', 'g') AS text FROM qa_pairs",
    "normalized_default": f"SELECT row_no, {_norm('question')} AS text FROM qa_pairs",
    "normalized_for_display": f"SELECT row_no, {_norm('question', lower=False)} AS text FROM qa_pairs",
    "jaccard_pairs": f"WITH n AS (SELECT row_no, {_norm('question')} AS q, {_norm('answer')} AS a FROM qa_pairs) SELECT row_no, round({_jaccard('q', 'a')}, 6) AS similarity FROM n",
    "token_types": f"WITH n AS (SELECT row_no, {_TRIMMED} FROM qa_pairs) SELECT row_no, {_KINDS} AS token_type FROM n",
    "token_type_hist": f"WITH n AS (SELECT {_TRIMMED} FROM qa_pairs) SELECT {_KINDS} AS token_type, count(*) AS n FROM n GROUP BY 1",
    "time_values": f"""WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%H:%M') WHEN 1 THEN strftime(ts, '%-I:%M %p') WHEN 2 THEN strftime(ts, '%H:%M:%S') WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE strftime(ts, '%H%M') END AS text FROM events)
SELECT event_id, text FROM t WHERE regexp_matches(text, '{_CLOCK_SQL}')""",
    "order_tokens_normalized": ORDER_TOKENS_SQL + f"SELECT doc_id, token_id, text AS original_text, {_norm('text')} AS text FROM tokens",
    "sentence_counts": "SELECT doc_id, CAST(len(regexp_split_to_array(coalesce(text, ''), '[.!?]')) AS INTEGER) AS pieces FROM documents",
    "target_sizes": """WITH s AS (SELECT p_partkey, (p_partkey * 37) % 6000 + 1 AS w, p_size * 113 AS h FROM part)
SELECT p_partkey, CAST(CASE WHEN greatest(w, h) <= 2500 THEN w WHEN w >= h THEN 2500 ELSE floor(w * (2500e0 / h)) END AS BIGINT) AS width, CAST(CASE WHEN greatest(w, h) <= 2500 THEN h WHEN w >= h THEN floor(h * (2500e0 / w)) ELSE 2500 END AS BIGINT) AS height FROM s""",
    "punctuation_removed": f"SELECT row_no, {_bare('answer')} AS text FROM qa_pairs",
    "normalized_for_matching": f"SELECT row_no, {_match('answer')} AS text FROM qa_pairs",
    "similarity_matching": f"WITH n AS (SELECT row_no, {_match('question')} AS q, {_match('answer')} AS a FROM qa_pairs) SELECT row_no, round({_jaccard('q', 'a')}, 6) AS similarity FROM n",
    "answer_span": f"""
WITH n AS (SELECT row_no, {_norm("answer")} AS a, {_norm("evidence_quotes")} AS c FROM qa_pairs WHERE answer IS NOT NULL AND evidence_quotes IS NOT NULL),
e AS (SELECT *, CASE WHEN a = '' THEN 0 ELSE instr(c, a) - 1 END AS hit, {_words("a")} AS wa, {_words("c")} AS wc FROM n),
w AS (SELECT row_no, c, {_norm("a")} AS again, i, array_to_string(wc[i + 1 : i + len(wa)], ' ') AS win
      FROM (SELECT *, unnest(range(greatest(len(wc) - len(wa) + 1, 0))) AS i FROM e WHERE hit < 0)),
v AS (SELECT row_no, c, i, win, again, {_norm("win")} AS wn FROM w),
s AS (SELECT row_no, c, i, win, {_jaccard("again", "wn")} AS sim FROM v),
b AS (SELECT * FROM s WHERE sim >= 0.8 QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY sim DESC, i) = 1)
SELECT row_no, CAST(hit AS INTEGER) AS start, CAST(hit + length(a) AS INTEGER) AS stop, 1.0 AS similarity FROM e WHERE hit >= 0
UNION ALL
SELECT e.row_no, CAST(coalesce(instr(b.c, b.win) - 1, -1) AS INTEGER), CAST(coalesce(instr(b.c, b.win) - 1 + length(b.win), -1) AS INTEGER), round(coalesce(sim, 0.0), 6) FROM e LEFT JOIN b USING (row_no) WHERE hit < 0""",
    "form_value_override": ORDER_TOKENS_SQL
    + f""", typed AS (SELECT *, {_KINDS.replace(" t ", " text ").replace("(t,", "(text,").replace("(t)", "(text)").replace("WHEN t =", "WHEN text =")} AS raw, (xmin + xmax) / 2 AS cx, (ymin + ymax) / 2 AS cy FROM tokens),
linked AS (SELECT *, coalesce(lag(raw) OVER w = 'form_key' AND sqrt((cx - lag(cx) OVER w) ** 2 + (cy - lag(cy) OVER w) ** 2) < 100, false) AS c FROM typed WINDOW w AS (PARTITION BY doc_id ORDER BY token_id)),
runs AS (SELECT *, sum(CASE WHEN c THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY token_id ROWS UNBOUNDED PRECEDING) AS run FROM linked)
SELECT doc_id, token_id, text, CASE WHEN c AND (row_number() OVER (PARTITION BY doc_id, run ORDER BY token_id) - 1) % 2 = 1 THEN 'form_value' ELSE raw END AS token_type FROM runs""",
    "form_lines": rf"""
WITH l AS (SELECT doc_id, i - 1 AS line, regexp_replace(parts[i], '^{_WS}+|{_WS}+$', '', 'g') AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
m AS (SELECT *, trim(regexp_extract(t, '^([A-Za-z][A-Za-z0-9\s\-_/.]{{0,38}}):\s*(.+)$', 1)) AS key, trim(regexp_extract(t, '^([A-Za-z][A-Za-z0-9\s\-_/.]{{0,38}}):\s*(.+)$', 2)) AS value FROM l
      WHERE regexp_matches(t, '^([A-Za-z][A-Za-z0-9\s\-_/.]{{0,38}}):\s*(.+)$') AND NOT regexp_matches(t, '{_CLOCK_SQL}'))
SELECT doc_id, CAST(line AS INTEGER) AS line, key, value FROM m WHERE length(key) <= 35 AND length(key) - length(replace(key, ' ', '')) <= 4 AND value <> ''""",
    "region_categories": f"SELECT region_id, {_CATEGORY} AS category FROM (SELECT region_id, lower(coalesce(region_type, '')) AS t FROM graph_visualization_output)",
    "long_texts": f"SELECT region_id, {_COUNT} AS words FROM (SELECT region_id, {_collapse("coalesce(text, '')")} AS t FROM graph_visualization_output) WHERE {_COUNT} >= 40",
}
