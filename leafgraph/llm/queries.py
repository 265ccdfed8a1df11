"""Queries over text for training language models; SQL where SQL can express them."""

from __future__ import annotations

import unicodedata

from leafgraph.llm.leaks import leak_report, leaked_items, without_leaks
from leafgraph.llm.packing import fill_report, pack
from leafgraph.llm.pairs import defect_counts, defective_pairs
from leafgraph.llm.quality import document_statistics, not_prose
from leafgraph.llm.reading import level_profile, reading_levels
from leafgraph.llm.scans import repaired_paragraphs, scan_noise
from leafgraph.llm.splits import found_pairs, overlap_report
from leafgraph.sources.tables import table


def _pairs(s, d):
    return table(s, d, "qa_pairs", "row_no", "question", "answer", "reasoning_type")


def _questions(s, d):
    return table(s, d, "qa_pairs", "qa_id", "doc_id", "split", "question", "source")


def _regions(s, d):
    return table(s, d, "graph_visualization_output", "region_id", "doc_id", "page_no", "node_id", "text", "created_at")


def _documents(s, d):
    return table(s, d, "documents", "doc_id", "text")


def _packed(s, d):
    return pack(_documents(s, d), table(s, d, "pack_capacities"))


def _items(s, d):
    return table(s, d, "eval_items", "item_id", "passage")


def _levels(s, d):
    return reading_levels(_documents(s, d), table(s, d, "reading_labels"))


QUERIES = {
    "p1_found": lambda s, d: defective_pairs(_pairs(s, d)),
    "p1_counts": lambda s, d: defect_counts(_pairs(s, d)),
    "p2_found": lambda s, d: scan_noise(_regions(s, d)),
    "p2_paragraphs": lambda s, d: repaired_paragraphs(_regions(s, d)),
    "p3_found": lambda s, d: not_prose(_regions(s, d)),
    "p3_statistics": lambda s, d: document_statistics(_regions(s, d)),
    "p4_found": lambda s, d: found_pairs(_questions(s, d)),
    "p4_report": lambda s, d: overlap_report(_questions(s, d)),
    "p6_containers": lambda s, d: _packed(s, d),
    "p6_fill": lambda s, d: fill_report(_packed(s, d)),
    "p7_found": lambda s, d: leaked_items(_documents(s, d), _items(s, d)).select("doc_id", "item_id"),
    "p7_spans": lambda s, d: leaked_items(_documents(s, d), _items(s, d)),
    "p7_removed": lambda s, d: leak_report(_documents(s, d), _items(s, d)),
    "p7_cleaned": lambda s, d: without_leaks(_documents(s, d), _items(s, d)),
    "p8_found": lambda s, d: _levels(s, d).select("doc_id", "reading_level"),
    "p8_profile": lambda s, d: level_profile(_levels(s, d)),
}

_OVERLAPS = """
WITH r AS (
  SELECT DISTINCT qa_id, doc_id, CASE WHEN s = 'train' THEN 'train' WHEN s IN ('val', 'validation') THEN 'validation' WHEN s = 'test' THEN 'test' END AS split, list_sort(list_distinct(regexp_extract_all(lower(question), '[\\p{L}\\p{N}]+'))) AS words
  FROM (SELECT *, lower(trim(split)) AS s FROM qa_pairs) WHERE qa_id IS NOT NULL AND question IS NOT NULL AND split IS NOT NULL),
k AS (SELECT *, row_number() OVER () AS k, len(words) AS n FROM r WHERE split IS NOT NULL AND len(words) > 0),
w AS (SELECT k, split = 'train' AS train, unnest(words) AS word FROM k),
c AS (SELECT e.k AS ek, t.k AS tk, count(*) AS common FROM w e JOIN w t ON e.word = t.word AND NOT e.train AND t.train GROUP BY ALL),
found AS (
  SELECT DISTINCT e.qa_id AS eval_id, t.qa_id AS train_id FROM c JOIN k e ON e.k = ek JOIN k t ON t.k = tk
  WHERE common >= 0.7 * (e.n + t.n - common) - 1e-9 AND ((e.n >= 12 AND t.n >= 12) OR e.doc_id = t.doc_id) AND e.qa_id <> t.qa_id)
"""

#: Forms of letters that unfold to one other letter or digit, by rule.
_FORMS = [(chr(c), u) for c in range(0x80, 0xFFFF) if not 0xD800 <= c < 0xE000 and len(u := unicodedata.normalize("NFKC", chr(c)).casefold()) == 1 and u.isalnum() and u != chr(c) and u != chr(c).lower()]
_LIGATURES = [(chr(c), unicodedata.normalize("NFKC", chr(c)).casefold()) for c in (0xDF, *range(0xFB00, 0xFB07))]


def _words_sql(text: str) -> str:
    """SQL for the words of a text, whatever its case, spacing, hyphens and forms of letters."""
    t = rf"regexp_replace(coalesce({text}, ''), '[\x{{200b}}\x{{200c}}\x{{200d}}\x{{2060}}\x{{feff}}]', '', 'g')"
    t = rf"replace(regexp_replace({t}, '\x{{ad}}([^\S\n]*\n)', '-\1', 'g'), chr(173), '')"
    t = f"lower(translate(nfc_normalize({t}), '{''.join(a for a, _ in _FORMS)}', '{''.join(b for _, b in _FORMS)}'))"
    for a, b in _LIGATURES:
        t = f"replace({t}, '{a}', '{b}')"
    for _ in range(2):
        t = rf"regexp_replace({t}, '(\p{{L}})[-\x{{2010}}\x{{2011}}\x{{ac}}]\s*(\p{{L}})', '\1\2', 'g')"
    return rf"regexp_extract_all({t}, '[\p{{L}}\p{{N}}]+')"


_LEAKS = rf"""
WITH s AS (SELECT item_id, i, parts[i] AS sentence FROM (SELECT item_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (
  SELECT item_id, string_split(regexp_replace(passage, '([.!?…]["''”’»)\]]*)\s+(["''“‘«(\[¿¡]*[\p{{Lu}}\p{{Lt}}\p{{Lo}}\p{{N}}])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts FROM eval_items WHERE passage IS NOT NULL))),
w AS (SELECT item_id, i, {_words_sql("sentence")} AS words FROM s),
standing AS (SELECT words FROM w WHERE len(words) >= 4 GROUP BY words HAVING count(DISTINCT item_id) >= 3),
n AS (SELECT w.*, st.words IS NOT NULL AS notice FROM w LEFT JOIN standing st ON w.words = st.words),
r AS (SELECT *, sum(CAST(notice AS INTEGER)) OVER (PARTITION BY item_id ORDER BY i) AS run FROM n),
runs AS (SELECT item_id, flatten(list(words ORDER BY i)) AS words FROM r WHERE NOT notice GROUP BY item_id, run),
item_grams AS (SELECT DISTINCT item_id, array_to_string(words[k:k + 11], ' ') AS g FROM (SELECT item_id, words, unnest(range(1, len(words) - 10)) AS k FROM runs WHERE len(words) >= 12)),
doc_words AS (SELECT doc_id, {_words_sql("text")} AS words FROM documents),
doc_grams AS (SELECT doc_id, array_to_string(words[k:k + 11], ' ') AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 10)) AS k FROM doc_words WHERE len(words) >= 12))
SELECT DISTINCT doc_id, item_id FROM doc_grams JOIN item_grams USING (g)"""

ORACLE = {
    "p7_found": _LEAKS,
    "p4_found": _OVERLAPS + "SELECT DISTINCT least(train_id, eval_id) AS qa_id_a, greatest(train_id, eval_id) AS qa_id_b FROM found",
    "p4_report": _OVERLAPS
    + """, each AS (SELECT eval_id, count(*) AS pairs FROM found GROUP BY 1),
about AS (SELECT DISTINCT qa_id AS eval_id, CASE WHEN lower(trim(split)) IN ('val', 'validation') THEN 'validation' ELSE 'test' END AS split, source FROM qa_pairs WHERE lower(trim(split)) IN ('val', 'validation', 'test'))
SELECT split, source, sum(pairs) AS pairs, count(*) AS eval_records FROM each JOIN about USING (eval_id) GROUP BY ALL""",
}
