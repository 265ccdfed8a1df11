"""Pages of tokens with boxes, laid out by rule from the tables, for the layout stage: prose pages of documents, form pages of orders, and the
scanned pages, word by word within the boxes of their regions: uneven heights, gaps, words that run over other boxes, and pages that fail.

A character is 8 wide, a line 16 high, lines are 24 apart; ``DOCUMENT_TOKENS_SQL`` and ``ORDER_TOKENS_SQL`` say the same in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leafgraph.functions import geometry as g
from leafgraph.functions.textnorm import WS, collapse
from leafgraph.operators import paged
from leafgraph.operators.graph import latest
from leafgraph.sources.tables import table

WORDS_A_LINE, LINES_A_PARAGRAPH, PARAGRAPH_GAP = 12, 5, 40


def document_tokens(spark, d: str) -> DataFrame:
    """Every document as one page: twelve words to a line, a wider gap after every fifth line."""
    docs = table(spark, d, "documents", "doc_id", "text").withColumn("t", collapse(F.coalesce("text", F.lit("")))).filter("t <> ''")
    t = docs.select("doc_id", F.posexplode(F.split("t", " ")).alias("token_id", "text"))
    t = t.withColumn("line_no", F.floor(F.col("token_id") / WORDS_A_LINE).cast("int"))
    w = Window.partitionBy("doc_id", "line_no").orderBy("token_id").rowsBetween(Window.unboundedPreceding, -1)
    x = 50.0 + 8 * F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0))
    y = 50.0 + 24 * F.col("line_no") + PARAGRAPH_GAP * F.floor(F.col("line_no") / LINES_A_PARAGRAPH)
    t = t.withColumns({"xmin": x, "ymin": y})
    return t.select("doc_id", "token_id", "text", F.lit(0.9).alias("confidence"), "xmin", "ymin", (F.col("xmin") + 8 * F.length("text")).alias("xmax"), (F.col("ymin") + 16).alias("ymax"))


DOCUMENT_TOKENS_SQL = f"""
WITH RECURSIVE texts AS (SELECT doc_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS t FROM documents WHERE text IS NOT NULL),
split_words AS (SELECT doc_id, unnest(string_split(t, ' ')) AS text, unnest(range(len(string_split(t, ' ')))) AS token_id FROM texts WHERE t <> ''),
lined AS (SELECT *, token_id // {WORDS_A_LINE} AS line_no FROM split_words),
placed AS (SELECT *, 50e0 + 8 * coalesce(sum(length(text) + 1) OVER (PARTITION BY doc_id, line_no ORDER BY token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS xmin,
           50e0 + 24 * line_no + {PARAGRAPH_GAP} * (line_no // {LINES_A_PARAGRAPH}) AS ymin FROM lined),
tokens AS (SELECT doc_id, CAST(token_id AS INTEGER) AS token_id, text, xmin, ymin, xmin + 8 * length(text) AS xmax, ymin + 16 AS ymax FROM placed)
"""

#: Label and value of each line of an order's form.
_FIELDS = (("Order Key:", "o_orderkey"), ("Status:", "o_orderstatus"), ("Priority:", "o_orderpriority"), ("Customer:", "o_custkey"))


def order_tokens(spark, d: str) -> DataFrame:
    """Every order as one page of four form lines, label beside value."""
    o = table(spark, d, "orders", *(c for _, c in _FIELDS))
    parts = []
    for k, (label, column) in enumerate(_FIELDS):
        value = F.col(column).cast("string")
        parts += [F.struct(F.lit(2 * k).alias("token_id"), F.lit(label).alias("text"), F.lit(50.0).alias("xmin"), F.lit(50.0 + 24 * k).alias("ymin")),
                  F.struct(F.lit(2 * k + 1).alias("token_id"), value.alias("text"), F.lit(50.0 + 8 * (len(label) + 1)).alias("xmin"), F.lit(50.0 + 24 * k).alias("ymin"))]
    t = o.select(F.col("o_orderkey").alias("doc_id"), F.explode(F.array(*parts)).alias("t")).select("doc_id", "t.*")
    return t.select("doc_id", "token_id", "text", F.lit(0.9).alias("confidence"), "xmin", "ymin", (F.col("xmin") + 8 * F.length("text")).alias("xmax"), (F.col("ymin") + 16).alias("ymax"))


ORDER_TOKENS_SQL = (
    "WITH RECURSIVE cells AS ("
    + " UNION ALL ".join(
        f"SELECT o_orderkey AS doc_id, {2 * k} AS token_id, '{label}' AS text, 50e0 AS xmin, {50 + 24 * k}e0 AS ymin FROM orders UNION ALL "
        f"SELECT o_orderkey, {2 * k + 1}, CAST({column} AS VARCHAR), {50 + 8 * (len(label) + 1)}e0, {50 + 24 * k}e0 FROM orders"
        for k, (label, column) in enumerate(_FIELDS)
    )
    + "), tokens AS (SELECT doc_id, token_id, text, xmin, ymin, xmin + 8 * length(text) AS xmax, ymin + 16 AS ymax FROM cells)"
)


def region_tokens(spark, d: str) -> DataFrame:
    """Every scanned page: the lines of a region share its height, a word stands where its characters do. Regions without a box give tokens without one."""
    r = table(spark, d, "graph_visualization_output", "doc_id", "page_no", "node_id", "bbox", "text", "created_at", "region_id")
    r = latest(r, ("doc_id", "page_no", "node_id"), ("created_at", "region_id")).filter("doc_id IS NOT NULL AND page_no IS NOT NULL AND node_id IS NOT NULL")
    box = g.corners_bounds(F.col("bbox"))
    lines = F.split(F.replace(F.coalesce("text", F.lit("")), F.lit("\t"), F.lit("    ")), "\n")
    r = r.select(F.concat_ws("_", "doc_id", F.col("page_no").cast("string")).alias("doc_id"), "node_id", *(v.alias(k) for k, v in box.items()), lines.alias("_l"))
    step = (F.col("ymax") - F.col("ymin")) / F.size("_l")
    r = r.withColumn("_h", step).select("doc_id", "node_id", "xmin", "ymin", "_h", F.posexplode("_l").alias("line", "_t"))
    r = r.withColumn("_w", F.split("_t", " ")).select("doc_id", "node_id", "xmin", "ymin", "_h", "line", "_w", F.posexplode("_w").alias("k", "text")).filter("text <> ''")
    before = F.when(F.col("k") > 0, F.length(F.array_join(F.slice("_w", F.lit(1), F.col("k")), " ")) + 1).otherwise(0)
    x, y = F.col("xmin") + 8 * before, F.col("ymin") + F.col("_h") * F.col("line")
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("node_id", "line", "k")) - 1
    t = r.select("doc_id", number.alias("token_id"), "text", F.lit(0.9).alias("confidence"), x.alias("xmin"), y.alias("ymin"), "_h")
    return t.select("doc_id", "token_id", "text", "confidence", "xmin", "ymin", (F.col("xmin") + 8 * F.length("text")).alias("xmax"), (F.col("ymin") + 0.8 * F.col("_h")).alias("ymax"))



def region_pages(spark, d: str) -> DataFrame:
    """The pages of ``region_tokens``, each with its tokens in one row (doc_id, tokens). Only regions are sent to their page; words are cut out there."""
    r = table(spark, d, "graph_visualization_output", "doc_id", "page_no", "node_id", "bbox", "text", "created_at", "region_id").filter("doc_id IS NOT NULL AND page_no IS NOT NULL AND node_id IS NOT NULL")
    box = g.corners_bounds(F.col("bbox"))
    r = r.select(F.concat_ws("_", "doc_id", F.col("page_no").cast("string")).alias("page"), "node_id", box["xmin"].alias("x"), box["ymin"].alias("y"), (box["ymax"] - box["ymin"]).alias("h"), F.coalesce("text", F.lit("")).alias("text"), "created_at", "region_id")
    r = latest(r.repartition("page"), ("page", "node_id"), ("created_at", "region_id")).drop("created_at", "region_id")
    return r.sortWithinPartitions("page", "node_id").mapInArrow(_drawn, f"doc_id string, tokens {paged.PARTS['tokens']}")


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regions in order of page and node to pages of tokens. The last page of a batch waits for the next."""
    held = None
    for batch in batches:
        regions = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not regions.num_rows:
            continue
        page = regions.column("page")
        last = pc.index(page, page[-1]).as_py()
        if last:
            yield _words(regions.slice(0, last).to_batches()[0])
        held = regions.slice(last).to_batches()[0]
    if held is not None and held.num_rows:
        yield _words(held)


def _words(regions: pa.RecordBatch) -> pa.RecordBatch:
    number = lambda c: regions.column(c).to_numpy(zero_copy_only=False)  # noqa: E731  a null is not a number here
    page = regions.column("page")
    names = pc.unique(page)
    page = pc.index_in(page, names).to_numpy(zero_copy_only=False)
    split = pc.split_pattern(pc.replace_substring(regions.column("text"), "\t", "    "), "\n")
    n_lines = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    region = np.repeat(np.arange(len(page)), n_lines)
    within = np.arange(len(region)) - np.repeat(np.cumsum(n_lines) - n_lines, n_lines)
    split = pc.split_pattern(split.flatten(), " ")
    n_words = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    words = split.flatten()
    line = np.repeat(np.arange(len(region)), n_words)
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    before = np.cumsum(length + 1) - (length + 1)
    before -= np.repeat(before[np.cumsum(n_words) - n_words], n_words)
    real = np.flatnonzero(length > 0)
    line, length, before = line[real], length[real], before[real]
    region, within = region[line], within[line]
    h = (number("h") / n_lines)[region]
    x, y = number("x")[region] + 8 * before, number("y")[region] + h * within
    count = np.bincount(page[region], minlength=len(names))
    there = np.flatnonzero(count)
    first = np.cumsum(count) - count
    ids = np.arange(len(region)) - first[page[region]]
    bounds = [pa.array(v, pa.float64(), from_pandas=True) for v in (x, y, x + 8 * length, y + 0.8 * h)]
    tokens = pa.StructArray.from_arrays([pa.array(ids.astype(np.int32)), words.take(pa.array(real)), pa.array(np.full(len(ids), 0.9)), *bounds], names=[c.split(" ")[0] for c in paged.TOKEN.split(",")])
    listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count[there])], pa.int32()), tokens)
    return pa.RecordBatch.from_arrays([names.take(pa.array(there)), listed], names=["doc_id", "tokens"])


REGION_TOKENS_SQL = """
WITH RECURSIVE newest AS (SELECT * FROM graph_visualization_output WHERE doc_id IS NOT NULL AND page_no IS NOT NULL AND node_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY doc_id, page_no, node_id ORDER BY created_at DESC NULLS LAST, region_id DESC) = 1),
boxed AS (SELECT doc_id || '_' || page_no AS doc_id, node_id, list_min(list_transform(bbox, lambda p: p[1])) AS x, list_min(list_transform(bbox, lambda p: p[2])) AS y, list_max(list_transform(bbox, lambda p: p[2])) AS y2,
  string_split(replace(coalesce(text, ''), chr(9), '    '), chr(10)) AS ls FROM newest),
spread AS (SELECT doc_id, node_id, x, y, (y2 - y) / len(ls) AS h, i - 1 AS line, string_split(ls[i], ' ') AS ws FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM boxed)),
placed AS (SELECT doc_id, node_id, line, k, ws[k] AS text, x + 8 * CASE WHEN k > 1 THEN length(array_to_string(ws[1:k - 1], ' ')) + 1 ELSE 0 END AS xmin, y + h * line AS ymin, h FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS k FROM spread)),
tokens AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY node_id, line, k) - 1 AS INTEGER) AS token_id, text, xmin, ymin, xmin + 8 * length(text) AS xmax, ymin + 0.8e0 * h AS ymax FROM placed WHERE text <> '')
"""
