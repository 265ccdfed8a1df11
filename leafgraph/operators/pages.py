"""Whole pages: from tokens to a result with its error, and the full export of every stage.

A page that can't be laid out becomes a row with an error instead of failing its batch; a page without regions is a success with an empty
graph. Every row belongs to one page: tokens come as rows, or page by page as ``paged.packed`` has them, and go to their page once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.config import LayoutConfig
from leafgraph.operators import paged


def _sheets(tokens: DataFrame) -> DataFrame:
    return tokens if "tokens" in tokens.columns else paged.packed(tokens)


def page_results(tokens: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """A row for each page: (doc_id, success, error, num_regions, num_nodes, num_edges, data); ``data`` is the graph document, null for failures."""
    p = paged.pages(_sheets(tokens), ["doc_id", "error", "nodes", "edges", "adjacency"], config)
    sizes = (F.size("nodes").alias("num_regions"), F.size("nodes").alias("num_nodes"), F.size("edges").alias("num_edges"))
    meta = F.struct(F.concat("doc_id", F.lit("_1.png")).alias("source_image"), *sizes)
    data = F.when(F.col("error").isNull(), F.struct(F.lit("1.0.0").alias("version"), "nodes", "edges", "adjacency", meta.alias("metadata")))
    return p.select("doc_id", F.col("error").isNull().alias("success"), "error", *sizes, data.alias("data"))


def full_export(tokens: DataFrame, config: LayoutConfig = LayoutConfig()) -> DataFrame:
    """Everything that is known of each page that can be laid out: (doc_id, version, created_at, ocr, layout, graph), for ``write_json``."""
    p = paged.pages(_sheets(tokens), list(paged.PARTS), config).filter("error IS NULL AND doc_id IS NOT NULL")
    count = lambda c: F.size(c).alias("num_" + c)
    ocr = F.struct(F.lit(True).alias("success"), count("tokens"), F.lit(0).alias("processing_time_ms"), "tokens")
    layout = F.struct(*map(count, ("lines", "blocks", "regions")), "lines", "blocks", "regions")
    graph = F.struct(count("nodes"), count("edges"), "nodes", "edges", "adjacency")
    return p.select("doc_id", F.lit("1.0.0").alias("version"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"), ocr.alias("ocr"), layout.alias("layout"), graph.alias("graph"))
