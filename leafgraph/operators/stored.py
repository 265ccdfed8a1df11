"""Stored graph documents, as JSON text, to question rows: nodes, edges and adjacency are taken from what each document says."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.config import QAConfig
from leafgraph.operators import graph as G
from leafgraph.operators import qa as Q
from leafgraph.operators.nested import graph_tables
from leafgraph.sources.tables import written


def graphs_of_payloads(df: DataFrame, record_id: str = "record_id", payload: str = "payload") -> tuple[DataFrame, DataFrame]:
    """Nodes and links of stored documents; the keys are the record and the document's place in it. A document without adjacency links its
    nodes by its edges, in both directions. A node id that stands twice counts once, as it does the last time."""
    tables = graph_tables(df, record_id, payload)
    keys = (F.col("record_id").cast("string").alias("doc_id"), F.col("doc_pos").alias("page_no"))
    nodes = tables["nodes"].select(*keys, F.col("node_id").cast("int").alias("node_id"), "pos", "region_type", "xmin", "ymin", "xmax", "ymax", "score", F.coalesce("text", F.lit("")).alias("text"))
    nodes = written(G.latest(nodes, ("doc_id", "page_no", "node_id"), ("pos",)).drop("pos"), "nodes")
    near = tables["neighbors"].select(*keys, F.col("node").cast("int").alias("source"), F.col("neighbor").cast("int").alias("target"), F.col("pos").alias("rank"))
    edges = tables["edges"].filter("source IS NOT NULL AND target IS NOT NULL").select(*keys, F.col("source").cast("int").alias("source"), F.col("target").cast("int").alias("target"), F.col("pos").alias("rank"))
    without = edges.join(near.select("doc_id", "page_no").distinct(), ["doc_id", "page_no"], "left_anti")
    both = G.undirected_adjacency(nodes, without).select("doc_id", "page_no", F.col("node_id").alias("source"), F.col("neighbor").alias("target"), F.col("at").alias("rank"))
    return nodes, near.unionByName(both)


def questions_of_payloads(df: DataFrame, record_id: str = "record_id", payload: str = "payload", config: QAConfig = QAConfig()) -> DataFrame:
    """All questions of each stored document. Payloads that can't be read give none and disturb no others."""
    nodes, links = graphs_of_payloads(df, record_id, payload)
    return Q.generate_qas(nodes, links, config)
