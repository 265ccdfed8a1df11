"""Region graphs: nodes, scored relations between the regions of a page, the best edges of each node, adjacency and statistics.

A graph belongs to one page of one document (the keys). Rows with a null key or without a box have no place in a graph and are left out.
Pairs are formed within a page only, whose regions are bounded by the paper; the join's key is the page, so a document of any number of
pages spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafgraph.config import GraphConfig
from leafgraph.functions import geometry as g

KEYS = ("doc_id", "page_no")
RELATIONS = ("left_of", "right_of", "above", "below", "inside", "contains", "nearest_neighbor", "caption")


def latest(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row per key: the one delivered last. A hash aggregate; only narrow rows are kept while it runs."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*(F.col(c).isNotNull() for c in order[:1]), *order)
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ranked).alias("_r")).select(*keys, "_r.*")


def graph_nodes(regions: DataFrame, config: GraphConfig = GraphConfig()) -> DataFrame:
    """Nodes (doc_id, page_no, node_id, region_type, bounds, score, text, is_short, whole) from regions with corner boxes. ``text`` is what a
    stored graph shows of a node, one line cut at ``text_chars``; ``whole`` is all of it, with its line breaks."""
    rows = latest(regions.select("doc_id", "page_no", "node_id", "region_type", "bbox", "score", "text", "created_at", "region_id"), ("doc_id", "page_no", "node_id"), ("created_at", "region_id"))
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    short = (F.col("region_type") == "text") & (F.size(lines) <= config.caption_lines) & (F.length(F.array_join(lines, "")) < config.caption_chars)
    box = g.corners_bounds(F.col("bbox"))
    return rows.select(
        "doc_id", "page_no", "node_id", "region_type", *(v.alias(k) for k, v in box.items()), "score",
        F.substring(F.array_join(lines, " "), 1, config.text_chars).alias("text"), F.coalesce(short, F.lit(False)).alias("is_short"), F.coalesce("text", F.lit("")).alias("whole"),
    ).filter("xmin IS NOT NULL AND doc_id IS NOT NULL AND page_no IS NOT NULL AND node_id IS NOT NULL")


def _pairs(nodes: DataFrame) -> DataFrame:
    used = ["node_id", "region_type", "xmin", "ymin", "xmax", "ymax", "is_short"]
    a = nodes.select(*KEYS, *(F.col(c).alias(f"a_{c}") for c in used))
    b = nodes.select(*KEYS, *(F.col(c).alias(f"b_{c}") for c in used))
    return a.join(b, list(KEYS)).filter(F.col("a_node_id") != F.col("b_node_id"))


def overlaps(nodes: DataFrame) -> DataFrame:
    """Intersection over union of the nodes of a page that share ground: (keys, source, target, iou)."""
    return _pairs(nodes).select(*KEYS, F.col("a_node_id").alias("source"), F.col("b_node_id").alias("target"), g.iou("a_", "b_").alias("iou")).filter("iou > 0")


def relations(nodes: DataFrame, config: GraphConfig = GraphConfig()) -> DataFrame:
    """All relations of all ordered pairs of a page that reach the least score: (keys, source, target, relation, score, category)."""
    a, b = "a_", "b_"
    name, score = g.caption(a, b, config)
    right, below = g.left_of(b, a, config), g.above(b, a, config)
    scored = [
        ("left_of", g.left_of(a, b, config), "spatial"), ("right_of", right, "spatial"), ("above", g.above(a, b, config), "spatial"), ("below", below, "spatial"),
        ("inside", g.inside(a, b), "spatial"), ("contains", g.inside(b, a), "spatial"), ("nearest_neighbor", g.nearest(a, b, config), "proximity"),
    ]
    each = [F.struct(F.lit(k).alias("rel_ord"), F.lit(n).alias("relation"), s.alias("score"), F.lit(c).alias("category")) for k, (n, s, c) in enumerate(scored)]
    each.append(F.struct(F.lit(7).alias("rel_ord"), name.alias("relation"), F.coalesce(score, F.lit(0.0)).alias("score"), F.lit("semantic").alias("category")))
    exploded = _pairs(nodes).select(*KEYS, F.col("a_node_id").alias("source"), F.col("b_node_id").alias("target"), F.explode(F.array(*each)).alias("r"))
    return exploded.select(*KEYS, "source", "target", "r.*").filter((F.col("score") >= config.min_score) & F.col("relation").isNotNull())


def graph_edges(nodes: DataFrame, config: GraphConfig = GraphConfig()) -> DataFrame:
    """The best ``top_k`` edges of each source, by score, then target, then kind of relation."""
    w = Window.partitionBy(*KEYS, "source").orderBy(F.desc("score"), "target", "rel_ord")
    return relations(nodes, config).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= config.top_k).drop("rel_ord")


def adjacency(edges: DataFrame) -> DataFrame:
    """Out-neighbours of each source in order of score; a neighbour stands once for each of its edges."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "target")))
    return edges.groupBy(*KEYS, "source").agg(F.transform(ordered, lambda x: x["target"]).alias("neighbors"))


def adjacency_map(edges: DataFrame) -> DataFrame:
    """The adjacency of a page as one map, with text keys as in stored graphs."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("source").cast("string").alias("k"), "neighbors")))
    return adjacency(edges).groupBy(*KEYS).agg(F.map_from_entries(pairs).alias("adjacency"))


def undirected_adjacency(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Neighbours over edges in either direction, as (keys, node_id, neighbor, at); ends that are null or no nodes of the page are left out one by one."""
    both = edges.select(*KEYS, F.col("source").alias("node_id"), F.col("target").alias("neighbor"), "rank", F.lit(0).alias("back"), F.col("source").alias("s"))
    back = edges.select(*KEYS, F.col("target").alias("node_id"), F.col("source").alias("neighbor"), "rank", F.lit(1).alias("back"), F.col("source").alias("s"))
    known = nodes.select(*KEYS, "node_id")
    linked = both.unionByName(back).filter("neighbor IS NOT NULL").join(known, [*KEYS, "node_id"], "left_semi")
    w = Window.partitionBy(*KEYS, "node_id").orderBy("s", "rank", "back")
    return linked.select(*KEYS, "node_id", "neighbor", (F.row_number().over(w) - 1).alias("at"))


def degree_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Average and largest in- and out-degree of each page's nodes, nodes without edges included."""
    out = edges.groupBy(*KEYS, F.col("source").alias("node_id")).agg(F.count("*").alias("o"))
    into = edges.groupBy(*KEYS, F.col("target").alias("node_id")).agg(F.count("*").alias("i"))
    per = nodes.select(*KEYS, "node_id").join(out, [*KEYS, "node_id"], "left").join(into, [*KEYS, "node_id"], "left").fillna(0, ["o", "i"])
    return per.groupBy(*KEYS).agg(F.count("*").alias("nodes"), F.avg("o").alias("avg_out"), F.max("o").alias("max_out"), F.avg("i").alias("avg_in"), F.max("i").alias("max_in"))


def score_stats(edges: DataFrame, *keys: str) -> DataFrame:
    """Mean, quartiles, least, greatest and population deviation of edge scores."""
    return edges.groupBy(*keys).agg(
        F.count("*").alias("edges"), F.avg("score").alias("mean"), F.percentile("score", F.lit(0.25)).alias("lower_quartile"), F.median("score").alias("median"), F.percentile("score", F.lit(0.75)).alias("upper_quartile"), F.min("score").alias("least"), F.max("score").alias("greatest"), F.stddev_pop("score").alias("deviation")
    )


def score_histogram(edges: DataFrame, bins: int = 20) -> DataFrame:
    """Edges in equal bins from the least to the greatest score; the last bin is closed."""
    ends = edges.agg(F.min("score").alias("lo"), F.max("score").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.least(F.coalesce(F.floor(F.try_divide(F.col("score") - F.col("lo"), width)), F.lit(0)), F.lit(bins - 1)).cast("int")
    return edges.join(F.broadcast(ends)).select(at.alias("bin")).groupBy("bin").agg(F.count("*").alias("edges"))  # ``ends`` is one row


def share_of_total(df: DataFrame, *by: Column | str) -> DataFrame:
    """Count and percentage of each value; the total is taken from the counts, not from the rows again."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.join(F.broadcast(total)).withColumn("percent", F.try_divide(F.col("n") * 100.0, F.col("_t"))).drop("_t")  # one row


def edge_ends(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with type and text of both ends."""
    end = lambda p: nodes.select(*KEYS, F.col("node_id").alias(p), F.col("region_type").alias(p + "_type"), F.col("text").alias(p + "_text"))
    return edges.join(end("source"), [*KEYS, "source"]).join(end("target"), [*KEYS, "target"])


def canvas(nodes: DataFrame, margin: float = 50.0) -> DataFrame:
    """Extent of each page's drawing."""
    return nodes.groupBy(*KEYS).agg((F.max("xmax") + margin).alias("width"), (F.max("ymax") + margin).alias("height"))


def graph_documents(nodes: DataFrame, edges: DataFrame, version: str = "1.0.0") -> DataFrame:
    """One nested graph document a page: nodes, edges, adjacency and metadata."""
    n = nodes.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("node_id", "region_type", g.rectangle().alias("bbox"), "score", "text"))).alias("nodes"))
    e = edges.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("source", "rank", "target", "relation", "score", "category"))).alias("edges"))
    e = e.withColumn("edges", F.transform("edges", lambda x: x.dropFields("rank")))
    docs = n.join(e, list(KEYS), "left").join(adjacency_map(edges), list(KEYS), "left")
    empty_edges = F.coalesce("edges", F.array().cast(e.schema["edges"].dataType))
    meta = F.struct(F.concat(F.col("doc_id"), F.lit("_"), F.col("page_no").cast("string"), F.lit(".png")).alias("source_image"), F.size("nodes").alias("num_regions"), F.size("nodes").alias("num_nodes"), F.size(empty_edges).alias("num_edges"))
    return docs.select(*KEYS, F.lit(version).alias("version"), "nodes", empty_edges.alias("edges"), F.coalesce("adjacency", F.create_map().cast("map<string,array<int>>")).alias("adjacency"), meta.alias("metadata"))
