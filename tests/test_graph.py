import pytest
from pyspark.sql import functions as F

from leafgraph.functions import geometry as g
from leafgraph.operators import graph as G

# The shipped golden page: type, bounds, and the best neighbours in order.
GOLDEN = [
    ("form", 38, 182, 523, 290), ("text", 137, 424, 1487, 537), ("text", 132, 571, 1472, 755), ("form", 132, 571, 1472, 755), ("text", 130, 863, 1493, 1305),
    ("text", 128, 1341, 1491, 1606), ("form", 128, 1341, 1491, 1606), ("text", 126, 1638, 1490, 1753), ("text", 125, 1788, 1447, 1868), ("text", 126, 1902, 1466, 2014),
]
ADJACENT = {0: [1, 2, 3, 8, 7], 1: [2, 3, 0, 4, 5], 2: [3, 1, 4, 0, 5], 3: [2, 1, 4, 0, 5], 4: [5, 6, 2, 3, 1], 5: [6, 7, 4, 8, 9], 6: [5, 7, 4, 8, 9], 7: [5, 6, 8, 9, 4], 8: [9, 7, 5, 6, 4], 9: [8, 7, 5, 6, 4]}
SCHEMA = "region_id long, doc_id string, page_no int, node_id int, region_type string, bbox array<array<double>>, score double, text string, created_at timestamp, rank string"


def regions(spark, boxes, text="line one of many\n" * 6):
    def corners(b):
        return [[float(b[0]), float(b[1])], [float(b[2]), float(b[1])], [float(b[2]), float(b[3])], [float(b[0]), float(b[3])]] if b else None

    return spark.createDataFrame([(i, "d", 1, i, t, corners(b), 1.0, text, None, "x") for i, (t, *b) in enumerate(boxes)], SCHEMA)


def test_golden_page(spark):
    nodes = G.graph_nodes(regions(spark, GOLDEN))
    edges = G.graph_edges(nodes).cache()
    assert edges.count() == 50 and {r.source: r.neighbors for r in G.adjacency(edges).collect()} == ADJACENT
    score = {(r.source, r.target, r.relation): r.score for r in edges.collect()}
    assert score[0, 1, "above"] == pytest.approx(0.7703257731958763, abs=1e-12) and score[0, 7, "above"] == pytest.approx(0.49113402061855665, abs=1e-12)
    assert score[1, 2, "above"] == pytest.approx(0.9705611940298507, abs=1e-12) and score[2, 3, "nearest_neighbor"] == 1.0
    assert {r.relation: r.n for r in G.share_of_total(edges, "relation").collect()} == {"above": 24, "below": 22, "nearest_neighbor": 4}
    doc = G.graph_documents(nodes, edges).first()
    assert doc.metadata.num_edges == 50 and doc.adjacency["4"] == ADJACENT[4] and doc.edges[0].target == 1


def test_captions(spark):
    rows = regions(spark, [("text", 50, 120, 200, 160), ("table", 50, 180, 350, 350)], "Table 1: Quarterly Sales Figures")
    got = {(r.source, r.relation): r.score for r in G.relations(G.graph_nodes(rows)).collect()}
    assert got[0, "is_caption_of"] == pytest.approx(0.8856) and got[1, "has_caption"] == pytest.approx(0.8856)


def test_symmetry_and_odd_rows(spark):
    rows = regions(spark, [*GOLDEN[:4], ("text",)]).unionByName(regions(spark, GOLDEN[:1]).withColumn("doc_id", F.lit(None).cast("string")))
    nodes = G.graph_nodes(rows)
    assert nodes.count() == 4
    rel = {(r.source, r.target, r.relation): r.score for r in G.relations(nodes).collect()}
    for (a, b, name), s in rel.items():
        assert 0.2 <= s <= 1
        if name in ("left_of", "above", "inside"):
            assert rel[b, a, {"left_of": "right_of", "above": "below", "inside": "contains"}[name]] == s
    assert G.degree_stats(nodes, G.graph_edges(nodes).limit(0)).first().max_out == 0
    empty = G.graph_nodes(rows.limit(0))
    assert G.graph_edges(empty).count() == 0 and G.score_histogram(G.graph_edges(empty)).count() == 0


def test_demo_types_give_no_captions(spark):
    rows = regions(spark, [("TextBlock", 50, 120, 200, 160), ("Table", 50, 180, 350, 350)], "Table 1")
    assert not G.relations(G.graph_nodes(rows)).filter("category = 'semantic'").count()


def test_iou_and_undirected(spark):
    nodes = G.graph_nodes(regions(spark, [("text", 0, 0, 10, 10), ("text", 5, 0, 15, 10)]))
    assert G._pairs(nodes).select(g.iou("a_", "b_").alias("i")).first().i == pytest.approx(1 / 3)
    edges = G.graph_edges(nodes)
    assert {(r.node_id, r.neighbor) for r in G.undirected_adjacency(nodes, edges).collect()} == {(0, 1), (1, 0)}
