import random

import pytest
from oracle import plain
from pyspark.sql import functions as F

from leafgraph.operators import graph as G
from leafgraph.operators import layout as L
from leafgraph.operators import paged
from leafgraph.operators.pages import full_export, page_results
from leafgraph.plans.layout_queries import QUERIES
from leafgraph.plans.render import region_pages, region_tokens
from leafgraph.sources import tables

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id string, token_id int, text string, confidence double, xmin double, ymin double, xmax double, ymax double"
WORDS = ["Name:", "John", "Date:", "12:30", "a:b", ":", "", "x y", "Total", "№", "１２", "12.5", "-3", " z", "5", "long" * 5, "K-1:", "v/1:", "5\x1c", "𝟙2", "this", None, "Key one:", "am", "7:05pm", "\rq"]


def odd_pages(count=60, seed=5):
    rng, rows = random.Random(seed), []
    for d in range(count):
        n = rng.choice([1, 2, 5, 30, 80])
        for i in range(n):
            t = rng.choice(WORDS)
            x, y, w, h = 50 + 8 * rng.randint(0, 60), 50 + 24 * rng.randint(0, max(1, n // 5)), 8 * len(t or ""), 16
            if rng.random() < 0.3:
                x, y, w, h = rng.uniform(-50, 300), rng.uniform(-20, 300), rng.uniform(0, 90), rng.uniform(0, 60)
            rows.append((f"p{d}", i, t, 0.5, None if d == 7 else float(x), float(y), float(x + w), float(y + h)))
    return rows


def found(df, *columns):
    return sorted(([plain(v) for v in r] for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def odd(spark):
    tokens = spark.createDataFrame(odd_pages(), SCHEMA)
    result = L.analyze(tokens)
    nodes = tables.written(L.region_nodes(result), "nodes")
    return tokens, result, nodes, tables.written(G.graph_edges(nodes), "edges")


def test_results_of_pages_are_those_of_rows(odd):
    tokens, _, nodes, edges = odd
    got = page_results(tokens).cache()
    docs = G.graph_documents(nodes, edges).select("doc_id", "nodes", "edges", "adjacency", "metadata")
    assert docs.count() > 20 and edges.count() > 100
    assert found(got.filter("num_nodes > 0"), "doc_id", "data.nodes", "data.edges", "data.adjacency", "data.metadata") == found(docs, *docs.columns)
    assert found(got.filter("error IS NOT NULL"), "doc_id", "success", "num_nodes", "data") == [["p7", False, 0.0, None]]
    assert got.count() == 60 and got.filter("success AND data IS NULL").count() == 0


def test_export_of_pages_is_that_of_rows(odd):
    tokens, result, nodes, edges = odd
    got = full_export(tokens).cache()
    assert got.count() == 59
    for part, rows in (("ocr.tokens", tokens.filter("doc_id <> 'p7'")), ("layout.lines", result["block_lines"]), ("layout.regions", result["regions"]), ("graph.edges", edges)):
        each = got.select("doc_id", F.inline(part))
        assert found(each, *each.columns) == found(rows, *each.columns), part
    blocks = result["block_lines"].groupBy("doc_id", "block_id").agg(F.count("*").alias("lines"), *(f(c).alias(c) for f, c in zip((F.min, F.min, F.max, F.max), L.BOUNDS)))
    each = got.select("doc_id", F.inline("layout.blocks"))
    assert found(each, *each.columns) == found(blocks, *each.columns)


def test_many_tokens_at_one_place_and_pages_without_name(spark):
    rows = [("p", i, "x", 0.5, 0.0, 0.0, 8.0, 16.0) for i in range(1500)] + [("p", 1500, "y", 0.5, 900.0, 0.0, 908.0, 16.0), (None, 0, "z", 0.5, 0.0, 0.0, 8.0, 16.0)]
    tokens = spark.createDataFrame(rows, SCHEMA)
    assert found(page_results(tokens), "doc_id", "success", "num_nodes") == sorted([["p", True, 0.0], [None, True, 0.0]], key=repr)
    assert found(full_export(tokens), "doc_id", "ocr.num_tokens", "layout.num_lines", "layout.num_blocks") == [["p", 1501.0, 2.0, 2.0]]


def test_pages_have_the_tokens_of_rows(spark):
    got = region_pages(spark, SMALL).select("doc_id", F.inline("tokens"))
    assert found(got, *got.columns) == found(region_tokens(spark, SMALL), *got.columns)


@pytest.mark.parametrize("name", ["page_results", "full_export"])
def test_tokens_are_neither_sent_nor_stored(spark, name):
    before = len(tables._WRITTEN)
    df = QUERIES[name](spark, SMALL)
    assert len(tables._WRITTEN) == before
    plan = df._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Exchange ")]
    assert plan.count("Exchange ") == 1 and above.count("MapInArrow") == 2, plan
