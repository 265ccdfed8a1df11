import random

import pytest
from pyspark.sql import functions as F

from leafgraph.operators import layout as L
from leafgraph.operators.components import _roots, components, propagate

SCHEMA = "doc_id long, token_id int, text string, xmin double, ymin double, xmax double, ymax double, label string"


def page(words, doc=1, start=0):
    """Tokens from (text, x, y): eight wide a character, sixteen high."""
    return [(doc, start + i, t, float(x), float(y), float(x + 8 * len(t)), float(y + 16), "z") for i, (t, x, y) in enumerate(words)]


def run(spark, rows):
    return L.analyze(spark.createDataFrame(rows, SCHEMA).drop("label"))


def overlap(a0, a1, b0, b1):
    least = min(a1 - a0, b1 - b0)
    return max(0, min(a1, b1) - max(a0, b0)) / least if least > 0 else 0


def test_lines_are_the_plain_rule(spark):
    rng = random.Random(7)
    rows = [(d, i, "x" * rng.randint(1, 6), *(lambda x, y, w, h: (x, y, x + w, y + h))(rng.uniform(0, 300), rng.uniform(0, 200), rng.uniform(5, 60), rng.uniform(0, 25)), "z") for d in range(3) for i in range(60)]
    got = {(r.doc_id, r.token_id): r.label for r in L.tokens_of_lines(spark.createDataFrame(rows, SCHEMA).drop("label")).collect()}
    for d in range(3):
        mine = [r for r in rows if r[0] == d]
        widths, heights = sorted((r[5] - r[3]) / len(r[2]) for r in mine), sorted(r[6] - r[4] for r in mine)
        mid = lambda v: (v[len(v) // 2] + v[(len(v) - 1) // 2]) / 2
        cw, mh = mid(widths), mid(heights)
        pairs = []
        for a in mine:
            for b in mine:
                if a[1] < b[1] and min(abs(a[5] - b[3]), abs(b[5] - a[3])) < 3 * cw:
                    if overlap(a[4], a[6], b[4], b[6]) >= 0.5 or abs((a[4] + a[6]) / 2 - (b[4] + b[6]) / 2) < 0.3 * mh:
                        pairs.append((a[1], b[1]))
        roots = _roots(pairs)
        assert {r[1]: roots.get(r[1], r[1]) for r in mine} == {i: v for (e, i), v in got.items() if e == d}


def test_components_agree(spark):
    rng = random.Random(3)
    edges = [(d, rng.randrange(40), rng.randrange(40)) for d in range(4) for _ in range(30)]
    e = spark.createDataFrame([x for x in edges if x[1] != x[2]], "doc_id long, a long, b long")
    v = spark.createDataFrame([(d, i) for d in range(4) for i in range(40)], "doc_id long, id long")
    local = {tuple(r) for r in components(v, e).collect()}
    assert local == {tuple(r) for r in components(v, e, local_edges=5).collect()}
    assert {tuple(r) for r in propagate(e).collect()} <= local


def test_gaps_make_lines_and_blocks(spark):
    r = run(spark, page([("abcd", 0, 0), ("efgh", 40, 0)]) + page([("abcd", 0, 0), ("efgh", 62, 0)], doc=2) + page([("abcd", 0, 0), ("efgh", 0, 24)], doc=3) + page([("abcd", 0, 0), ("efgh", 0, 60)], doc=4))
    lines = {(x.doc_id): x.n for x in r["lines"].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    blocks = {x.doc_id: x.n for x in r["block_lines"].groupBy("doc_id").agg(F.count_distinct("block_id").alias("n")).collect()}
    assert lines == {1: 1, 2: 2, 3: 2, 4: 2} and blocks[3] == 1 and blocks[4] == 2


def test_forms(spark):
    kv = [(t, x, 24 * k) for k in range(3) for t, x in (("Name:", 0), (f"value{k}", 48))]
    mixed = [("Name:", 0, 0), ("John", 48, 0), ("plain", 0, 24), ("words", 48, 24)]
    r = run(spark, page(kv) + page(mixed, doc=2) + page([("alone", 0, 0)], doc=3))
    first = r["regions"].filter("doc_id = 1 AND region_id = 0").first()
    assert first.region_type == "form" and first.score == pytest.approx(1.0)
    assert r["block_lines"].filter("doc_id = 2").select("block_id").distinct().count() == 2
    assert not r["regions"].filter("doc_id = 3").count()


def test_several_fields_on_a_line(spark):
    assert [(f["key"], f["value"]) for f in L.split_fields("Name: John Date: Monday")] == [("Name", "John"), ("Date", "Monday")]
    assert L.split_fields("Name: John") == []
    r = run(spark, page([(w, 0 + 60 * k, 0) for k, w in enumerate("Name: Johnx Date: Mondy".split())]))
    assert [(x.form_key, x.tokens) for x in r["block_lines"].orderBy("line_id").collect()] == [("Name", 0), ("Date", 0)]


def test_columns(spark):
    pts = spark.createDataFrame([(1, i, float(x)) for i, x in enumerate([0, 10, 200, 210, 500])], "k long, token_id int, cx double")
    assert [r.center for r in L.column_islands(pts, F.lit(50.0), "k").orderBy("center").collect()] == [5, 205]


def test_failures_and_empty(spark):
    rows = page([("a", 0, 0), ("b", 20, 0)]) + [(2, 0, "x", None, 0.0, 1.0, 1.0, "z"), (2, 1, "y", 0.0, 0.0, 1.0, 1.0, "z")]
    df = spark.createDataFrame(rows, SCHEMA).drop("label")
    assert [r.doc_id for r in L.layout_failures(df).collect()] == [2]
    assert {r.doc_id for r in L.analyze(df)["lines"].collect()} == {1}
    assert L.analyze(df.limit(0))["regions"].count() == 0
