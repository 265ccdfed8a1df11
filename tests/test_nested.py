import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafgraph.operators.nested import _elements, _links, graph_links, graph_tables, json_elements


def links(*payloads):
    cols = _links(list(range(len(payloads))), list(payloads))
    return set(zip(*cols.values()))


GRAPH = {"nodes": [{"node_id": 3, "bbox": [[1, 2], [5, 2], [5, 9], [1, 9]]}, {"region_type": "a \\ \" ]},"}], "edges": [{"source": "3", "target": 1}], "adjacency": {"3": [1, 1]}, "metadata": {"num_nodes": 2}}
EXPECTED = {("document", 0, 2, -1), ("node", 0, 3, -1), ("node", 1, 1, -1), ("edge", 0, 3, 1), ("neighbor", 0, 3, 1), ("neighbor", 1, 3, 1)}


@pytest.mark.parametrize("wrap", [lambda g: json.dumps(g), lambda g: "﻿" + json.dumps(g, indent=2), lambda g: json.dumps(json.dumps(g)), lambda g: json.dumps({"success": True, "data": g}), lambda g: json.dumps({"graph": {k: g[k] for k in ("nodes", "edges", "adjacency")}, "metadata": g["metadata"]})])
def test_shapes(wrap):
    assert {x[2:] for x in links(wrap(GRAPH))} == EXPECTED


def test_batch_keeps_places_of_errors():
    got = links(json.dumps({"documents": [{"success": False, "error": "x"}, GRAPH]}))
    assert {x[1] for x in got} == {1} and {x[2:] for x in got} == EXPECTED


@pytest.mark.parametrize("payload", [None, "", "  ", "{", json.dumps(GRAPH)[:-5], json.dumps({"success": False, "error": "e"}), '{"nodes": [1,,2]}', '{"nodes": [}]', "null", "12", '"x', '{"nodes": tru}'])
def test_unreadable_gives_nothing(payload):
    assert links(payload, json.dumps(GRAPH)) == {(1, 0, *x) for x in EXPECTED}


def test_adjacency_list_and_odd_fields():
    doc = {"nodes": [None, {"node_id": None}, {"node_id": "7"}], "edges": None, "adjacency": [{"node": 7, "neighbors": [1, None, 2]}, {"node": 8}]}
    assert {x[2:] for x in links(json.dumps(doc))} == {("document", 0, -1, -1), ("node", 1, 1, -1), ("node", 2, 7, -1), ("neighbor", 0, 7, 1), ("neighbor", 2, 7, 2)}


values = st.recursive(st.none() | st.booleans() | st.integers(-99, 99) | st.text(max_size=6), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text(max_size=4), x, max_size=4), max_leaves=25)


def tree(v, key=None, pos=0, depth=0):
    yield key, pos, depth, "object" if isinstance(v, dict) else "array" if isinstance(v, list) else "value"
    for i, (k, x) in enumerate(v.items() if isinstance(v, dict) else ((None, x) for x in v) if isinstance(v, list) else ()):
        yield from tree(x, k, i, depth + 1)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(values, max_size=3) | st.dictionaries(st.text(max_size=3), values, max_size=4), min_size=1, max_size=4))
def test_elements_match_a_plain_walk(docs):
    got = _elements(list(range(len(docs))), [json.dumps(d, ensure_ascii=True) for d in docs])
    shape = [(r, p, d, k) for r, p, d, k in zip(got["record_id"], got["pos"], got["depth"], got["kind"])]
    assert shape == [(i, pos, depth, kind) for i, d in enumerate(docs) for _, pos, depth, kind in tree(d)]
    keys = [k for k in got["key"]]
    plain = [json.dumps(k)[1:-1] or None if k is not None else None for d in docs for k, *_ in tree(d)]
    assert keys == plain


def test_on_spark(spark):
    df = spark.createDataFrame([(1, json.dumps(GRAPH), "x"), (2, None, "y")], "record_id long, payload string, pos string")
    assert {tuple(r)[2:] for r in graph_links(df).collect()} == EXPECTED
    tables = graph_tables(df)
    node = tables["nodes"].filter("pos = 0").first()
    assert (node.xmin, node.ymin, node.xmax, node.ymax) == (1, 2, 5, 9)
    assert tables["edges"].count() == 1 and tables["documents"].count() == 1 and tables["neighbors"].count() == 2
    assert json_elements(df).filter("parent = -1").count() == 1
    empty = df.limit(0)
    assert graph_links(empty).count() == 0 and json_elements(empty).count() == 0
