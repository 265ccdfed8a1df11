import itertools
import os
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafgraph.llm.packing import RANKS, fill_report, fullest, minimum_slack, pack

needs_ranks = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary file")


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 15), st.integers(1, 2), max_size=5), st.integers(1, 40))
def test_fullest_is_brute_force(counts, room):
    lengths = sorted(counts, reverse=True)
    items = [x for x in lengths for _ in range(counts[x])]
    best = max((s for k in range(len(items) + 1) for c in itertools.combinations(items, k) if (s := sum(c)) <= room), default=0)
    taken = fullest(lengths, [counts[x] for x in lengths], room)
    assert sum(lengths[k] for k in taken) == best and all(taken.count(k) <= counts[lengths[k]] for k in taken)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=400))
def test_containers_hold(sizes):
    out = minimum_slack(np.array(sizes), 50)
    used = np.bincount(out, sizes)
    assert used.max() <= 50 and (used > 0).all() and len(out) == len(sizes)


@needs_ranks
def test_pack(spark):
    docs = [(i, "word " * (i % 37), "x") for i in range(400)] + [(900, None, "x"), (901, "", "x"), (902, "long text " * 5000, "x"), (None, "a b c", "x"), (3, "word " * 3, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, container string").repartition(3)
    caps = spark.createDataFrame([("s", 64), ("m", 256), ("m", 256), ("bad", None), ("zero", 0)], "capacity_name string, capacity_tokens int")
    rows = pack(df, caps, group_rows=100).collect()
    for name, room in (("s", 64), ("m", 256)):
        mine = [r for r in rows if r.capacity_name == name]
        used, total = defaultdict(int), defaultdict(int)
        for r in mine:
            used[r.container] += r.tokens
            total[r.doc_id] += r.tokens
        assert max(used.values()) <= room and len([r for r in mine if r.piece == 0]) == len(docs)
        assert total[902] == 10001 or total[902] == 10000
        assert all(r.tokens == room for r in mine if r.doc_id == 902 and r.piece < max(x.piece for x in mine if x.doc_id == 902))
        assert {r.doc_id for r in mine if r.piece > 0} == {902}
        assert sum(used.values()) / room / len(used) > 0.9
    assert {r.capacity_name for r in rows} == {"s", "m"}
    report = {r.capacity_name: r for r in fill_report(pack(df, caps, group_rows=100)).collect()}
    assert 0.9 < report["s"].fill <= 1
    assert pack(df.limit(0), caps).count() == 0 and pack(df, caps.limit(0)).count() == 0
