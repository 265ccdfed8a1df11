"""Connected components within documents: the label of a vertex is the smallest id of its component.

Two ways give the same labels. Documents of up to ``local_edges`` edges (pages have hundreds) go through union-find, streamed document by
document from sorted partitions, one shuffle. Larger ones go through min-label propagation with pointer jumping as DataFrame rounds, each
written to the shared folder, so no single document has to fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.sources.tables import written


def _roots(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """Smallest member of the component of each vertex that has an edge."""
    up: dict[int, int] = {}

    def root(v: int) -> int:
        path = []
        while (u := up.setdefault(v, v)) != v:
            path.append(v)
            v = u
        for p in path:
            up[p] = v
        return v

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {v: root(v) for v in list(up)}


def _streamed(edges: DataFrame) -> DataFrame:
    """(doc_id, a, b) to (doc_id, id, label); a document's edges lie together in one partition."""
    kind = edges.schema["doc_id"].dataType.simpleString()
    key = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())
    types = pa.schema([("doc_id", key), ("id", pa.int64()), ("label", pa.int64())])

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, ids, labels = [], [], []
        for doc, group in groupby(rows(batches), key=lambda r: r[0]):
            for v, r in _roots([(a, b) for _, a, b in group]).items():
                docs.append(doc)
                ids.append(v)
                labels.append(r)
            if len(docs) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(docs, key), pa.array(ids, pa.int64()), pa.array(labels, pa.int64())], schema=types)
                docs, ids, labels = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(docs, key), pa.array(ids, pa.int64()), pa.array(labels, pa.int64())], schema=types)

    return edges.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(run, f"doc_id {kind}, id long, label long")


def propagate(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The same labels by rounds of joins: each vertex takes the least label around it, then its label's label."""
    both = written(edges.select("doc_id", "a", "b").unionByName(edges.select("doc_id", F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("doc_id", F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    for _ in range(most_rounds):
        around = both.join(labels.withColumnRenamed("id", "b"), ["doc_id", "b"]).groupBy("doc_id", F.col("a").alias("id")).agg(F.min("label").alias("near"))
        stepped = labels.join(around, ["doc_id", "id"]).select("doc_id", "id", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        far = labels.select("doc_id", F.col("id").alias("label"), F.col("label").alias("far"))
        jumped = stepped.join(far, ["doc_id", "label"], "left").select("doc_id", "id", F.least("label", F.coalesce("far", "label")).alias("label"), "was")
        jumped = written(jumped, "labels")
        labels = jumped.drop("was")
        if not jumped.filter("label <> was").limit(1).count():
            return labels
    raise RuntimeError("components did not settle")


def components(vertices: DataFrame, edges: DataFrame, local_edges: int = 2_000_000) -> DataFrame:
    """Rows (doc_id, id, label) for all vertices; edges are (doc_id, a, b) in either direction. Vertices without an edge label themselves."""
    edges = written(edges.select("doc_id", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "pairs")
    large = edges.groupBy("doc_id").agg(F.count("*").alias("n")).filter(F.col("n") > local_edges).select("doc_id")
    if large.limit(1).count():
        large = written(large, "large")
        found = _streamed(edges.join(large, "doc_id", "left_anti")).unionByName(propagate(edges.join(large, "doc_id")))
    else:
        found = _streamed(edges)
    ids = vertices.select("doc_id", F.col("id").cast("long").alias("id"))
    return ids.join(found, ["doc_id", "id"], "left").select("doc_id", "id", F.coalesce("label", "id").alias("label"))
