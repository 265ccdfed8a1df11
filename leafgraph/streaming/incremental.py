"""Incremental processing: new token files to graph documents, each page once.

All operators are keyed by page, so a file source with a checkpoint and a batch function for each arrival is all that is needed: no
windows, no watermarks. A page whose valid output is there already is left out, one with a corrupt output is done again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from leafgraph.operators import graph as G
from leafgraph.operators import layout as L

TOKENS = StructType(
    [StructField("doc_id", StringType()), StructField("token_id", IntegerType()), StructField("text", StringType()), StructField("confidence", DoubleType())]
    + [StructField(c, DoubleType()) for c in ("xmin", "ymin", "xmax", "ymax")]
)


def valid_document(payload: Column) -> Column:
    """Whether a stored graph is usable: it parses, has all parts, and holds a node."""
    doc = F.from_json(payload, "nodes array<string>, edges array<string>, adjacency string, metadata string")
    return F.coalesce(F.size(doc["nodes"]) > 0, F.lit(False)) & doc["edges"].isNotNull() & doc["adjacency"].isNotNull() & doc["metadata"].isNotNull()


def done_pages(outputs: DataFrame, key: str = "doc_id", payload: str = "payload") -> DataFrame:
    return outputs.filter(valid_document(F.col(payload))).select(key).distinct()


def graphs_of(tokens: DataFrame) -> DataFrame:
    """One graph document (doc_id, payload) for each page of tokens that can be laid out and has a region."""
    nodes = L.region_nodes(L.analyze(tokens))
    docs = G.graph_documents(nodes, G.graph_edges(nodes))
    body = F.to_json(F.struct("version", "nodes", "edges", "adjacency", "metadata"))
    return docs.select("doc_id", body.alias("payload"))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is any output yet. Other failures of the file system are raised: taken for absence, all pages would be done again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(at) and any(not s.getPath().getName().startswith(("_", ".")) for s in store.listStatus(at))


def process_new(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Reads the token files (JSON lines) that are new, and appends their graphs to a Parquet folder. Ends when all are done.

    The target is read anew in each batch; a batch that is run again after a failure leaves out what it wrote before."""
    def each(batch: DataFrame, _: int) -> None:
        done = done_pages(spark.read.parquet(target)) if exists(spark, target) else batch.select("doc_id").limit(0)
        graphs_of(batch.join(done, "doc_id", "left_anti")).write.mode("append").parquet(target)

    stream = spark.readStream.schema(TOKENS).json(source)
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
