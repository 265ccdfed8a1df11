"""Statistics over corpora: batches, graphs, questions, recognition. Each is one partial-then-final hash aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafgraph.functions.tokens import token_type


def _rolled(df: DataFrame, split: str, *aggregates) -> DataFrame:
    """By split and over all; the total's split is ``all``, that of rows without one ``unknown``."""
    rolled = df.rollup(split).agg(F.grouping(split).alias("_all"), *aggregates)
    name = F.when(F.col("_all") == 1, "all").otherwise(F.coalesce(F.col(split), F.lit("unknown")))
    return rolled.withColumn(split, name).drop("_all").withColumnRenamed(split, "split")


def batch_rollup(df: DataFrame, split: str, error: str) -> DataFrame:
    """Processed, succeeded and failed images by split, and over all. An image without an error has succeeded."""
    ok = F.col(error).isNull()
    return _rolled(df, split, F.count("*").alias("processed"), F.count_if(ok).alias("success"), F.count_if(~ok).alias("failed"))


def batch_errors(df: DataFrame, split: str, image: str, error: str) -> DataFrame:
    """The failed images, a row each: a split may have any number of them."""
    return df.filter(F.col(error).isNotNull()).select(F.coalesce(F.col(split), F.lit("unknown")).alias("split"), F.col(image).alias("image_id"), F.col(error).alias("error"))


def dataset_stats(documents: DataFrame, nodes: DataFrame, edges: DataFrame, tokens: DataFrame | None = None) -> DataFrame:
    """Totals and averages over all documents (failed ones, which have no nodes, included), and counts by region type, relation and category.

    ``tokens``: rows with a number of ``tokens`` each."""
    row = lambda what, name, v: F.struct(F.lit(what).alias("what"), name.alias("name"), v.cast("double").alias("v"))
    none = F.lit("")
    totals = documents.agg(F.count("*").alias("documents")).join(F.broadcast(nodes.agg(F.count("*").alias("nodes")))).join(F.broadcast(edges.agg(F.count("*").alias("edges"))))  # one row each
    if tokens is not None:
        totals = totals.join(F.broadcast(tokens.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"))))
    parts = [c for c in ("nodes", "edges", "tokens") if c in totals.columns]
    each = [row(c, none, F.col(c)) for c in ("documents", *parts)] + [row(f"average_{c}", none, F.coalesce(F.try_divide(c, "documents"), F.lit(0.0))) for c in parts]
    out = totals.select(F.inline(F.array(*each)))
    for df, column, what in ((nodes, "region_type", "region_type"), (edges, "relation", "relation"), (edges, "category", "category")):
        counts = df.groupBy(F.coalesce(F.col(column), F.lit("unknown")).alias("name")).agg(F.count("*").cast("double").alias("v"))
        out = out.unionByName(counts.select(F.lit(what).alias("what"), "name", "v"))
    return out


def ranked_shares(counts: DataFrame, value: str, most: int = 10) -> DataFrame:
    """The most frequent values with their percentage of all."""
    total = counts.agg(F.sum("n").alias("_t"))
    ranked = counts.join(F.broadcast(total)).withColumn("percent", F.try_divide(F.col("n") * 100.0, F.col("_t"))).drop("_t")  # one row
    return ranked.orderBy(F.desc("n"), value).limit(most)


def question_rollup(df: DataFrame, split: str, doc: str, failed: str) -> DataFrame:
    """Documents, questions, errors and questions a document by split, and over all."""
    good = ~F.coalesce(F.col(failed), F.lit(False))
    out = _rolled(df, split, F.count_distinct(doc).alias("documents"), F.count_if(good).alias("questions"), F.count_if(~good).alias("errors"))
    return out.withColumn("average", F.round(F.coalesce(F.try_divide("questions", "documents"), F.lit(0.0)), 2))


def question_batch(nodes: DataFrame, edges: DataFrame, qas: DataFrame) -> DataFrame:
    """Nodes, edges and questions of each page."""
    n, e, q = (df.groupBy("doc_id", "page_no").agg(F.count("*").alias(name)) for df, name in ((nodes, "nodes"), (edges, "edges"), (qas, "qas_generated")))
    return n.join(e, ["doc_id", "page_no"], "left").join(q, ["doc_id", "page_no"], "left").fillna(0, ["edges", "qas_generated"])


def batch_summary(batch: DataFrame) -> DataFrame:
    return batch.agg(F.count("*").alias("documents"), F.coalesce(F.sum("qas_generated"), F.lit(0)).alias("questions"), F.avg("qas_generated").alias("average"))


def run_statistics(images: DataFrame, questions: DataFrame) -> DataFrame:
    """The figures of a run, one row (section, split, name, value) each: images by split, questions by split, and their kinds of reasoning."""
    def listed(df: DataFrame, section: str, *names: str) -> DataFrame:
        rows = F.array(*(F.struct(F.lit(section).alias("section"), F.col("split"), F.lit(n).alias("name"), F.col(n).cast("double").alias("value")) for n in names))
        return df.select(F.inline(rows))

    kinds = questions.filter("reasoning_type IS NOT NULL").groupBy("reasoning_type").agg(F.count("*").cast("double").alias("value"))
    kinds = kinds.select(F.lit("reasoning_type").alias("section"), F.lit("all").alias("split"), F.col("reasoning_type").alias("name"), "value")
    done = listed(batch_rollup(images, "split", "error"), "graph_processing", "processed", "success", "failed")
    return done.unionByName(listed(question_rollup(questions, "split", "doc_id", "failed"), "qa_generation", "documents", "questions", "errors", "average")).unionByName(kinds)


def value_shares(df: DataFrame, name: str, value) -> DataFrame:
    counts = df.groupBy(value.alias(name)).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.join(F.broadcast(total)).withColumn("percent", F.try_divide(F.col("n") * 100.0, F.col("_t"))).drop("_t")  # one row


def recognition(tokens: DataFrame, *keys: str) -> DataFrame:
    """Text in reading order, tokens and mean confidence of each document; blank tokens are no tokens."""
    kept = tokens.filter(F.trim("text") != "").withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    ordered = F.array_sort(F.collect_list(F.struct("token_id", "text")))
    out = kept.groupBy(*keys).agg(F.transform(ordered, lambda x: x["text"]).alias("lines"), F.avg("confidence").alias("avg_confidence"))
    return out.select(*keys, F.array_join("lines", "\n").alias("text"), F.size("lines").alias("num_lines"), "avg_confidence")


def token_histogram(df: DataFrame, text) -> DataFrame:
    return df.groupBy(token_type(text).alias("token_type")).agg(F.count("*").alias("n"))


def variants(df: DataFrame, key: str, variant: str, names: list[str], *measures: str) -> DataFrame:
    """Measures of the variants of each key side by side; a given list of names keeps it one pass."""
    return df.groupBy(key).pivot(variant, names).agg(*(F.max(m).alias(m) for m in measures))
