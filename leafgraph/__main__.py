"""Questions of stored graph documents: ``spark-submit --py-files ... leafgraph/__main__.py --doc PATH --out PATH``, or ``python -m leafgraph``."""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from leafgraph.config import QAConfig
from leafgraph.operators.stored import questions_of_payloads
from leafgraph.sources.dataset import read_json_documents
from leafgraph.sources.ship import ship
from leafgraph.sources.sinks import question_batches, write_json


def main(arguments: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--doc", required=True, help="a graph document, or a folder of them")
    ap.add_argument("--out", default="qas_out", help="folder of the result: one JSON object a document")
    ap.add_argument("--max_qas", type=int, default=QAConfig.max_per_document)
    a = ap.parse_args(arguments)
    spark = SparkSession.builder.appName("questions").getOrCreate()
    ship(spark)
    docs = read_json_documents(spark, a.doc).withColumn("record_id", F.xxhash64("file_name"))
    qas = questions_of_payloads(docs, config=replace(QAConfig(), max_per_document=a.max_qas))
    named = qas.join(docs.select(F.col("record_id").cast("string").alias("doc_id"), "file_name"), "doc_id").drop("doc_id")
    write_json(question_batches(named, "file_name"), a.out)


if __name__ == "__main__":
    main()
