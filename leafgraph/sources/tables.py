"""Parquet tables of one directory, and the shared folder for cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_WRITTEN: list[str] = []


def table(spark: SparkSession, directory: str, name: str, *columns: str) -> DataFrame:
    """One table; only the named columns if any are given, so that the scan reads no others."""
    df = spark.read.parquet(f"{directory}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names in ``spark.checkpoint.dir``; where unset, as in tests on one machine, a folder of our own.

    On a cluster it must be set: a folder of one machine isn't there for the others."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="leafgraph-"))
    return context._jsc.sc().getCheckpointDir().get()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A place in the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def drop_written(spark: SparkSession) -> None:
    """Deletes the tables that this application wrote to the shared folder. Results that read them must be stored before."""
    while _WRITTEN:
        at = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder: lost executors lose nothing, and later plans don't compute them again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The rows, written as a compressed table to the shared folder and read again; later reads prune its columns.

    ``by``: a column of few values that later reads filter by; each value then has its own files."""
    path = fresh_path(df.sparkSession, name)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
