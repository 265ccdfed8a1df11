"""Writers: labels and questions as CSV, graphs and statistics as JSON, images as files. All write from the executors."""

from __future__ import annotations

from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, by: str | None = None, one_file: bool = False, mark: bool = False) -> None:
    """CSV with a header, fields quoted as needed, one folder for each value of ``by``; ``mark`` opens the header with a byte-order mark."""
    if mark and df.columns:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    df = df.coalesce(1) if one_file else df
    writer = df.write.mode("overwrite").option("header", "true").option("escape", '"').option("quote", '"')
    (writer.partitionBy(by) if by else writer).csv(path)


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """One JSON object a row; nulls are kept as fields."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path (local, shared, or an object store by its URI) and the path within it."""
    return fs.FileSystem.from_uri(path if "://" in path else Path(path.removeprefix("file:")).absolute().as_uri())


def _put(store: fs.FileSystem, target: str, content: bytes) -> None:
    """A file that is whole or not there: it is written beside its name and moved. A task that runs again writes the same."""
    store.create_dir(target.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(f"{target}.part") as out:
        out.write(content)
    store.move(f"{target}.part", target)


def write_documents(df: DataFrame, path: str, name: str, json: str) -> None:
    """One file for each row, named by a column, in a folder that all executors share."""
    def put(rows) -> None:
        store, folder = _store(path)
        for r in rows:
            _put(store, f"{folder}/{r[0]}.json", r[1].encode())

    df.select(F.col(name).cast("string"), json).foreachPartition(put)


def write_images(df: DataFrame, path: str, split: str, name: str, content: str) -> None:
    """Image bytes as ``{split}/{name}``; rows without bytes are left out, files that exist stay as they are."""
    def put(rows) -> None:
        store, folder = _store(path)
        for s, n, b in rows:
            target = f"{folder}/{s}/{n}"
            if b is not None and store.get_file_info(target).type == fs.FileType.NotFound:
                _put(store, target, bytes(b))

    df.filter(F.col(content).isNotNull()).dropDuplicates([split, name]).select(split, name, content).foreachPartition(put)


def question_batches(qas: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Questions of each document as one nested row."""
    rest = [c for c in qas.columns if c != doc]
    return qas.groupBy(F.col(doc).alias("source_document")).agg(F.count("*").alias("num_qas"), F.array_sort(F.collect_list(F.struct("idx", *(c for c in rest if c != "idx")))).alias("qas"))


def batch_document(qas: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Totals of a batch, as one row; its documents are those of ``question_batches``, a row each, as a batch may hold any number."""
    return qas.agg(F.count_distinct(doc).alias("total_documents"), F.count("*").alias("total_qas"))
