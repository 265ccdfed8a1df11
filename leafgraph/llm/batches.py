"""Arrow batches through Python functions: columns in as lists, columns out as lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "float": pa.float32(), "boolean": pa.bool_(), "binary": pa.binary()}


def arrow_type(ddl: str) -> pa.DataType:
    ddl = ddl.strip()
    if ddl.startswith("array<"):
        return pa.list_(arrow_type(ddl[6:-1]))
    return _KINDS[ddl]


def arrow_schema(ddl: str) -> pa.Schema:
    """Schema of ``name type, ...`` with simple types and arrays of them."""
    return pa.schema([(name, arrow_type(kind)) for name, kind in (part.strip().split(" ", 1) for part in ddl.split(","))])


def map_columns(df: DataFrame, columns: dict[str, Column | str], make: Callable[[], Callable[..., dict[str, list]]], ddl: str) -> DataFrame:
    """Rows of ``ddl``, made from the named columns. ``make`` runs once a task and gives the function that is called with each batch's lists.

    Only the named columns are read, so other columns, whatever their names, change nothing."""
    types = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            out = fn(*(c.to_pylist() for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in types], schema=types)
        finish = getattr(fn, "finish", None)
        for out in finish() if finish else ():
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in types], schema=types)

    return df.select(*((F.col(c) if isinstance(c, str) else c).alias(k) for k, c in columns.items())).mapInArrow(run, ddl)
