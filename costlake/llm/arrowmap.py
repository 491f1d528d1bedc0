"""Map work over Arrow batches in slices of few rows and bytes, so that memory follows the longest texts and not the batch size."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Rows of a slice at most, and bytes of strings after which it ends; a longer text is a slice of its own.
SLICE, SLICE_BYTES = 256, 4 << 20
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once an application, so that they need no copy of the repository."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="costlake-"), f"{os.path.basename(top)}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def arrow_schema(schema: str) -> pa.Schema:
    """The fields of "name type, ..." as an Arrow schema, so that a slice with nothing but nulls in a column keeps its type."""
    return pa.schema([(name, ARROW[kind]) for name, kind in (field.split() for field in schema.split(","))])


def slices(batch: pa.RecordBatch, rows: int = SLICE, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in slices of at most rows rows, which end with the row that brings their strings to most bytes."""
    strings = [c for c in batch.columns if pa.types.is_string(c.type)]
    size = np.zeros(batch.num_rows, dtype=np.int64)
    for column in strings:
        size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        stop = min(at + rows, int(np.searchsorted(ends, before + most)) + 1, batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop


def map_slices(df: DataFrame, make: Callable[[], Callable[..., dict]], schema: str, rows: int = SLICE) -> DataFrame:
    """Apply make()(*columns as lists) -> dict of columns to slices of df; make runs once a task."""
    width, target = len(df.columns), arrow_schema(schema)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, rows):
                out = work(*(part.column(i).to_pylist() for i in range(width)))
                yield pa.RecordBatch.from_pydict({n: out[n] for n in target.names}, schema=target)

    return df.mapInArrow(run, schema)


def filter_slices(df: DataFrame, make: Callable[[], Callable[[list], list[bool]]], column: str) -> DataFrame:
    """Rows of df, all columns as they are, for which make()(values of column) is true; make runs once a task."""
    place = df.columns.index(column)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(keep(part.column(place).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)
