"""Arrow batches through a Python function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from quire.session import ship

TEXT, INT, LONG, REAL, FLAG = pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.bool_()


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: pa.Schema) -> DataFrame:
    """mapInArrow with state of its own for each task: make() gives the function of a batch. Empty batches are left out."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = None
        for b in batches:
            if b.num_rows:
                f = f or make()
                if (out := f(b)).num_rows:
                    yield out

    return df.mapInArrow(run, from_arrow_schema(schema))


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """Columns, each a list or an Arrow array, as a batch."""
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def rows_batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return batch(schema, [list(c) for c in zip(*rows)] if rows else [[] for _ in schema])
