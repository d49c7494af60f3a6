"""Arrow batches in and out of the operators that run Python in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

SLICE_ROWS = 512


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | dict], schema: pa.Schema) -> DataFrame:
    """``work`` over slices of a few hundred rows, so that a task holds few long texts at once.

    ``work`` returns columns by name; they are laid out by ``schema``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                out = work(batch.slice(at, SLICE_ROWS))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return df.mapInArrow(run, from_arrow_schema(schema))
