"""Join helpers: broadcast only behind a checked size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.plans.materialize import materialize_counted

# Largest side (measured bytes: fixed widths plus actual string lengths) shipped to every
# executor. Above it the join is a shuffle join with AQE skew splitting.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def row_width(schema: T.StructType) -> int:
    """In-memory bytes per row without the characters of its strings."""
    width = 8
    for field in schema.fields:
        t = field.dataType
        if isinstance(t, T.StringType):
            width += 16
        elif isinstance(t, T.DecimalType):
            width += 8 if t.precision <= 18 else 16
        elif isinstance(t, (T.LongType, T.DoubleType, T.TimestampType, T.TimestampNTZType)):
            width += 8
        elif isinstance(t, (T.IntegerType, T.DateType, T.FloatType)):
            width += 4
        elif isinstance(t, (T.BooleanType, T.ByteType, T.ShortType)):
            width += 2
        else:
            width += 64
    return width


def size_metrics(schema: T.StructType) -> dict[str, Column]:
    """Aggregates behind :func:`measured_bytes`: rows, and characters of the strings as they are."""
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    chars = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in texts), F.lit(0))
    return {"rows": F.count(F.lit(1)), "chars": F.sum(chars.cast("bigint"))}


def measured_bytes(schema: T.StructType, metrics: dict) -> int:
    return metrics.get("rows", 0) * row_width(schema) + (metrics.get("chars") or 0)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df`` and their bytes, string lengths as they are; one aggregate."""
    row = df.agg(*[column.alias(name) for name, column in size_metrics(df.schema).items()]).collect()[0].asDict()
    return row["rows"], measured_bytes(df.schema, row)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    return within_bound(measure(df)[1], max_bytes)


def within_bound(size: int, max_bytes: int | None = None) -> bool:
    return size <= (BROADCAST_MAX_BYTES if max_bytes is None else max_bytes)


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Materialize ``df``, measure it on the way, and broadcast it only when small enough.

    Returns the (materialized) frame, hinted for broadcast when its measured
    bytes are at most ``max_bytes``, and whether the hint was applied. Above the bound the frame is returned unhinted, so the join
    falls back to a shuffle join.
    """
    df, metrics = materialize_counted(df, **size_metrics(df.schema))
    small = within_bound(measured_bytes(df.schema, metrics), max_bytes)
    return (F.broadcast(df) if small else df), small
