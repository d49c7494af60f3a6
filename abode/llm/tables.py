"""Stored steps of the operators that run many jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from abode.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    before = spark.conf.get(key, None)
    if value is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if value is not None:
            spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def few_arrow_rows(spark: SparkSession, rows: int, size: int | None = None) -> Iterator[None]:
    """Jobs that run meanwhile hand ``rows`` rows to Python at a time, or fewer if the session says so.

    They end a batch at ``size`` bytes, too, but where the session has a size of its own.
    """
    own = int(spark.conf.get(ARROW_ROWS, "0") or 0)
    size = None if spark.conf.get(ARROW_BYTES, None) else size
    with _setting(spark, ARROW_ROWS, str(rows) if own <= 0 else str(min(rows, own))), _setting(spark, ARROW_BYTES, size and str(size)):
        yield


def stored(df: DataFrame, name: str, codec: str | None = None, arrow_rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again, compressed by ``codec`` or as the session says.

    What comes after reads the table alone, so the shuffle files of the write
    are dropped when it ends, not when the driver next collects garbage. Where rows are large, ``arrow_rows``
    says how many of them go to Python at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _setting(spark, CLEANUP, "true"), _setting(spark, ARROW_ROWS, arrow_rows and str(arrow_rows)):
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many ``_`` before it as make it no column of ``df``, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def forget(table: DataFrame) -> None:
    """Deletes what :func:`stored` wrote, once nothing that is still to run reads it."""
    spark = table.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
