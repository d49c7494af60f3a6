"""Lineage cuts into the shared checkpoint folder.

A reliable checkpoint writes the frame once to ``spark.checkpoint.dir`` and
re-reads it with the same partitioning and in-partition order, so anything
derived from partition positions (generated ids) cannot shift when a task is
retried after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

from abode.session import ensure_checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """:func:`materialize`, and aggregates of the rows counted while they are written.

    Saves the job that would read them again for a count. Metrics of a frame that the optimizer
    finds to be empty are missing; read them with a default.
    """
    seen = Observation()
    out = materialize(df.observe(seen, *[column.alias(name) for name, column in metrics.items()]))
    return out, dict(seen.get)
