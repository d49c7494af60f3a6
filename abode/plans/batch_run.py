"""One batch run: enrich -> insert-ignore -> churn delete -> churn re-price.

The step order is the reference's (delete before re-price, so the re-priced
sample is drawn from the table after deletes). Every step is a DataFrame
transform; the run produces one snapshot, written once to a new path by
:func:`write_run`.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abode import functions as AF
from abode.operators.churn import churn_cuts, draw_pct
from abode.operators.enrich import enrich
from abode.operators.peers import apply_changes, peer_changes, peer_state
from abode.operators.snapshot import high_water_mark, new_listings
from abode.plans.locations import check_outputs, path_exists, same_path  # noqa: F401 - same_path for callers
from abode.schemas import LISTING_COLUMNS, PEER_STATE, PRICE_TYPE
from abode.sinks import write_snapshot
from abode.sources.files import read_raw_jsonl, read_snapshot, split_raw_jsonl

MARK_SUFFIX = ".id_mark"  # the mark stands beside the snapshot's folder and is there before it
PEERS_SUFFIX = ".peers"  # so do the sums behind its peer averages


@dataclass(frozen=True)
class RunConfig:
    delete_seed: int
    update_seed: int
    delete_pct: Decimal | str | float | None = None  # None: drawn from the seed, as the reference does
    update_pct: Decimal | str | float | None = None


@dataclass(frozen=True)
class RunChanges:
    """What one run changes, as DataFrames much smaller than the table.

    Applied in this order they turn the current table into the new one:
    insert ``new_rows``, delete ``deleted_keys`` (which may include rows
    inserted by the same run), then set ``price_delta``. A table format with
    ``MERGE`` can apply them in place instead of rewriting the snapshot.
    ``deleted_rows`` and ``repriced_rows`` are the same changes with all columns
    as they were before, ``new_price`` beside them: what sums kept over the table need.
    """

    new_rows: DataFrame
    deleted_rows: DataFrame
    repriced_rows: DataFrame
    new_mark: int

    @property
    def deleted_keys(self) -> DataFrame:
        return self.deleted_rows.select("listing_id")

    @property
    def price_delta(self) -> DataFrame:
        return self.repriced_rows.select("listing_id", F.col("new_price").alias("listing_price"))


def plan_run(
    current: DataFrame, raw_batch: DataFrame, id_mark: int | None, config: RunConfig
) -> tuple[DataFrame, RunChanges]:
    """New snapshot (lazy) and the run's change sets.

    Both samples are found with :func:`abode.operators.churn.churn_cuts`, in one
    pass over the keys, so both the snapshot and the change sets are plain filters and projections
    of the same inputs: no join against the table is needed for either.
    """
    enriched = enrich(raw_batch)
    mark = high_water_mark(current) if id_mark is None else int(id_mark)
    fresh, added = new_listings(current, enriched, mark)
    inserted = current.select(*LISTING_COLUMNS).unionByName(fresh)
    delete_pct = config.delete_pct if config.delete_pct is not None else draw_pct(config.delete_seed)
    update_pct = config.update_pct if config.update_pct is not None else draw_pct(config.update_seed)

    delete_cut, update_cut = churn_cuts(inserted, config.delete_seed, delete_pct, config.update_seed, update_pct)
    deleted, updated = delete_cut.predicate(), update_cut.predicate()
    after_delete = inserted.filter(~deleted)
    new_price = AF.repriced("listing_price", AF.reprice_factor("listing_id", config.update_seed))
    snapshot = after_delete.withColumn(
        "listing_price", F.when(updated, new_price).otherwise(F.col("listing_price"))
    )
    changes = RunChanges(
        new_rows=fresh,
        deleted_rows=inserted.filter(deleted),
        repriced_rows=after_delete.filter(updated).withColumn("new_price", new_price.cast(PRICE_TYPE)),
        new_mark=mark + added,
    )
    return snapshot, changes


def write_changes(changes: RunChanges, path: str) -> None:
    """Write a run's change sets as Parquet (``new_rows``, ``deleted_keys``,
    ``price_delta`` under ``path``), for a store that applies them in place
    the way the reference's jobs applied inserts, deletes and upserts."""
    root = path.rstrip("/")
    changes.new_rows.write.mode("errorifexists").parquet(f"{root}/new_rows")
    changes.deleted_keys.write.mode("errorifexists").parquet(f"{root}/deleted_keys")
    changes.price_delta.write.mode("errorifexists").parquet(f"{root}/price_delta")


def run_batch(
    current: DataFrame, raw_batch: DataFrame, id_mark: int | None, config: RunConfig
) -> tuple[DataFrame, int]:
    """New snapshot (lazy) from the current one and a raw batch, and the new
    id mark: the largest id issued, even if churn deleted that row again."""
    snapshot, changes = plan_run(current, raw_batch, id_mark, config)
    return snapshot, changes.new_mark


def run_changes(
    current: DataFrame, raw_batch: DataFrame, id_mark: int | None, config: RunConfig
) -> RunChanges:
    """Only the change sets of a run (see :class:`RunChanges`)."""
    return plan_run(current, raw_batch, id_mark, config)[1]


def read_mark(spark: SparkSession, snapshot_path: str) -> int | None:
    """The id mark stored next to a snapshot, or None if none was ever written.

    A mark that is there but can't be read is an error: without it, ids of
    deleted rows would be issued again.
    """
    row = _mark_row(spark, snapshot_path)
    return None if row is None else int(row["id_mark"])


def mark_writer(spark: SparkSession, snapshot_path: str) -> str | None:
    """Who wrote a snapshot's mark (see :func:`write_mark`), or None without a mark."""
    row = _mark_row(spark, snapshot_path)
    return None if row is None else row["writer"]


def _mark_row(spark: SparkSession, snapshot_path: str):
    try:
        marks = spark.read.schema("id_mark bigint, writer string").parquet(snapshot_path.rstrip("/") + MARK_SUFFIX)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    rows = marks.collect()
    if len(rows) != 1 or rows[0]["id_mark"] is None:
        raise RuntimeError(f"damaged id mark beside {snapshot_path}")
    return rows[0]


def write_mark(spark: SparkSession, snapshot_path: str, mark: int, writer: str = "run") -> None:
    """Store the id mark. Called before the snapshot's data is written, so that
    a snapshot never stands without its mark, wherever a run breaks off."""
    row = spark.range(1).select(F.lit(mark).cast("bigint").alias("id_mark"), F.lit(writer).alias("writer"))
    row.write.mode("overwrite").parquet(snapshot_path.rstrip("/") + MARK_SUFFIX)


def read_peers(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """Sums behind the peer averages of a snapshot: as stored beside it, or worked out if they aren't."""
    path = snapshot_path.rstrip("/") + PEERS_SUFFIX
    if path_exists(spark, path):
        return spark.read.schema(PEER_STATE).parquet(path)
    return peer_state(read_snapshot(spark, snapshot_path))


def write_run(
    spark: SparkSession,
    snapshot_in: str,
    batch_path: str,
    snapshot_out: str,
    config: RunConfig,
    partition_by_city: bool = False,
    mode: str = "errorifexists",
    archive_out: str | None = None,
    peers: bool = False,
    rejects_out: str | None = None,
) -> int:
    """Read snapshot and JSON batch, run, write the new snapshot and id mark.

    The id mark (largest id ever issued) is stored next to the data so ids of
    deleted rows are never issued again. With ``archive_out`` the enriched
    batch is also kept as a Parquet archive. With ``peers`` the sums behind the
    peer averages are brought from those beside ``snapshot_in`` to those of the new
    snapshot by the run's changes (see :mod:`abode.operators.peers`). ``mode`` holds for all outputs, so
    a retry with ``mode="overwrite"`` can repeat a run that broke off anywhere.
    Before anything is written, every output is compared by its real location with the
    inputs and the other outputs, and must not exist unless ``mode`` says so.
    Returns the new mark.
    """

    def beside(path: str, suffix: str) -> str:
        return path.rstrip("/") + suffix

    outputs = {
        "snapshot_out": snapshot_out,
        "its id mark": beside(snapshot_out, MARK_SUFFIX),
        "its peer sums": beside(snapshot_out, PEERS_SUFFIX),
        "archive_out": archive_out,
        "rejects_out": rejects_out,
    }
    inputs = {
        "snapshot_in": snapshot_in,
        "the id mark read": beside(snapshot_in, MARK_SUFFIX),
        "the peer sums read": beside(snapshot_in, PEERS_SUFFIX),
        "batch_path": batch_path,
    }
    check_outputs(spark, inputs, outputs)
    if mode == "errorifexists":
        for name, path in (("snapshot_out", snapshot_out), ("archive_out", archive_out), ("rejects_out", rejects_out)):
            if path and path_exists(spark, path):
                raise FileExistsError(f"{name} {path} exists; a run writes a new path, or repeats one with mode='overwrite'")
    current = read_snapshot(spark, snapshot_in)
    stored = read_mark(spark, snapshot_in)
    mark = stored if stored is not None else high_water_mark(current)
    if rejects_out:
        raw_batch, rejects = split_raw_jsonl(spark, batch_path)
        rejects.write.mode(mode).parquet(rejects_out)
    else:
        raw_batch = read_raw_jsonl(spark, batch_path)
    if archive_out:
        write_snapshot(enrich(raw_batch), archive_out, sort_by_address=False, mode=mode)
    result, changes = plan_run(current, raw_batch, mark, config)
    write_mark(spark, snapshot_out, changes.new_mark)
    if peers:
        sums = apply_changes(read_peers(spark, snapshot_in), peer_changes(changes.new_rows, changes.deleted_rows, changes.repriced_rows))
        sums.write.mode("overwrite").parquet(beside(snapshot_out, PEERS_SUFFIX))
    write_snapshot(result, snapshot_out, partition_by_city=partition_by_city, mode=mode)
    return changes.new_mark
