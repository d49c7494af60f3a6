"""Incremental ingest: each newly arrived JSON-lines batch file becomes one run.

The reference's scheduler hands every run the file generated for it. Here a
file-source stream over the landing folder tracks which files are new (in its
checkpoint), and ``trigger(availableNow=True)`` processes whatever arrived
since the last call and then stops, so a scheduler can call
:func:`ingest_available` on its usual cadence.

Each micro-batch runs :func:`abode.plans.batch_run.plan_run` against the
previous snapshot version and writes version ``v=<epoch>``. The output path is
a function of the epoch, so a re-executed epoch rewrites its own version and
never the one it reads. A stream with a new checkpoint would count epochs from 0
again, also one recreated in the place of an old checkpoint. Versions carry the
stream's own id, which stands in its checkpoint, and a stream with another id is refused.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abode.operators.peers import apply_changes, peer_changes
from abode.plans.batch_run import MARK_SUFFIX, PEERS_SUFFIX, RunConfig, mark_writer, plan_run, read_mark, read_peers, write_mark
from abode.plans.locations import check_outputs
from abode.schemas import LISTINGS, PEER_STATE, RAW_JSON
from abode.sinks import write_snapshot
from abode.sources.files import read_snapshot


@dataclass(frozen=True)
class IngestConfig:
    landing_dir: str  # where raw batch files arrive
    snapshot_root: str  # versions are written to <root>/v=<epoch>
    checkpoint_location: str  # stream progress (which files were taken)
    initial_snapshot: str | None = None  # version read by epoch 0
    delete_seed: int = 88
    update_seed: int = 89
    delete_pct: Decimal | str | float | None = None  # None: drawn per run from the run's seed
    update_pct: Decimal | str | float | None = None
    max_files_per_trigger: int = 1  # one file, one run
    partition_by_city: bool = False
    peers: bool = False  # carry the sums behind the peer averages from version to version


def version_path(root: str, epoch: int) -> str:
    return f"{root.rstrip('/')}/v={epoch}"


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """Id of the stream whose progress the checkpoint holds; a new checkpoint has a new one."""
    text = spark.read.text(f"{checkpoint_location.rstrip('/')}/metadata", wholetext=True)
    return text.select(F.get_json_object("value", "$.id")).first()[0]


def _previous(spark: SparkSession, cfg: IngestConfig, epoch: int) -> tuple[DataFrame, int | None]:
    if epoch > 0:
        path = version_path(cfg.snapshot_root, epoch - 1)
    elif cfg.initial_snapshot:
        path = cfg.initial_snapshot
    else:
        return spark.createDataFrame([], LISTINGS), 0
    return read_snapshot(spark, path), read_mark(spark, path)


def _run_seed(base: int, epoch: int) -> int:
    # every run draws a different sample; the same epoch always the same one
    return base * 1_000_003 + epoch


def process_batch(cfg: IngestConfig):
    def handle(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        out, writer = version_path(cfg.snapshot_root, epoch), stream_id(spark, cfg.checkpoint_location)
        if mark_writer(spark, out) not in (None, writer):
            raise RuntimeError(f"{out} was written by another checkpoint; use that one or a new snapshot_root")
        before = version_path(cfg.snapshot_root, epoch - 1) if epoch else cfg.initial_snapshot
        inputs = {"the version read": before, "landing_dir": cfg.landing_dir, "checkpoint_location": cfg.checkpoint_location}
        outputs = {"the version written": out, "its id mark": out + MARK_SUFFIX, "its peer sums": out + PEERS_SUFFIX}
        check_outputs(spark, inputs, outputs)
        current, mark = _previous(spark, cfg, epoch)
        run_cfg = RunConfig(
            _run_seed(cfg.delete_seed, epoch),
            _run_seed(cfg.update_seed, epoch),
            cfg.delete_pct,
            cfg.update_pct,
        )
        result, changes = plan_run(current, batch, mark, run_cfg)
        # overwrite only this epoch's own version: a retried epoch is idempotent
        write_mark(spark, out, changes.new_mark, writer)
        if cfg.peers:
            sums = read_peers(spark, before) if before else spark.createDataFrame([], PEER_STATE)
            sums = apply_changes(sums, peer_changes(changes.new_rows, changes.deleted_rows, changes.repriced_rows))
            sums.write.mode("overwrite").parquet(out + PEERS_SUFFIX)
        write_snapshot(result, out, partition_by_city=cfg.partition_by_city, mode="overwrite")

    return handle


def ingest_available(spark: SparkSession, cfg: IngestConfig) -> None:
    """Process every batch file that arrived since the previous call, then stop."""
    reader = spark.readStream.schema(RAW_JSON).option("mode", "FAILFAST")
    reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    query = (
        reader.json(cfg.landing_dir)
        .writeStream.foreachBatch(process_batch(cfg))
        .option("checkpointLocation", cfg.checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
