"""Peer sums carried through changes equal those of the changed table."""

import random
from decimal import Decimal

from pyspark.sql import functions as F

from abode.operators import peers, reports, snapshot
from abode.plans import joins
from abode.plans.batch_run import PEERS_SUFFIX, RunConfig, read_peers, write_run
from abode.schemas import LISTING_COLUMNS, PEER_STATE, PRICE_TYPE
from abode.sinks import write_raw_jsonl, write_snapshot
from abode.sources import read_snapshot
from tests.helpers import listing_frame, listing_row

CITIES, TYPES = ["A", "B", "", None], ["townhome", "single-detached", None]


def some_rows(rng, ids):
    return [
        listing_row(
            i, f"{i} Main, X", price=rng.choice(["1.10", "250000.35", "9999999999.99", None]) or "0", city=rng.choice(CITIES),
            ptype=rng.choice(TYPES), sqft_range=rng.choice(["0-1499", "1500-1999"]), age_range=rng.choice(["0-5", "26+", None]),
        )
        for i in ids
    ]


def with_null_prices(df):
    return df.withColumn("listing_price", F.when(F.col("listing_id") % 5 != 0, F.col("listing_price")))


def same(a, b):
    return sorted(map(str, a.select(*PEER_STATE.fieldNames()).collect())) == sorted(map(str, b.select(*PEER_STATE.fieldNames()).collect()))


def test_random_changes(spark, monkeypatch):
    rng = random.Random(7)
    table = with_null_prices(listing_frame(spark, some_rows(rng, range(1, 60))))
    new = with_null_prices(listing_frame(spark, some_rows(rng, range(60, 90))))
    gone = spark.createDataFrame([(i,) for i in (3, 5, 7, 7, 61, 64, 65, 999)], "listing_id long")
    prices = [(8, "5.00"), (8, "6.00"), (10, "7.00"), (70, None), (72, "1.00"), (3, "4.00"), (777, "1.00")]
    delta = spark.createDataFrame([(i, p and Decimal(p)) for i, p in prices], "listing_id long, listing_price decimal(12,2)")
    inserted = table.unionByName(new)
    after = inserted.join(gone, "listing_id", "left_anti")
    best = delta.groupBy("listing_id").agg(F.max("listing_price").alias("p"))
    after = after.join(best.withColumn("hit", F.lit(True)), "listing_id", "left")
    after = after.withColumn("listing_price", F.when(F.col("hit"), F.col("p")).otherwise(F.col("listing_price"))).select(*LISTING_COLUMNS)
    want = peers.peer_state(after)
    for bound in (None, 0):
        if bound is not None:
            monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", bound)
        deleted, repriced = peers.changes_by_key(inserted, gone, delta)
        got = peers.apply_changes(peers.peer_state(table), peers.peer_changes(new, deleted, repriced))
        assert same(got, want) and want.count() > 10
    # an emptied table leaves no groups
    none = inserted.limit(0).withColumn("new_price", F.col("listing_price"))
    left = peers.apply_changes(peers.peer_state(table), peers.peer_changes(inserted.limit(0), table, none))
    assert left.count() == 0 and peers.peer_state(inserted.limit(0)).count() == 0


def test_reports_from_the_sums(spark):
    rng = random.Random(9)
    table = with_null_prices(listing_frame(spark, some_rows(rng, range(1, 120))))
    state = peers.peer_state(table)

    def rows(df):
        return [tuple(r) for r in df.collect()]

    for i in (1, 2, 3, 4, 500):
        address = f"{i} Main, X"
        assert rows(peers.compare_kept(state, table, address, "sqft")) == rows(reports.compare_by_sqft(table, address))
        assert rows(peers.compare_kept(state, table, address, "age")) == rows(reports.compare_by_age(table, address))
        assert rows(peers.overlay_kept(state, table, address, "age")) == rows(reports.overlay_by_age(table, address))
    for kind, column in peers.KINDS.items():
        assert sorted(map(str, rows(peers.price_vs_kept_peers(table, state, kind)))) == sorted(map(str, rows(reports.price_vs_peers(table, column))))


def test_a_question_does_not_scan_the_listings(spark, scratch):
    rows = [listing_row(i, f"{i} Main, Springfield") for i in range(1, 200)]
    path, sums = scratch("t"), scratch("s")
    write_snapshot(listing_frame(spark, rows), path)
    peers.peer_state(read_snapshot(spark, path)).write.parquet(sums)
    df = peers.compare_kept(spark.read.schema(PEER_STATE).parquet(sums), read_snapshot(spark, path), "7 Main, Springfield", "sqft")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "address" in line]
    assert scans and all("EqualTo(address,7 Main, Springfield)" in line for line in scans)
    assert "HashAggregate" not in plan  # averages are there, not worked out


def test_runs_carry_the_sums(spark, scratch):
    """Run after run, the sums beside a snapshot are those of the snapshot, and are not worked out from it."""
    base = scratch("sums")
    rng = random.Random(3)
    first = listing_frame(spark, [(*r[:2], *r[2:]) for r in some_rows(rng, range(1, 80))])
    write_snapshot(first, f"{base}/v0")
    for n in range(3):
        lines = first.where(f"listing_id % 4 = {n}").selectExpr(
            "listing_id as source_id", "cast(listing_id + 1000 as bigint) as street_number", "street_name", "'A' as city",
            "cast(age as double) as age", "cast(sqft as double) as sqft", "cast(list_date as string) as list_date", "property_type",
        )
        write_raw_jsonl(lines, f"{base}/batch{n}")
        cfg = RunConfig(n, 10 + n, "0.03", "0.03")
        write_run(spark, f"{base}/v{n}", f"{base}/batch{n}", f"{base}/v{n + 1}", cfg, peers=True)
        table = read_snapshot(spark, f"{base}/v{n + 1}")
        kept = spark.read.schema(PEER_STATE).parquet(f"{base}/v{n + 1}{PEERS_SUFFIX}")
        assert same(kept, peers.peer_state(table)) and same(read_peers(spark, f"{base}/v{n + 1}"), kept)
    one = spark.createDataFrame([(2, Decimal("5.00"))], ["listing_id", "listing_price"]).withColumn("listing_price", F.col("listing_price").cast(PRICE_TYPE))
    deleted, repriced = peers.changes_by_key(table, one.select("listing_id").limit(0), one)
    after = snapshot.upsert_price(table, one)
    assert same(peers.apply_changes(kept, peers.peer_changes(table.limit(0), deleted, repriced)), peers.peer_state(after))


def test_a_stream_carries_the_sums(spark, scratch):
    from pathlib import Path

    from abode.streaming.file_ingest import IngestConfig, ingest_available, version_path
    from tests.test_streaming import _line

    base = Path(scratch("stream_sums").replace("file:", ""))
    landing = base / "landing"
    landing.mkdir(parents=True)
    cfg = IngestConfig(str(landing), str(base / "out"), str(base / "ckpt"), delete_pct="0.03", update_pct="0.03", peers=True)
    for epoch in range(3):
        lines = [_line(i, 1000 * epoch + i, city=f"C{i % 3}") for i in range(60)] + [_line(99, 5)]
        (landing / f"b{epoch}.json").write_text("\n".join(lines) + "\n")
        ingest_available(spark, cfg)
        out = version_path(cfg.snapshot_root, epoch)
        table = read_snapshot(spark, out)
        assert table.count() > 50 * (epoch + 1)
        assert same(spark.read.schema(PEER_STATE).parquet(out + PEERS_SUFFIX), peers.peer_state(table))
