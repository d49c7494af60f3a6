"""Bucketed snapshots: large changes join without an exchange of the table."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abode import catalog
from abode.operators import snapshot
from abode.plans import bucketed
from abode.schemas import LISTING_COLUMNS, PRICE_TYPE
from tests.conftest import SF_SMALL
from tests.helpers import listing_frame, listing_row


def exchanges_above_buckets(df):
    """Exchanges and disabled buckets on the way up from each scan of a bucketed table."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    text = text.split("== Initial Plan ==")[0]  # the plan as it ended
    found, path, scans = [], [], 0
    for line in text.splitlines():
        name = re.search(r"[A-Za-z*]", line)
        if name is None:
            continue
        depth = name.start()
        while path and path[-1][0] >= depth:
            path.pop()
        if "FileScan" in line and "abode_" in line:
            scans += 1
            assert "Bucketed: true" in line, line
            found += [p for _, p in path if "Exchange" in p or "ShuffleQueryStage" in p]
        path.append((depth, line))
    return scans, found


def rows(df):
    return sorted(map(str, df.select(*LISTING_COLUMNS).collect()))


@pytest.fixture(scope="module")
def both(spark):
    current, batch = catalog.current_and_batch(spark, SF_SMALL)
    return current, batch, catalog.bucketed_listings(spark, current)


def test_layout(spark, both, scratch):
    current, _, snap = both
    assert rows(snap.listings) == rows(current) and snap.buckets == catalog.BUCKETS
    assert snap.addresses.count() == current.count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("abode_")]
    # one file a bucket at most: each was written by one task
    assert len(snap.listings.inputFiles()) <= snap.buckets
    path = scratch("taken")
    bucketed.write_bucketed(current, path, 4)
    with pytest.raises(FileExistsError):
        bucketed.write_bucketed(current, path, 4)


def test_large_delete_and_upsert_shuffle_only_the_delta(spark, both):
    current, _, snap = both
    keys = current.select((F.col("listing_id") + 0).alias("listing_id")).where("listing_id % 2 = 0")
    keys = keys.unionByName(keys).unionByName(spark.sql("select cast(null as bigint) as listing_id union all select 10000000"))
    got = bucketed.delete_by_key_bucketed(snap, keys)
    scans, found = exchanges_above_buckets(got)
    assert scans == 1 and not found
    assert rows(got) == rows(snapshot.delete_by_key(current, keys))
    delta = current.where("listing_id % 3 = 0").select("listing_id", (F.col("listing_price") + 1).cast(PRICE_TYPE).alias("listing_price"))
    delta = delta.unionByName(spark.createDataFrame([(10000000, Decimal("1.00"))], delta.schema))
    got = bucketed.upsert_price_bucketed(snap, delta)
    scans, found = exchanges_above_buckets(got)
    assert scans == 1 and not found
    assert rows(got) == rows(snapshot.upsert_price(current, delta))
    with pytest.raises(Exception, match="null listing_id"):
        bucketed.upsert_price_bucketed(snap, spark.createDataFrame([(None, Decimal("1.00"))], delta.schema)).collect()


def test_conflict_check_shuffles_only_the_batch(spark, both):
    current, batch, snap = both
    unique = snapshot.dedup_by_address(batch)
    fresh = unique.join(snap.addresses.select("address").hint("merge"), "address", "left_anti")
    scans, found = exchanges_above_buckets(fresh)
    assert scans == 1 and not found
    assert rows(bucketed.insert_ignore_bucketed(snap, batch)) == rows(snapshot.insert_ignore(current, batch))


def test_null_addresses_never_conflict(spark, scratch):
    path = scratch("nulls")
    base = listing_frame(spark, [listing_row(1, None), listing_row(2, "2 Main, X")])
    bucketed.write_bucketed(base, path, 3)
    snap = bucketed.read_bucketed(spark, path)
    batch = catalog.enriched(spark, SF_SMALL).limit(1).withColumn("address", F.lit(None).cast("string"))
    out = bucketed.insert_ignore_bucketed(snap, batch.unionByName(batch.withColumn("address", F.lit("2 Main, X"))))
    assert sorted((r["listing_id"], r["address"]) for r in out.select("listing_id", "address").collect()) == [
        (1, None), (2, "2 Main, X"), (3, None),
    ]


def test_a_run_writes_buckets_again_without_shuffling_the_listings(spark, both, scratch):
    current, batch, snap = both
    first, second = scratch("b1"), scratch("b2")
    bucketed.write_bucketed(current, first, 8)
    keys = current.where("listing_id % 5 = 0").select("listing_id")
    delta = current.where("listing_id % 7 = 0").select("listing_id", (F.col("listing_price") * 2).cast(PRICE_TYPE).alias("listing_price"))
    mark = bucketed.write_bucketed_run(spark, first, second, batch, keys, delta)
    inserted = snapshot.insert_ignore(current, batch)
    want = snapshot.upsert_price(snapshot.delete_by_key(inserted, keys), delta)
    out = bucketed.read_bucketed(spark, second)
    assert rows(out.listings) == rows(want) and out.buckets == 8
    assert mark == inserted.agg(F.max("listing_id")).first()[0]
    assert out.addresses.join(out.listings, ["address", "listing_id"]).count() == want.where("address is not null").count()
    assert len(out.listings.inputFiles()) <= 8
    with pytest.raises(ValueError):
        bucketed.write_bucketed_run(spark, first, first + "/x", deleted_keys=keys)
