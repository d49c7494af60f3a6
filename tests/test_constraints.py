"""Unique keys: found where broken, without a shuffle of a bucketed table."""

import pytest

from abode import catalog
from abode.operators.constraints import broken_constraints, check_constraints
from abode.plans import bucketed
from tests.conftest import SF_SMALL
from tests.helpers import listing_frame, listing_row


def test_broken_keys_are_found(spark):
    rows = [listing_row(1, "a"), listing_row(1, "b"), listing_row(2, "a"), listing_row(3, None), listing_row(4, None), listing_row(None, "c")]
    found = {tuple(r) for r in broken_constraints(listing_frame(spark, rows)).collect()}
    assert found == {("unique_listing_id", "1", 2), ("unique_listing_id", None, 1), ("unique_address", "a", 2)}
    with pytest.raises(ValueError, match="is broken"):
        check_constraints(listing_frame(spark, rows))
    check_constraints(listing_frame(spark, rows[3:5]))
    check_constraints(listing_frame(spark, []))


def test_a_bucketed_table_is_checked_without_an_exchange(spark, scratch):
    table = catalog.listings(spark, SF_SMALL)
    snap = catalog.bucketed_listings(spark, table)
    found = broken_constraints(snap.listings, snap.addresses)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_a_run_can_check_first(spark, scratch):
    base = scratch("keys")
    bucketed.write_bucketed(listing_frame(spark, [listing_row(1, "a"), listing_row(2, "a")]), f"{base}/v1", 2)
    with pytest.raises(ValueError, match="unique_address"):
        bucketed.write_bucketed_run(spark, f"{base}/v1", f"{base}/v2", check=True)
    bucketed.write_bucketed_run(spark, f"{base}/v1", f"{base}/v2", spark.createDataFrame([], catalog.enriched(spark, SF_SMALL).schema))
    assert bucketed.read_bucketed(spark, f"{base}/v2").listings.count() == 2
