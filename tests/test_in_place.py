"""Changes in place: only touched folders are written, repeated changes change nothing."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from abode.operators import snapshot
from abode.plans import in_place, joins
from abode.schemas import LISTING_COLUMNS, PRICE_TYPE
from tests.helpers import listing_frame, listing_row

PARTS = 16
DELTA = "listing_id long, listing_price decimal(12,2)"


def data_files(path):
    return {
        os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
        for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def rows(df):
    return sorted(map(str, df.select(*LISTING_COLUMNS).collect()))


@pytest.fixture()
def table(spark, scratch):
    path = scratch("parts").replace("file:", "")
    df = listing_frame(spark, [listing_row(i, f"{i} Main, X", price=f"{i}.50") for i in range(1, 301)] + [listing_row(None, None)])
    in_place.write_parts(df, path, PARTS)
    return path, df


def folder_of(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "listing_id long")
    return {r[0] for r in df.select(in_place.id_part(F.col("listing_id"), PARTS)).collect()}


@pytest.mark.parametrize("bound", [None, 0])
def test_only_touched_files_are_rewritten(spark, table, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", bound)
    path, df = table
    before = data_files(path)
    assert len(before) == PARTS or len(before) > PARTS - 3
    gone = spark.createDataFrame([(7,), (7,), (None,), (10_000,)], "listing_id long")
    delta = spark.createDataFrame([(8, Decimal("1.00")), (8, Decimal("2.00")), (20_000, Decimal("3.00"))], DELTA)
    new = listing_frame(spark, [listing_row(301, "301 Main, X"), listing_row(9, "9 New, X")])
    done = in_place.change_in_place(spark, path, gone, delta, new)
    expected = df.join(new.select("listing_id"), "listing_id", "left_anti").select(*LISTING_COLUMNS).unionByName(new)
    expected = snapshot.upsert_price(snapshot.delete_by_key(expected, gone), delta)
    assert rows(in_place.read_parts(spark, path)) == rows(expected)
    touched = folder_of(spark, [7, 8, 9, 301, 20_000])
    after = data_files(path)
    kept = {f for f in before if int(f.split("id_part=")[1].split("/")[0]) not in touched}
    assert kept and all(after.get(f) == before[f] for f in kept)  # not written again
    assert not (set(before) - kept) & set(after)  # the others are new files
    assert done.parts == len(touched) and done.files_before == len(before) and done.files_rewritten == len(before) - len(kept)
    assert 1 <= done.files_with_changes <= 3  # those of 7, 8 and 9
    # a run that is repeated gives the same table
    in_place.change_in_place(spark, path, gone, delta, new)
    assert rows(in_place.read_parts(spark, path)) == rows(expected)


def test_nothing_to_change(spark, table):
    path, df = table
    before = data_files(path)
    assert in_place.change_in_place(spark, path) == in_place.Rewritten(0, 0, 0, len(before))
    unknown = spark.createDataFrame([(99_999,)], "listing_id long")
    assert in_place.change_in_place(spark, path, unknown).files_rewritten == 0
    assert data_files(path) == before


def test_an_emptied_folder_goes(spark, table):
    path, df = table
    one = df.where(in_place.id_part(F.col("listing_id"), PARTS) == 3)
    assert one.where("listing_id is not null").count() > 1
    in_place.change_in_place(spark, path, one.select("listing_id"))
    left = df.where((in_place.id_part(F.col("listing_id"), PARTS) != 3) | F.col("listing_id").isNull())
    assert rows(in_place.read_parts(spark, path)) == rows(left)


def test_a_bad_delta_writes_nothing(spark, table):
    path, _ = table
    before = data_files(path)
    with pytest.raises(Exception, match="null listing_id"):
        in_place.change_in_place(spark, path, price_delta=spark.createDataFrame([(None, Decimal("1.00")), (5, Decimal("1.00"))], DELTA))
    assert data_files(path) == before


def test_only_the_keys_folders_are_read(spark, table):
    path, _ = table
    keys = spark.createDataFrame([(7,), (8,)], "listing_id long")
    found = in_place.files_with(spark, path, keys)
    assert {r["id_part"] for r in found.collect()} == folder_of(spark, [7, 8])
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "id_part" in line)
    assert "PartitionFilters: [id_part" in scan and "listing_price" not in scan.split("Batched")[0]
