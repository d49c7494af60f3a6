from decimal import Decimal

from abode import catalog
from abode.operators import reports
from abode.sinks import write_snapshot
from abode.sources import read_snapshot
from tests.conftest import SF_SMALL
from tests.helpers import listing_frame, listing_row


def _table(spark):
    rows = [
        listing_row(1, "1 Main, Springfield", "400000.00", age=3, age_range="0-5", sqft=1200, sqft_range="0-1499"),
        listing_row(2, "2 Main, Springfield", "500000.00", age=30, age_range="26+", sqft=1600),
        listing_row(3, "3 Main, Springfield", "600000.00", age=12, age_range="11-15", sqft=2100, sqft_range="2000-2499"),
        listing_row(4, "4 Main, Springfield", "700000.00", age=7, age_range="6-10", sqft=1700),
        listing_row(5, "5 Main, Riverton", "900000.00", city="Riverton"),
        listing_row(6, "6 Main, Springfield", "800000.00", ptype="semi-detached"),
    ]
    return listing_frame(spark, rows)


def test_compare_by_age_order_puts_open_bin_last(spark):
    got = [(r[0], r[1]) for r in reports.compare_by_age(_table(spark), "1 Main, Springfield").collect()]
    assert [g[0] for g in got] == ["0-5", "6-10", "11-15", "26+"]
    assert got[1][1] == 700000.0


def test_compare_by_sqft_label_order_and_average(spark):
    got = [(r[0], r[1]) for r in reports.compare_by_sqft(_table(spark), "2 Main, Springfield").collect()]
    # peers: same city and type (ids 1-4), the selected listing included
    assert got == [("0-1499", 400000.0), ("1500-1999", 600000.0), ("2000-2499", 600000.0)]


def test_overlay_adds_selected_price(spark):
    rows = reports.overlay_by_sqft(_table(spark), "2 Main, Springfield").collect()
    assert all(r["selected_price"] == Decimal("500000.00") for r in rows)
    assert [r["price_minus_avg"] for r in rows] == [100000.0, -100000.0, -100000.0]


def test_unknown_address_gives_empty_results(spark):
    t = _table(spark)
    assert reports.listing_lookup(t, "nowhere").count() == 0
    assert reports.compare_by_sqft(t, "nowhere").count() == 0
    assert reports.similar_listings(t, "nowhere").count() == 0


def test_price_vs_peers_covers_every_listing(spark):
    out = reports.price_vs_sqft_peers(_table(spark))
    rows = {r["listing_id"]: r for r in out.collect()}
    assert set(rows) == {1, 2, 3, 4, 5, 6}
    assert rows[2]["avg_listing_price"] == 600000.0 and rows[2]["peer_count"] == 2
    assert rows[5]["peer_count"] == 1 and rows[5]["price_minus_avg"] == 0.0


def test_detail_and_search(spark):
    t = _table(spark)
    card = reports.listing_detail(t, "2024-01-01", "3 Main, Springfield").first()
    assert card["price_text"] == "$600,000.00" and card["finished_basement_text"] == "True"
    assert card["days_on_market"] == 245
    found = sorted(r["listing_id"] for r in reports.address_search(t, "RIVERTON").collect())
    assert found == [5]
    assert [r[0] for r in reports.address_options(t).collect()][:2] == ["1 Main, Springfield", "2 Main, Springfield"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_peer_plan_broadcasts_aggregate(spark):
    plan = _plan(reports.price_vs_age_peers(catalog.listings(spark, SF_SMALL)))
    peer_joins = [line for line in plan.splitlines() if "Join" in line and "_peer_city" in line]
    assert peer_joins and all("BroadcastHashJoin" in line for line in peer_joins)


def test_selected_segment_is_broadcast(spark):
    plan = _plan(reports.compare_by_sqft(catalog.listings(spark, SF_SMALL), "x"))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_snapshot_scan_prunes_columns_and_pushes_filters(spark, scratch):
    path = scratch("snap")
    write_snapshot(_table(spark), path, partition_by_city=True)
    snap = read_snapshot(spark, path)
    keys_plan = _plan(reports.project_keys(snap))
    assert "ReadSchema: struct<listing_id:bigint>" in keys_plan or "struct<listing_id:bigint>" in keys_plan
    lookup_plan = _plan(reports.listing_lookup(snap, "1 Main, Springfield"))
    assert "EqualTo(address,1 Main, Springfield)" in lookup_plan
    city_plan = _plan(read_snapshot(spark, path, city="Riverton"))
    assert "PartitionFilters: [isnotnull(city_part" in city_plan
    assert "EqualTo(city,Riverton)" in _plan(snap.filter("city = 'Riverton'"))


def test_compare_on_a_city_partitioned_snapshot(spark, scratch):
    path = scratch("snap_city")
    write_snapshot(_table(spark), path, partition_by_city=True)
    df = reports.compare_by_sqft(read_snapshot(spark, path), "2 Main, Springfield")
    assert df.collect() == reports.compare_by_sqft(_table(spark), "2 Main, Springfield").collect()
    assert "EqualTo(address,2 Main, Springfield)" in _plan(df)


def test_city_folders_keep_empty_and_null_cities(spark, scratch):
    rows = [listing_row(i, f"{i} a", city=c) for i, c in enumerate(["", None, "null", "=", "a/b", "É", "__HIVE_DEFAULT_PARTITION__"])]
    path = scratch("odd_cities")
    write_snapshot(listing_frame(spark, rows), path, partition_by_city=True)
    assert {(r["listing_id"], r["city"]) for r in read_snapshot(spark, path).collect()} == {(r[0], r[3]) for r in rows}
    assert [r["listing_id"] for r in read_snapshot(spark, path, city="").collect()] == [0]


def test_sql_compare_by_age_order(spark):
    df = catalog.queries()["sql_compare_by_age"](spark, SF_SMALL)
    labels = [r[0] for r in df.collect()]
    assert labels[-1] == "26+" and labels == sorted(labels, key=lambda x: (x == "26+", int(x.split("-")[0].rstrip("+"))))


def test_lookup_with_quotes_is_parameterized(spark):
    t = listing_frame(spark, [listing_row(1, "12 O'Neil Ave, St. John's"), listing_row(2, "x")])
    assert reports.listing_lookup(t, "12 O'Neil Ave, St. John's").count() == 1
    df = spark.sql(
        "SELECT listing_id FROM {t} WHERE address = :a", args={"a": "12 O'Neil Ave, St. John's"}, t=t
    )
    assert [r[0] for r in df.collect()] == [1]
