"""One key holding a third of the rows: results stay whole and exact, and
the hot key is collapsed map-side (partial aggregation) before any shuffle."""

import datetime as dt

from pyspark.sql import functions as F

from abode.operators import reports, snapshot
from abode.operators.enrich import enrich
from abode.schemas import RAW


def _skewed_raw(spark, n=30_000):
    df = spark.range(n).select(
        F.col("id").alias("source_id"),
        # a third of the rows share street number 1 -> one hot address
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 5000) + 2).cast("int").alias("street_number"),
        F.lit("Main").alias("street_name"),
        F.when(F.col("id") % 3 == 0, F.lit("Springfield")).otherwise(F.concat(F.lit("City"), (F.col("id") % 7).cast("string"))).alias("city"),
        (F.col("id") % 40).cast("int").alias("age"),
        (F.lit(900) + F.col("id") % 1600).cast("int").alias("sqft"),
        (F.col("id") % 2 == 0).alias("finished_basement"),
        F.lit(3).alias("number_bedrooms"),
        F.lit(dt.date(2023, 1, 1)).alias("list_date"),
        F.lit("townhome").alias("property_type"),
    )
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW.fields])


def test_hot_address_dedup_exact(spark):
    raw = _skewed_raw(spark)
    listings = snapshot.to_listings(enrich(raw))
    expected = raw.select(
        F.concat(F.col("street_number").cast("string"), F.lit(" Main, "), F.col("city")).alias("a"), "source_id"
    ).groupBy("a").agg(F.min("source_id").alias("m"))
    got = {(r["address"], r["listing_id"]) for r in listings.select("address", "listing_id").collect()}
    want = {(r["a"], r["m"]) for r in expected.collect()}
    assert got == want
    hot = listings.filter(F.col("address") == "1 Main, Springfield").collect()
    assert len(hot) == 1 and hot[0]["listing_id"] == 0
    plan = listings._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side combine before the exchange


def test_hot_city_peers_whole(spark):
    raw = _skewed_raw(spark)
    enriched = enrich(raw).withColumn("listing_id", F.col("source_id"))
    out = reports.price_vs_age_peers(enriched)
    assert out.count() == raw.count()
    total = out.filter(F.col("city") == "Springfield").agg(F.sum("peer_count")).first()[0]
    # every Springfield row sees its own group's size; sizes add up per group
    groups = enriched.filter(F.col("city") == "Springfield").groupBy("age_range").count().collect()
    assert total == sum(g["count"] ** 2 for g in groups)


def test_peer_join_fallback_splits_hot_partition(spark, monkeypatch):
    """Above the broadcast bound the peer join is a sort-merge join; with a
    hot (city, bin) group AQE splits the skewed partition (skew=true)."""
    from abode.plans import joins

    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", -1)
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        raw = _skewed_raw(spark, 60_000)
        out = reports.price_vs_age_peers(enrich(raw).withColumn("listing_id", F.col("source_id")))
        rows = out.collect()
        assert len(rows) == 60_000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
