"""The two unique keys of the listings table, checked over a whole snapshot.

Spark enforces no key. The check counts rows per key, by partial aggregation on the key
column alone; on a bucketed snapshot (see :mod:`abode.plans.bucketed`) each key's rows lie in
one bucket already and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNIQUE_ID, UNIQUE_ADDRESS = "unique_listing_id", "unique_address"


def broken_constraints(listings: DataFrame, addresses: DataFrame | None = None) -> DataFrame:
    """``constraint, key, n``: ids that are null or repeated, and repeated addresses; ``n`` rows each.

    Null addresses never conflict. ``addresses`` is a frame with the same addresses where one is
    at hand that needs no shuffle.
    """
    ids = listings.groupBy("listing_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or listing_id is null")
    named = (listings if addresses is None else addresses).where(F.col("address").isNotNull())
    repeated = named.groupBy("address").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return ids.select(F.lit(UNIQUE_ID).alias("constraint"), F.col("listing_id").cast("string").alias("key"), "n").unionByName(
        repeated.select(F.lit(UNIQUE_ADDRESS).alias("constraint"), F.col("address").alias("key"), "n")
    )


def check_constraints(listings: DataFrame, addresses: DataFrame | None = None) -> None:
    """Raise ``ValueError`` with an example if a key is broken."""
    broken = broken_constraints(listings, addresses).take(1)
    if broken:
        raise ValueError(f"{broken[0]['constraint']} is broken: {broken[0]['key']!r} stands on {broken[0]['n']} row(s)")
