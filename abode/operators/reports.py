"""Comparison queries over a listings snapshot.

"Similar" listings share city and property type. For one selected address the
lookup is limited to one row and broadcast (a bound proven by the limit), so
the peer filter is a map-side join. For all listings at once, peer averages
are aggregated per (city, type, bin) with map-side partial aggregation and
joined back, broadcast behind a checked size bound.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode import functions as AF
from abode.plans.joins import bounded_broadcast

SEGMENT = ["city", "property_type"]


def average_price(price: str = "listing_price") -> F.Column:
    """Mean price as ``double(sum) / count``: the exact decimal sum divided once,
    so the value does not depend on how partial sums were grouped."""
    return F.sum(price).cast("double") / F.count(price)


def listing_count(listings: DataFrame) -> DataFrame:
    """Number of listings (one row)."""
    return listings.agg(F.count(F.lit(1)).alias("listing_count"))


def project_keys(listings: DataFrame) -> DataFrame:
    """The key column only; the scan reads nothing else."""
    return listings.select("listing_id")


def listing_lookup(listings: DataFrame, address: str) -> DataFrame:
    """The row for one address (empty when the address is unknown)."""
    return listings.filter(F.col("address") == F.lit(address)).limit(1)


def listing_detail(
    listings: DataFrame, as_of: dt.date | str | None = None, address: str | None = None
) -> DataFrame:
    """Detail card: every column plus days on market and display texts.

    With ``address`` it is the card of one listing; without, of all listings.
    """
    src = listings if address is None else listing_lookup(listings, address)
    return src.select(
        "*",
        AF.days_on_market("list_date", as_of).alias("days_on_market"),
        AF.price_text("listing_price").alias("price_text"),
        AF.bool_text("finished_basement").alias("finished_basement_text"),
    )


CARD_FIELDS = [
    "address",
    "number_bedrooms",
    "property_type",
    "price_text",
    "sqft",
    "age",
    "days_on_market",
    "finished_basement_text",
]


def listing_card(listings: DataFrame, address: str, as_of: dt.date | str | None = None) -> DataFrame:
    """The dashboard's card for one address: bedrooms, type, price text,
    size, age, days on market and basement text (empty if unknown)."""
    return listing_detail(listings, as_of, address).select(*CARD_FIELDS)


def days_on_market(listings: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Whole days between the list date and ``as_of`` (default: today)."""
    return listings.select("listing_id", AF.days_on_market("list_date", as_of).alias("days_on_market"))


def format_price(listings: DataFrame) -> DataFrame:
    """Price as currency text, e.g. ``$1,234,567.00``."""
    return listings.select("listing_id", AF.price_text("listing_price").alias("price_text"))


def photoset_bucket(listings: DataFrame) -> DataFrame:
    """Photo set 1..3 of each address (stable md5 bucket)."""
    return listings.select("listing_id", "address", AF.photoset("address").alias("photoset"))


def address_options(listings: DataFrame) -> DataFrame:
    """Selectable addresses in order. Addresses are unique in a snapshot, so
    no distinct pass is needed; the sort is a range-partitioned global sort."""
    return listings.select("address").filter(F.col("address").isNotNull()).orderBy("address")


def address_search(listings: DataFrame, term: str) -> DataFrame:
    """Case-insensitive substring match on the address (city is part of it)."""
    match = F.lower(F.col("address")).contains(F.lower(F.lit(term)))
    return listings.filter(match).select("listing_id", "address")


def _selected_segment(listings: DataFrame, address: str) -> DataFrame:
    """City, type and price of the selected listing: at most one row."""
    return F.broadcast(
        listing_lookup(listings, address).select(*SEGMENT, F.col("listing_price").alias("selected_price"))
    )


def similar_listings(listings: DataFrame, address: str) -> DataFrame:
    """All listings in the selected listing's city and property type."""
    seg = _selected_segment(listings, address).select(*SEGMENT)
    return listings.join(seg, SEGMENT, "left_semi")


def _compare(listings: DataFrame, address: str, bin_col: str) -> DataFrame:
    seg = _selected_segment(listings, address).select(*SEGMENT)
    return (
        listings.join(seg, SEGMENT, "left_semi")
        .groupBy(bin_col)
        .agg(average_price().alias("avg_listing_price"))
    )


def compare_by_sqft(listings: DataFrame, address: str) -> DataFrame:
    """Average price of similar homes per size bin, in label order."""
    return _compare(listings, address, "sqft_range").orderBy("sqft_range")


def compare_by_age(listings: DataFrame, address: str) -> DataFrame:
    """Average price of similar homes per age bin, youngest first, ``26+`` last."""
    return _compare(listings, address, "age_range").orderBy(
        AF.age_range_ordinal("age_range").asc_nulls_last()
    )


def _overlay(listings: DataFrame, address: str, bin_col: str) -> DataFrame:
    # one broadcast of the looked-up row carries both the segment keys and
    # the selected price through the peer join
    seg = _selected_segment(listings, address)
    return (
        listings.join(seg, SEGMENT, "inner")
        .groupBy(bin_col, "selected_price")
        .agg(average_price().alias("avg_listing_price"))
        .select(
            bin_col,
            "avg_listing_price",
            "selected_price",
            (F.col("selected_price").cast("double") - F.col("avg_listing_price")).alias("price_minus_avg"),
        )
    )


def overlay_by_sqft(listings: DataFrame, address: str) -> DataFrame:
    """Per size bin: peer average, the selected listing's price and the gap."""
    return _overlay(listings, address, "sqft_range").orderBy("sqft_range")


def overlay_by_age(listings: DataFrame, address: str) -> DataFrame:
    """Per age bin: peer average, the selected listing's price and the gap."""
    return _overlay(listings, address, "age_range").orderBy(
        AF.age_range_ordinal("age_range").asc_nulls_last()
    )


def price_vs_peers(listings: DataFrame, bin_col: str) -> DataFrame:
    """Every listing against the average of its (city, type, bin) peers.

    The average includes the listing itself, as the dashboard's does.
    """
    keys = [*SEGMENT, bin_col]
    peers = listings.groupBy(*keys).agg(
        average_price().alias("avg_listing_price"), F.count(F.lit(1)).alias("peer_count")
    )
    peers = peers.select(*[F.col(k).alias(f"_peer_{k}") for k in keys], "avg_listing_price", "peer_count")
    peers, _ = bounded_broadcast(peers)
    # null-safe keys: a null city or type still forms its own peer group
    cond = [F.col(k).eqNullSafe(F.col(f"_peer_{k}")) for k in keys]
    return listings.join(peers, cond, "inner").select(
        "listing_id",
        "address",
        "city",
        "property_type",
        bin_col,
        "listing_price",
        "avg_listing_price",
        "peer_count",
        (F.col("listing_price").cast("double") - F.col("avg_listing_price")).alias("price_minus_avg"),
    )


def price_vs_sqft_peers(listings: DataFrame) -> DataFrame:
    return price_vs_peers(listings, "sqft_range")


def price_vs_age_peers(listings: DataFrame) -> DataFrame:
    return price_vs_peers(listings, "age_range")
