"""Peer averages kept as a small table of sums, updated by a run's changes.

The dashboard asks for averages over (city, type, range). Their sums and counts
are one row each, whatever the number of listings, and exact decimals, so they
can be carried from snapshot to snapshot: an insert adds, a delete subtracts, a new
price subtracts the old one and adds the new. A question then reads a few rows of
that table instead of the listings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode import functions as AF
from abode.operators.reports import SEGMENT, listing_lookup
from abode.plans.joins import bounded_broadcast
from abode.schemas import PEER_STATE

#: Kind of range and the column that holds it.
KINDS = {"sqft": "sqft_range", "age": "age_range"}
STATE_KEYS = [*SEGMENT, "bin_kind", "bin"]
_TYPES = {f.name: f.dataType for f in PEER_STATE.fields}


def _signed(rows: DataFrame, sign: int, price: str = "listing_price") -> DataFrame:
    """``rows`` as changes: their segment, ranges and price, to be added (1) or taken back (-1)."""
    return rows.select(*SEGMENT, *KINDS.values(), F.col(price).alias("listing_price"), F.lit(sign).alias("_sign"))


def _sums(signed: DataFrame) -> DataFrame:
    """Signed rows summed per segment and range; both kinds in one pass, partial sums before the shuffle."""
    bins = F.explode(F.array(*[F.struct(F.lit(k).alias("bin_kind"), F.col(c).alias("bin")) for k, c in KINDS.items()]))
    price = F.coalesce(F.col("listing_price"), F.lit(0)).cast("decimal(18,2)")
    each = signed.withColumn("_bin", bins).select(
        *SEGMENT,
        "_bin.*",
        F.when(F.col("_sign") > 0, price).otherwise(-price).alias("_price"),
        F.when(F.col("listing_price").isNull(), 0).otherwise(F.col("_sign")).alias("_priced"),
        "_sign",
    )
    summed = each.groupBy(*STATE_KEYS).agg(
        F.sum("_price").cast(_TYPES["price_sum"]).alias("price_sum"),
        F.sum("_priced").alias("priced"),
        F.sum("_sign").alias("listings"),
    )
    return summed.select(*PEER_STATE.fieldNames())


def peer_state(listings: DataFrame) -> DataFrame:
    """Sums of a whole table; listings without a city, type or price have their place, too."""
    return _sums(_signed(listings, 1))


def peer_changes(new_rows: DataFrame, deleted_rows: DataFrame, repriced_rows: DataFrame) -> DataFrame:
    """Signed sums of a run: rows as they were, re-priced ones with their ``new_price``.

    A row the run inserts and deletes, or inserts and re-prices, counts in each.
    """
    parts = [
        _signed(new_rows, 1),
        _signed(deleted_rows, -1),
        _signed(repriced_rows, -1),
        _signed(repriced_rows, 1, "new_price"),
    ]
    return _sums(reduce(DataFrame.unionByName, parts))


def changes_by_key(table: DataFrame, deleted_keys: DataFrame, price_delta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deleted and re-priced rows of ``table`` for changes that come as keys.

    Both sides are looked up by ``listing_id``, unique in the table, broadcast if
    small; a repeated key counts once, of several prices the greatest, unknown keys don't count.
    A key in both is deleted.
    """
    gone, _ = bounded_broadcast(deleted_keys.select("listing_id").distinct())
    prices, _ = bounded_broadcast(price_delta.groupBy("listing_id").agg(F.max("listing_price").alias("new_price")))
    deleted = table.join(gone, "listing_id", "left_semi")
    repriced = table.join(prices, "listing_id").join(gone, "listing_id", "left_anti")
    return deleted, repriced


def apply_changes(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state after signed sums are added; groups without a listing left go."""
    both = state.select(*PEER_STATE.fieldNames()).unionByName(changes)
    added = both.groupBy(*STATE_KEYS).agg(*[F.sum(c).cast(_TYPES[c]).alias(c) for c in ("price_sum", "priced", "listings")])
    return added.where(F.col("listings") != 0)


def peer_averages(state: DataFrame, kind: str) -> DataFrame:
    """``city, property_type, <range>, avg_listing_price, peer_count`` from the sums."""
    average = F.when(F.col("priced") != 0, F.col("price_sum").cast("double") / F.col("priced"))
    return state.where(F.col("bin_kind") == kind).select(
        *SEGMENT, F.col("bin").alias(KINDS[kind]), average.alias("avg_listing_price"), F.col("listings").alias("peer_count")
    )


def _segment_averages(state: DataFrame, listings: DataFrame, address: str, kind: str) -> DataFrame:
    # one row at most, by the lookup's limit; the averages of its segment are a few rows
    selected = F.broadcast(listing_lookup(listings, address).select(*SEGMENT, F.col("listing_price").alias("selected_price")))
    return peer_averages(state, kind).join(selected, SEGMENT)


def compare_kept(state: DataFrame, listings: DataFrame, address: str, kind: str) -> DataFrame:
    """Average price of similar homes per range (``sqft`` or ``age``), in the order of the ranges.

    Same rows as :func:`abode.operators.reports.compare_by_sqft` and ``compare_by_age``; from the listings
    only the selected one is looked up.
    """
    column = KINDS[kind]
    found = _segment_averages(state, listings, address, kind).select(column, "avg_listing_price")
    return found.orderBy(column if kind == "sqft" else AF.age_range_ordinal(column).asc_nulls_last())


def overlay_kept(state: DataFrame, listings: DataFrame, address: str, kind: str) -> DataFrame:
    """Per range: peer average, the selected listing's price and the gap, from the sums."""
    column = KINDS[kind]
    found = _segment_averages(state, listings, address, kind).select(
        column,
        "avg_listing_price",
        "selected_price",
        (F.col("selected_price").cast("double") - F.col("avg_listing_price")).alias("price_minus_avg"),
    )
    return found.orderBy(column if kind == "sqft" else AF.age_range_ordinal(column).asc_nulls_last())


def price_vs_kept_peers(listings: DataFrame, state: DataFrame, kind: str) -> DataFrame:
    """Every listing against its peers' average, in one map-only pass over the listings while the sums are small."""
    column = KINDS[kind]
    keys = [*SEGMENT, column]
    averages = peer_averages(state, kind)
    side, _ = bounded_broadcast(averages.select(*[F.col(k).alias(f"_peer_{k}") for k in keys], "avg_listing_price", "peer_count"))
    same = [F.col(k).eqNullSafe(F.col(f"_peer_{k}")) for k in keys]
    return listings.join(side, same).select(
        "listing_id",
        "address",
        "city",
        "property_type",
        column,
        "listing_price",
        "avg_listing_price",
        "peer_count",
        (F.col("listing_price").cast("double") - F.col("avg_listing_price")).alias("price_minus_avg"),
    )
