"""Scalar column expressions (address, price, bins, text, stable hashes)."""

from abode.functions.columns import (  # noqa: F401
    AGE_BINS,
    AGE_LAST,
    RATE_OTHER,
    RATE_SEMI_DETACHED,
    RATE_SINGLE_DETACHED,
    REPRICE_FACTORS,
    SQFT_BINS,
    SQFT_LAST,
    address,
    age_range,
    age_range_ordinal,
    bool_text,
    days_on_market,
    hex_bucket,
    listing_price,
    photoset,
    price_per_sqft,
    price_text,
    reprice_factor,
    repriced,
    sample_hash,
    sqft_range,
)
