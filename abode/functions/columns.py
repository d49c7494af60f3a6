"""Column expressions used by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python worker.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from abode.schemas import PRICE_TYPE

# --- Fixed values that must equal the reference's results -----------------
# Price per square foot by property type. The reference re-seeds its random
# generator with 88 on every call, so each type always gets the same rate:
# semi-detached 487, single-detached 512, anything else (null included) 472.
RATE_SEMI_DETACHED = 487
RATE_SINGLE_DETACHED = 512
RATE_OTHER = 472
# Size bins, tested on the uncast size: below 1500 is "0-1499", below 2000 is
# "1500-1999", everything else (null included) is "2000-2499".
SQFT_BINS = [(1500, "0-1499"), (2000, "1500-1999")]
SQFT_LAST = "2000-2499"
# Age bins, tested on the uncast age: below 6 "0-5", below 11 "6-10",
# below 16 "11-15", below 21 "16-20", below 26 "21-25", else (null included) "26+".
AGE_BINS = [(6, "0-5"), (11, "6-10"), (16, "11-15"), (21, "16-20"), (26, "21-25")]
AGE_LAST = "26+"
# Re-pricing factors by hash bucket 0..7: 0 -> 0.97, 1-2 -> 0.98, 3 -> 0.99,
# 4 -> 1.01, 5-6 -> 1.02, 7 -> 1.03 (half down, half up; never 1.00).
REPRICE_FACTORS = ["0.97", "0.98", "0.98", "0.99", "1.01", "1.02", "1.02", "1.03"]
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def address(street_number="street_number", street_name="street_name", city="city") -> Column:
    """``"<number> <street>, <city>"``; null when any part is null."""
    return F.concat(
        _col(street_number).cast("string"), F.lit(" "), _col(street_name), F.lit(", "), _col(city)
    )


def price_per_sqft(property_type="property_type") -> Column:
    pt = _col(property_type)
    return (
        F.when(pt == "semi-detached", F.lit(RATE_SEMI_DETACHED))
        .when(pt == "single-detached", F.lit(RATE_SINGLE_DETACHED))
        .otherwise(F.lit(RATE_OTHER))
    )


def listing_price(sqft="sqft", property_type="property_type") -> Column:
    """Size times rate, computed on the uncast size, stored as decimal(12,2).

    The rate is widened to bigint so an integer size cannot overflow 32 bits.
    """
    return (_col(sqft) * price_per_sqft(property_type).cast("bigint")).cast(PRICE_TYPE)


def _bins(value: Column, bins: list[tuple[int, str]], last: str) -> Column:
    (bound, label), *rest = bins
    expr = F.when(value < bound, F.lit(label))
    for bound, label in rest:
        expr = expr.when(value < bound, F.lit(label))
    return expr.otherwise(F.lit(last))


def sqft_range(sqft="sqft") -> Column:
    return _bins(_col(sqft), SQFT_BINS, SQFT_LAST)


def age_range(age="age") -> Column:
    return _bins(_col(age), AGE_BINS, AGE_LAST)


def age_range_ordinal(age_range_col="age_range") -> Column:
    """0..4 for the five bounded age bins, null for the open top bin."""
    rng = _col(age_range_col)
    expr = None
    for i, (_, label) in enumerate(AGE_BINS):
        expr = F.when(rng == label, F.lit(i)) if expr is None else expr.when(rng == label, F.lit(i))
    return expr


def days_on_market(list_date="list_date", as_of: dt.date | str | None = None) -> Column:
    today = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.datediff(today, _col(list_date))


def price_text(price="listing_price") -> Column:
    """Currency text such as ``$1,234,567.00``."""
    return F.concat(F.lit("$"), F.format_number(_col(price), 2))


def bool_text(b) -> Column:
    """``True`` / ``False`` / null."""
    return F.initcap(_col(b).cast("string"))


def hex_bucket(text: Column, buckets: int) -> Column:
    """Stable bucket from the first 32 bits of an md5 digest."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def photoset(address_col="address") -> Column:
    """Photo set 1..3 chosen by a stable hash of the address."""
    return hex_bucket(_col(address_col), 3) + F.lit(1)


def sample_hash(key="listing_id", seed: int = 0) -> Column:
    """Seeded md5 of a key: the order in which exact-k samples are drawn."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))


def reprice_factor(key="listing_id", seed: int = 0) -> Column:
    """Decimal factor drawn from :data:`REPRICE_FACTORS` by a seeded key hash."""
    bucket = hex_bucket(F.concat(F.lit(f"{seed}:factor:"), _col(key).cast("string")), 8)
    expr = None
    for i, factor in enumerate(REPRICE_FACTORS):
        lit = F.lit(Decimal(factor)).cast("decimal(3,2)")
        expr = F.when(bucket == i, lit) if expr is None else expr.when(bucket == i, lit)
    return expr


def repriced(price="listing_price", factor: Column | None = None) -> Column:
    """New price: exact decimal product rounded half-up to cents."""
    return F.round(_col(price) * factor, 2).cast(PRICE_TYPE)
