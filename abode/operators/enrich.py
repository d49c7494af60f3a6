"""Enrichment of a raw listing batch: address, price, size and age bins, casts.

Everything is one narrow projection (no shuffle); bins and price are computed
from the uncast size and age, then the numeric columns are cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abode import functions as AF

_DROPPED = {"price_per_sqft", "type"}
_CASTS = {
    "list_date": "date",
    "number_bedrooms": "int",
    "sqft": "int",
    "street_number": "int",
    "age": "int",
}
DERIVED = ["address", "listing_price", "sqft_range", "age_range"]


def derived_columns(raw: DataFrame) -> dict[str, F.Column]:
    """The four derived columns, all computed on the uncast raw values."""
    del raw  # columns are resolved by name
    return {
        "address": AF.address(),
        "listing_price": AF.listing_price(),
        "sqft_range": AF.sqft_range(),
        "age_range": AF.age_range(),
    }


def cast_columns(df: DataFrame) -> list[F.Column]:
    """Raw columns with their target types (absent ones are skipped)."""
    out = []
    for name in df.columns:
        if name in _DROPPED or name in DERIVED:
            continue
        target = _CASTS.get(name)
        out.append(F.col(name).cast(target).alias(name) if target else F.col(name))
    return out


def enrich(raw: DataFrame) -> DataFrame:
    """Raw batch -> enriched batch (raw columns cast, plus the derived ones).

    ``type`` and ``price_per_sqft`` are dropped when present.
    """
    derived = derived_columns(raw)
    return raw.select(*cast_columns(raw), *[expr.alias(name) for name, expr in derived.items()])
