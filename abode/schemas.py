"""Schemas of the listing data model.

Every reader takes an explicit schema: no inference pass over the input and
no type drift between runs.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_TYPE = T.DecimalType(12, 2)

# Raw listing batch as it arrives in JSON lines. ``sqft`` and ``age`` stay
# double so fractional values reach the bins uncast; ``list_date`` is text and
# is cast during enrichment. ``source_id`` is an optional tie-break key (absent
# in real generator output, present in files derived from the test tables).
RAW_JSON = T.StructType(
    [
        T.StructField("source_id", T.LongType()),
        T.StructField("street_number", T.LongType()),
        T.StructField("street_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("age", T.DoubleType()),
        T.StructField("sqft", T.DoubleType()),
        T.StructField("finished_basement", T.BooleanType()),
        T.StructField("number_bedrooms", T.LongType()),
        T.StructField("list_date", T.StringType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("type", T.StringType()),
    ]
)

# Raw listings derived from the supplied tables (already typed).
RAW = T.StructType(
    [
        T.StructField("source_id", T.LongType()),
        T.StructField("street_number", T.IntegerType()),
        T.StructField("street_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("sqft", T.IntegerType()),
        T.StructField("finished_basement", T.BooleanType()),
        T.StructField("number_bedrooms", T.IntegerType()),
        T.StructField("list_date", T.DateType()),
        T.StructField("property_type", T.StringType()),
    ]
)

DERIVED_FIELDS = [
    T.StructField("address", T.StringType()),
    T.StructField("listing_price", PRICE_TYPE),
    T.StructField("sqft_range", T.StringType()),
    T.StructField("age_range", T.StringType()),
]

ENRICHED = T.StructType(list(RAW.fields) + DERIVED_FIELDS)

# Column order of the listings table.
LISTING_COLUMNS = [
    "listing_id",
    "address",
    "age",
    "city",
    "finished_basement",
    "list_date",
    "number_bedrooms",
    "property_type",
    "sqft",
    "street_name",
    "street_number",
    "listing_price",
    "sqft_range",
    "age_range",
]

_ENRICHED_TYPES = {f.name: f.dataType for f in ENRICHED.fields}
LISTINGS = T.StructType(
    [T.StructField("listing_id", T.LongType())]
    + [T.StructField(c, _ENRICHED_TYPES[c]) for c in LISTING_COLUMNS[1:]]
)

DELETE_KEYS = T.StructType([T.StructField("listing_id", T.LongType())])

PRICE_DELTA = T.StructType(
    [
        T.StructField("listing_id", T.LongType()),
        T.StructField("listing_price", PRICE_TYPE),
    ]
)

# Sums behind the peer averages: one row per (city, type, kind of range, range).
PEER_STATE = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("bin_kind", T.StringType()),
        T.StructField("bin", T.StringType()),
        T.StructField("price_sum", T.DecimalType(38, 2)),
        T.StructField("priced", T.LongType()),
        T.StructField("listings", T.LongType()),
    ]
)
