"""Raw listings derived from the supplied order/customer/nation tables.

One listing per order: the order key gives the street number, age and
basement flag, the customer's market segment the street name, the nation the
city, the total price the size, the priority the bedroom count, the order date
the list date and the order status the property type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns read from the supplied tables. Declaring them skips the footer
# inference job and reads only these columns.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One supplied table; the columns used here are declared, not inferred."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw listings (schema :data:`abode.schemas.RAW`).

    The two joins are left to Catalyst: the nation table is tiny and is
    broadcast on its file-size statistics; customer is broadcast only while
    its files stay under the broadcast threshold and is shuffle-joined above
    it, with AQE splitting a customer that owns a large share of orders.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_orderkey")
    return joined.select(
        key.alias("source_id"),
        (key % 500 + 1).cast("int").alias("street_number"),
        F.col("c_mktsegment").alias("street_name"),
        F.col("n_name").alias("city"),
        (key % 41).cast("int").alias("age"),
        (F.lit(900) + F.floor("o_totalprice").cast("bigint") % 1600).cast("int").alias("sqft"),
        (key % 2 == 0).alias("finished_basement"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("number_bedrooms"),
        F.col("o_orderdate").cast("date").alias("list_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("semi-detached"))
        .when(F.col("o_orderstatus") == "O", F.lit("single-detached"))
        .otherwise(F.lit("townhome"))
        .alias("property_type"),
    )
