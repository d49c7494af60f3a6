"""Address search by trigrams.

``contains`` on the address reads every address. The index keeps, for each run of three
characters, the ids of the listings whose lower-cased address holds it, in folders by a hash of
the trigram; the length of each list; and the addresses by a hash of the id. A term of three or
more characters takes its ``RAREST`` trigrams by length, reads their folders, intersects
their lists, and looks only at the addresses of the ids that are in all of them, which
``contains`` then decides. Shorter terms read all addresses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abode.plans.in_place import PART, id_part
from abode.plans.joins import bounded_broadcast
from abode.plans.locations import path_exists
from abode.plans.materialize import materialize

GRAM = 3
#: Lists that are intersected: those of a term's rarest trigrams. More of them read more than they exclude.
RAREST = 3
BUCKET = "gram_bucket"
LENGTHS = "gram string, n bigint"
POSTINGS = f"gram string, listing_id bigint, {BUCKET} int"
ADDRESSES = f"listing_id bigint, address string, {PART} int"


def trigrams(text: Column) -> Column:
    """Distinct runs of three characters of the lower-cased text; none if it is shorter."""
    low = F.lower(text)
    places = F.sequence(F.lit(1), F.length(low) - (GRAM - 1))
    runs = F.transform(places, lambda i: F.substring(low, i, F.lit(GRAM)))
    return F.when(F.length(low) >= GRAM, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def gram_bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def write_search_index(listings: DataFrame, path: str, buckets: int = 256, parts: int = 256) -> None:
    """Write the index of a listings table at a new path.

    Listings without an address or an id can't be found by it. Each half is one
    shuffle whose tasks adaptive execution sizes, so the list of a common trigram
    is spread over several files.
    """
    spark, root = listings.sparkSession, path.rstrip("/")
    if path_exists(spark, root):
        raise FileExistsError(f"{root} exists; an index is written to a new path")
    named = listings.select("listing_id", "address").where("listing_id is not null and address is not null")
    lists = named.select(F.explode(trigrams(F.col("address"))).alias("gram"), "listing_id")
    lists = lists.withColumn(BUCKET, gram_bucket(F.col("gram"), buckets)).hint("rebalance", BUCKET)
    # sorted by trigram: row groups of others are skipped
    lists.sortWithinPartitions(BUCKET, "gram", "listing_id").write.partitionBy(BUCKET).parquet(f"{root}/postings")
    lengths = spark.read.schema(POSTINGS).parquet(f"{root}/postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    lengths.sortWithinPartitions("gram").write.parquet(f"{root}/lengths")
    by_id = named.withColumn(PART, id_part(F.col("listing_id"), parts)).hint("rebalance", PART)
    by_id.sortWithinPartitions(PART, "listing_id").write.partitionBy(PART).parquet(f"{root}/addresses")
    layout = spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(parts).alias("parts"))
    layout.write.parquet(f"{root}/layout")  # last: an index without it broke off


def candidates(spark: SparkSession, path: str, term: str) -> DataFrame | None:
    """Ids of the listings that hold the term's rarest trigrams; None if it has no trigram."""
    root = path.rstrip("/")
    buckets = spark.read.schema("buckets int, parts int").parquet(f"{root}/layout").first()["buckets"]
    # Spark's own lower(), hash and characters, of one row
    grams = [r["gram"] for r in spark.range(1).select(F.explode(trigrams(F.lit(term))).alias("gram")).collect()]
    if not grams:
        return None
    lengths = spark.read.schema(LENGTHS).parquet(f"{root}/lengths").where(F.col("gram").isin(grams))
    known = lengths.select("gram", "n", gram_bucket(F.col("gram"), buckets).alias("b")).collect()  # a row a trigram of the term
    lists = spark.read.schema(POSTINGS).parquet(f"{root}/postings")
    if len(known) < len(grams):  # one that no address has
        return lists.select("listing_id").limit(0)
    wanted = sorted(known, key=lambda r: (r["n"], r["gram"]))[:RAREST]
    lists = lists.where(F.col(BUCKET).isin(sorted({r["b"] for r in wanted})) & F.col("gram").isin([r["gram"] for r in wanted]))
    # counted before the shuffle, so that a list's length doesn't gather anywhere
    held = lists.groupBy("listing_id").agg(F.count_distinct("gram").alias("n"))
    return held.where(F.col("n") == len(wanted)).select("listing_id")


def search_by_index(spark: SparkSession, path: str, term: str) -> DataFrame:
    """``listing_id, address`` of the addresses that contain the term, whatever the case.

    Same rows as :func:`abode.operators.reports.address_search` on the indexed table, for
    listings with an id.
    """
    root = path.rstrip("/")
    addresses = spark.read.schema(ADDRESSES).parquet(f"{root}/addresses")
    ids = candidates(spark, root, term)
    if ids is not None:
        parts = spark.read.schema("buckets int, parts int").parquet(f"{root}/layout").first()["parts"]
        ids = materialize(ids)
        # as many numbers as there are parts at most
        folders = [r[0] for r in ids.select(id_part(F.col("listing_id"), parts)).distinct().collect()]
        side, _ = bounded_broadcast(ids)
        addresses = addresses.where(F.col(PART).isin(folders)).join(side, "listing_id", "left_semi")
    return addresses.where(F.lower("address").contains(F.lower(F.lit(term)))).select("listing_id", "address")
