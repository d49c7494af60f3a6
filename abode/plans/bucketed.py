"""Snapshots laid out in buckets, for changes as large as the table.

A small delta is broadcast and needs no layout. A large one is joined by a shuffle, of
the delta alone if the table already lies in buckets of the join key: deletes and price
upserts join on ``listing_id``, the conflict check of inserts on ``address``. So a bucketed
snapshot is two tables below one folder: the listings in buckets of their id, and
``(address, listing_id)`` in buckets of the address.

Spark knows buckets from its catalog only. A snapshot's number of buckets stands
beside its data, and a reader declares the table anew, so that any session can read it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.operators.constraints import check_constraints
from abode.operators.snapshot import assign_ids, dedup_by_address, default_order, high_water_mark
from abode.plans.locations import check_outputs, path_exists
from abode.plans.materialize import materialize
from abode.schemas import LISTING_COLUMNS, LISTINGS

AUTO_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
ADDRESSES = T.StructType([LISTINGS["address"], LISTINGS["listing_id"]])
#: Folder below the snapshot, bucket column and columns of its two tables.
TABLES = {"by_id": ("listing_id", LISTINGS), "by_address": ("address", ADDRESSES)}


@dataclass(frozen=True)
class BucketedSnapshot:
    listings: DataFrame  # in buckets of listing_id
    addresses: DataFrame  # address and listing_id, in buckets of address
    buckets: int


@contextmanager
def _keep_buckets(spark: SparkSession) -> Iterator[None]:
    """Scans keep their buckets even where only the write after them needs them."""
    before = spark.conf.get(AUTO_SCAN)
    spark.conf.set(AUTO_SCAN, "false")
    try:
        yield
    finally:
        spark.conf.set(AUTO_SCAN, before)


def _write_table(df: DataFrame, path: str, key: str, buckets: int, mode: str) -> None:
    spark, name = df.sparkSession, f"abode_{uuid.uuid4().hex}"
    # one task a bucket: as Spark hashes both alike, and no exchange where the rows come so already
    ordered = df.repartition(buckets, key)
    with _keep_buckets(spark):
        if mode == "append":
            _declare(spark, name, path, df.schema, key, buckets)
        ordered.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).mode(mode).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the data is external


def _declare(spark: SparkSession, name: str, path: str, schema: T.StructType, key: str, buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
    )


def _read_table(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    name = f"abode_{uuid.uuid4().hex}"
    _declare(spark, name, path, schema, key, buckets)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def write_bucketed(df: DataFrame, path: str, buckets: int) -> None:
    """Write a listings table as a bucketed snapshot at a new path.

    ``buckets`` should leave a bucket at a size a task can sort, some hundred MB.
    A table that comes in the same number of buckets of ``listing_id`` isn't shuffled.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    if path_exists(spark, root):
        raise FileExistsError(f"{root} exists; a bucketed snapshot is written to a new path")
    df = df.select(*LISTING_COLUMNS)
    for folder, (key, schema) in TABLES.items():
        _write_table(df.select(*schema.fieldNames()), f"{root}/{folder}", key, buckets, "errorifexists")
    # last: a snapshot without it broke off
    spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("errorifexists").parquet(f"{root}/layout")


def read_bucketed(spark: SparkSession, path: str) -> BucketedSnapshot:
    root = path.rstrip("/")
    buckets = spark.read.schema("buckets int").parquet(f"{root}/layout").first()["buckets"]
    tables = {f: _read_table(spark, f"{root}/{f}", schema, key, buckets) for f, (key, schema) in TABLES.items()}
    return BucketedSnapshot(tables["by_id"], tables["by_address"], buckets)


def new_listings_bucketed(
    snap: BucketedSnapshot, batch: DataFrame, id_mark: int | None = None, order_by: Sequence[str] | None = None
) -> tuple[DataFrame, int]:
    """What :func:`abode.operators.snapshot.new_listings` gives, for a batch of any size.

    The batch's rows are shuffled to the buckets of the addresses; the table is not.
    """
    order = list(order_by or default_order(batch))
    mark = high_water_mark(snap.listings) if id_mark is None else int(id_mark)
    unique = dedup_by_address(batch, order)
    # merged: hashing would hold a bucket's addresses in memory
    fresh = unique.join(snap.addresses.select("address").hint("merge"), "address", "left_anti")
    numbered, count = assign_ids(fresh, order, mark)
    return numbered.select(*LISTING_COLUMNS), count


def insert_ignore_bucketed(snap: BucketedSnapshot, batch: DataFrame, id_mark: int | None = None) -> DataFrame:
    """The table with the batch's new addresses, still in buckets of ``listing_id``."""
    fresh, _ = new_listings_bucketed(snap, batch, id_mark)
    return snap.listings.unionByName(fresh.repartition(snap.buckets, "listing_id"))


def delete_by_key_bucketed(snap: BucketedSnapshot, keys: DataFrame) -> DataFrame:
    """The table without ``keys``: only they are shuffled. Unknown and null keys are no-ops."""
    wanted = keys.select("listing_id").where(F.col("listing_id").isNotNull()).distinct()
    return snap.listings.join(wanted.hint("merge"), "listing_id", "left_anti")


def upsert_price_bucketed(snap: BucketedSnapshot, delta: DataFrame) -> DataFrame:
    """The table with ``delta``'s prices: only the delta is shuffled.

    As :func:`abode.operators.snapshot.upsert_price`: an unknown id becomes a row of id
    and price, of several prices the greatest counts, a null id raises.
    """
    known = F.coalesce(F.col("listing_id"), F.raise_error(F.lit("null listing_id in a price delta")).cast("bigint"))
    price = F.col("listing_price").cast(LISTINGS["listing_price"].dataType)
    new = delta.groupBy(known.alias("listing_id")).agg(F.max(price).alias("_new_price"))
    merged = snap.listings.join(new.hint("merge"), "listing_id", "full_outer")
    prices = F.coalesce("_new_price", "listing_price").alias("listing_price")
    return merged.select(*[prices if c == "listing_price" else F.col(c) for c in LISTING_COLUMNS])


def write_bucketed_run(
    spark: SparkSession, snapshot_in: str, snapshot_out: str, batch: DataFrame | None = None,
    deleted_keys: DataFrame | None = None, price_delta: DataFrame | None = None, id_mark: int | None = None,
    check: bool = False,
) -> int:
    """New bucketed snapshot from one and changes of any size: insert, delete, set prices.

    Every step joins within buckets, so the table is read and written but not
    shuffled on its id; its addresses are dealt anew as they follow the changed rows.
    With ``check``, broken keys in the snapshot read raise before anything is written.
    Returns the new id mark.
    """
    check_outputs(spark, {"snapshot_in": snapshot_in}, {"snapshot_out": snapshot_out})
    snap = read_bucketed(spark, snapshot_in)
    if check:
        check_constraints(snap.listings, snap.addresses)
    mark = high_water_mark(snap.listings) if id_mark is None else int(id_mark)
    table = snap.listings
    if batch is not None:
        fresh, added = new_listings_bucketed(snap, batch, mark)
        table, mark = table.unionByName(fresh.repartition(snap.buckets, "listing_id")), mark + added
    if deleted_keys is not None:
        table = delete_by_key_bucketed(BucketedSnapshot(table, snap.addresses, snap.buckets), materialize(deleted_keys))
    if price_delta is not None:
        table = upsert_price_bucketed(BucketedSnapshot(table, snap.addresses, snap.buckets), materialize(price_delta))
    write_bucketed(table, snapshot_out, snap.buckets)
    return mark
