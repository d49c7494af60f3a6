"""Writers: Parquet snapshots/archives, JSON-lines batches and JDBC tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Folder column of city-partitioned snapshots. The city itself stays in the
# files: as a folder name, an empty city would come back as null.
CITY_PART = "city_part"


def city_part(city: Column) -> Column:
    """Folder of a city; null and empty cities have their own."""
    return F.when(city.isNull(), "null").otherwise(F.concat(F.lit("="), city))


def write_snapshot(
    df: DataFrame,
    path: str,
    partition_by_city: bool = False,
    sort_by_address: bool = True,
    mode: str = "errorifexists",
    bloom_addresses: int | None = None,
) -> None:
    """Write a listings snapshot (or an enriched archive) to a new path.

    Default mode is ``errorifexists``: every run writes a fresh path and
    never overwrites the snapshot it read from. A scheduler retrying a failed
    run may pass ``mode="overwrite"`` for that run's own output path (never
    the input path: Spark cannot overwrite what it is reading). Partitioning
    by city (see ``CITY_PART``) lets readers of one city prune folders: see
    ``read_snapshot``.
    Sorting each task's rows by address (no shuffle) gives every Parquet row
    group a narrow address range, so point lookups skip most row groups of a file.
    With ``bloom_addresses``, the expected number of distinct addresses in a row group, each
    row group also carries a Bloom filter of its addresses, so that an equality read skips the
    files that lack the address; about 1.3 bytes an address.
    """
    if partition_by_city:
        # one shuffle so each city folder gets few, evenly sized files: AQE
        # splits a hot city across several tasks and merges small ones,
        # instead of every task writing a small file for every city
        df = df.withColumn(CITY_PART, city_part(F.col("city"))).hint("rebalance", CITY_PART)
    keys = ([CITY_PART] if partition_by_city else []) + (["address"] if sort_by_address else [])
    if keys:
        df = df.sortWithinPartitions(*keys)
    writer = df.write.mode(mode)
    if partition_by_city:
        writer = writer.partitionBy(CITY_PART)
    if bloom_addresses:
        writer = writer.option("parquet.bloom.filter.enabled#address", "true")
        writer = writer.option("parquet.bloom.filter.expected.ndv#address", str(bloom_addresses))
    writer.parquet(path)


def write_raw_jsonl(df: DataFrame, path: str) -> None:
    """Write a raw listing batch as JSON lines (nulls omitted per line)."""
    df.write.mode("errorifexists").json(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    mode: str = "append",
    num_partitions: int = 8,
    batch_size: int = 10_000,
) -> None:
    """Set-wise JDBC write.

    The caller decides the rows (for instance only the rows an insert-ignore
    kept), so no per-row conflict statement is needed. ``numPartitions``
    bounds the number of open connections; Spark coalesces to it.
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    props.setdefault("numPartitions", str(num_partitions))
    df.write.jdbc(url, table, mode=mode, properties=props)
