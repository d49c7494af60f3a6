"""Changes that rewrite only the files they touch.

A snapshot in *parts* has its listings in folders by a hash of the id. A changed
key names its folder, so only that is read; ``_metadata.file_path`` tells which files there
really hold changed keys. The parts they lie in are worked out anew and replaced by a dynamic
partition overwrite; every other file stays as it is.

A part is replaced as a whole, and every change says what is to stand there
(keys to be gone, rows and prices by id). So a run that broke off between two parts is
repeated with the same changes, and gives the same table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.operators.snapshot import upsert_price
from abode.plans.joins import bounded_broadcast
from abode.plans.locations import file_system, path_exists
from abode.plans.materialize import materialize
from abode.schemas import LISTING_COLUMNS, LISTINGS

PART = "id_part"


@dataclass(frozen=True)
class Rewritten:
    """Parts that were replaced, files that held changed keys, files rewritten with them, and files before."""

    parts: int
    files_with_changes: int
    files_rewritten: int
    files_before: int


def id_part(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _layout(path: str) -> str:
    return path.rstrip("/") + ".parts"


def write_parts(df: DataFrame, path: str, parts: int) -> None:
    """Write a listings table in ``parts`` folders at a new path; a folder should hold some hundred MB.

    One shuffle on the folder, whose tasks adaptive execution sizes.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(f"{path} exists; a snapshot in parts is written to a new path")
    spark.range(1).select(F.lit(parts).alias("parts")).write.mode("overwrite").parquet(_layout(path))
    _ordered(df.select(*LISTING_COLUMNS), parts).write.partitionBy(PART).parquet(path)


def _ordered(df: DataFrame, parts: int) -> DataFrame:
    return df.withColumn(PART, id_part(F.col("listing_id"), parts)).hint("rebalance", PART).sortWithinPartitions(PART, "listing_id")


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """The listings, and their folder in ``id_part``."""
    schema = T.StructType([*LISTINGS.fields, T.StructField(PART, T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def part_count(spark: SparkSession, path: str) -> int:
    return spark.read.schema("parts int").parquet(_layout(path)).first()["parts"]


def _numbers(df: DataFrame) -> list[int]:
    """Distinct folder numbers, as many as the snapshot has parts at most."""
    return sorted(r[0] for r in df.distinct().collect())


def files_with(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """``id_part, file_path`` of the files that hold one of ``keys``; only the folders of the keys are read, and their ids."""
    parts = part_count(spark, path)
    wanted, _ = bounded_broadcast(keys.select("listing_id").distinct())
    folders = _numbers(wanted.where("listing_id is not null").select(id_part(F.col("listing_id"), parts)))
    table = read_parts(spark, path).where(F.col(PART).isin(folders))
    held = table.select("listing_id", PART, F.col("_metadata.file_path").alias("file_path"))
    return held.join(wanted, "listing_id", "left_semi").select(PART, "file_path").distinct()


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def change_in_place(
    spark: SparkSession,
    path: str,
    deleted_keys: DataFrame | None = None,
    price_delta: DataFrame | None = None,
    new_rows: DataFrame | None = None,
) -> Rewritten:
    """Insert ``new_rows``, delete ``deleted_keys``, then set the prices of ``price_delta``.

    ``new_rows`` come with their ids; a row that has one of them is replaced. Unknown and null keys to
    delete are no-ops. An unknown id with a price becomes a row of id and price, of
    several prices the greatest counts, a null id there raises before
    anything is written. The snapshot must not be read while it is changed.
    """
    parts = part_count(spark, path)
    typed = f"listing_id bigint, listing_price {LISTINGS['listing_price'].dataType.simpleString()}"
    gone = materialize((deleted_keys if deleted_keys is not None else _empty(spark, "listing_id bigint")).select("listing_id"))
    prices = materialize((price_delta if price_delta is not None else _empty(spark, typed)).select("listing_id", "listing_price"))
    added = materialize(new_rows.select(*LISTING_COLUMNS) if new_rows is not None else spark.createDataFrame([], LISTINGS))
    held = materialize(files_with(spark, path, gone.unionByName(prices.select("listing_id")).unionByName(added.select("listing_id"))))
    place = id_part(F.col("listing_id"), parts)
    arriving = added.select("listing_id").unionByName(prices.select("listing_id"))
    touched = _numbers(held.select(PART).unionByName(arriving.select(place.alias(PART))))
    before = read_parts(spark, path).inputFiles()
    rewritten = [name for name in before if int(name.rpartition(f"/{PART}=")[2].partition("/")[0]) in touched]
    if touched:
        rows = read_parts(spark, path).where(F.col(PART).isin(touched)).select(*LISTING_COLUMNS)
        new_ids, _ = bounded_broadcast(added.select("listing_id"))
        rows = rows.join(new_ids, "listing_id", "left_anti").unionByName(added)
        gone_ids, _ = bounded_broadcast(gone.distinct())
        rows = upsert_price(rows.join(gone_ids, "listing_id", "left_anti"), prices)
        # stored before its source is replaced
        result = materialize(rows)
        left = _numbers(result.select(place))
        # the writes below replace the folders that have rows; the others are removed
        _ordered(result, parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
        for part in set(touched) - set(left):
            fs, folder = file_system(spark, f"{path.rstrip('/')}/{PART}={part}")
            fs.delete(folder, True)
    return Rewritten(len(touched), held.select("file_path").count(), len(rewritten), len(before))
