"""Set-wise changes to a listings snapshot: insert-ignore, delete, price upsert.

Each operator maps ``DataFrame -> DataFrame``; the caller writes the result to
a new snapshot path. Unique keys (``address`` for inserts, ``listing_id`` for
deletes and upserts) are operator contracts, since Spark enforces none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abode.plans.joins import bounded_broadcast, measured_bytes, within_bound
from abode.plans.materialize import materialize, materialize_counted
from abode.schemas import LISTING_COLUMNS, LISTINGS, PRICE_TYPE

_LISTING_TYPES = {f.name: f.dataType for f in LISTINGS.fields}
# Rows per range partition when numbering new rows.
ROWS_PER_ID_PARTITION = 1_000_000


def default_order(batch: DataFrame) -> list[str]:
    """Tie-break that decides which duplicate of an address wins and in
    which order new rows are numbered: ``source_id`` first when the batch
    has one, then every other column, so rows without a source id (plain
    generator output) still have a total order."""
    rest = [c for c in batch.columns if c not in ("source_id", "address")]
    return (["source_id"] if "source_id" in batch.columns else []) + rest


def dedup_by_address(batch: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep, per address, the row that sorts first on ``order_by``.

    The minimum of a struct per address is a plain aggregate, so a hot address
    is collapsed by the map-side partial aggregate before the shuffle instead
    of landing in one task as a window partition would. Nulls sort last, as
    they do when new rows are numbered. Rows with a null address never
    conflict; they bypass the aggregate.
    """
    order = list(order_by or default_order(batch))
    ranked = [*order, *(c for c in batch.columns if c not in order and c != "address")]
    key = [x for c in ranked for x in (F.col(c).isNull().alias(f"_null_{c}"), F.col(c))]
    named = (
        batch.where(F.col("address").isNotNull())
        .groupBy("address")
        .agg(F.min(F.struct(*key)).alias("_w"))
        .select("address", "_w.*")
        .select(*batch.columns)
    )
    return named.unionByName(batch.where(F.col("address").isNull()))


def to_listings(enriched: DataFrame, id_col: str = "source_id") -> DataFrame:
    """Listings table from an enriched batch: first row per address, id = tie-break.

    ``id_col`` becomes ``listing_id``, so it must be unique and non-null.
    The least id per address is a hash aggregate over two columns; a semi join
    on (address, id) then picks the rows. Column pruning passes through, and a
    filter on ``address`` above this (a point lookup) reaches both sides.
    Rows with a null address never conflict and all stay.
    """
    named = enriched.where(F.col("address").isNotNull())
    first = named.groupBy(F.col("address").alias("_address")).agg(F.min(id_col).alias("_id"))
    winners = named.join(
        first, (F.col("address") == F.col("_address")) & (F.col(id_col) == F.col("_id")), "left_semi"
    )
    unique = winners.unionByName(enriched.where(F.col("address").isNull()))
    return unique.withColumn("listing_id", F.col(id_col).cast("bigint")).select(*LISTING_COLUMNS)


def _sort_keys(order_by: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order_by]


def assign_ids(
    rows: DataFrame,
    order_by: Sequence[str],
    start_after: int,
    id_col: str = "listing_id",
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """Number ``rows`` as ``start_after + 1, 2, ...`` in ``order_by`` order.

    Equal to a global ``row_number()`` without pulling every row into one
    task: rows are range-partitioned and sorted, materialized (so positions
    cannot move on a retry), and counted per partition. The per-partition
    counts (one number per partition, so bounded by the partition count, not
    the data) become a literal offset array; each row's id is its
    partition's offset plus its position inside the partition, a map-only
    projection over the materialized rows. Returns the numbered rows and how
    many there are.
    """
    spark = rows.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = _sort_keys(order_by)
    ranged = materialize(rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys))
    counts = dict(
        ranged.groupBy(F.spark_partition_id().alias("p")).count().select("p", "count").collect()
    )
    parts = max(counts, default=-1) + 1
    offsets, total = [], 0
    for p in range(parts):
        offsets.append(total)
        total += counts.get(p, 0)
    if total == 0:
        return ranged.withColumn(id_col, F.lit(None).cast("bigint")), 0
    pid = F.spark_partition_id()
    position = F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)
    offset = F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), pid + 1)
    numbered = ranged.withColumn(
        id_col, (F.lit(int(start_after)) + offset + position + F.lit(1)).cast("bigint")
    )
    return numbered, total


def high_water_mark(table: DataFrame) -> int:
    """Largest ``listing_id`` in the table (0 when empty); one scalar."""
    value = table.agg(F.max("listing_id")).collect()[0][0]
    return int(value) if value is not None else 0


def new_listings(
    current: DataFrame,
    batch: DataFrame,
    id_mark: int,
    order_by: Sequence[str] | None = None,
) -> tuple[DataFrame, int]:
    """Rows of ``batch`` that :func:`insert_ignore` adds, numbered above
    ``id_mark``, and their count.

    The batch is normally much smaller than the table. When its distinct
    addresses pass the broadcast bound, conflicts are found by a map-only
    semi join of the table's address column against the broadcast batch keys,
    so the table is never shuffled; above the bound it is a shuffled anti
    join. The address alone decides: one address can be spelled by several
    splits into street and city.
    """
    order = list(order_by or default_order(batch))
    # counted while it is written: all rows, and those with an address and their characters
    unique, seen = materialize_counted(
        dedup_by_address(batch, order),
        n=F.count(F.lit(1)),
        rows=F.count("address"),
        chars=F.sum(F.octet_length("address").cast("bigint")),
    )
    n_unique = seen.get("n", 0)
    batch_keys = unique.select("address").filter(F.col("address").isNotNull())
    taken = current.select("address")
    if within_bound(measured_bytes(batch_keys.schema, seen)):
        # at most as many addresses as the measured batch holds
        taken = F.broadcast(taken.join(F.broadcast(batch_keys), "address", "left_semi").distinct())
    fresh = unique.join(taken, "address", "left_anti")
    # size the range partitioning to the batch, not to the cluster default
    cap = int(unique.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(cap, -(-n_unique // ROWS_PER_ID_PARTITION)))
    numbered, count = assign_ids(fresh, order, id_mark, num_partitions=parts)
    return numbered.select(*LISTING_COLUMNS), count


def insert_ignore(
    current: DataFrame,
    batch: DataFrame,
    id_mark: int | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Append the batch's new addresses to ``current``; ignore conflicts.

    * duplicates inside the batch: the first row on ``order_by`` wins;
    * addresses already in ``current``: the batch row is dropped;
    * null addresses never conflict;
    * new rows get ids above ``id_mark`` (default: the current largest id;
      pass the stored mark to avoid reusing ids of deleted rows).
    """
    mark = high_water_mark(current) if id_mark is None else int(id_mark)
    fresh, _ = new_listings(current, batch, mark, order_by)
    return current.select(*LISTING_COLUMNS).unionByName(fresh)


def delete_by_key(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Remove rows whose ``listing_id`` is in ``keys``; unknown keys are no-ops."""
    key_side, _ = bounded_broadcast(keys.select("listing_id"))
    return table.join(key_side, "listing_id", "left_anti")


def upsert_price(table: DataFrame, delta: DataFrame) -> DataFrame:
    """Set ``listing_price`` from ``delta``.

    Matching rows get the new price and keep everything else; an id not in
    the table becomes a new row holding only id and price. If an id occurs
    several times in ``delta``, its greatest price counts; a null id in
    ``delta`` is an error, raised when the result is computed.

    A delta under the broadcast bound is applied without shuffling the table:
    a broadcast left join replaces prices, and a broadcast semi join finds
    which delta ids matched. Above the bound it is a full outer join.
    """
    known = F.coalesce(F.col("listing_id"), F.raise_error(F.lit("null listing_id in a price delta")).cast("bigint"))
    delta = delta.groupBy(known.alias("listing_id")).agg(F.max(F.col("listing_price").cast(PRICE_TYPE)).alias("_new_price"))
    delta_side, small = bounded_broadcast(delta)
    cols = [c for c in LISTING_COLUMNS if c not in ("listing_id", "listing_price")]
    new_price = F.coalesce(F.col("_new_price"), F.col("listing_price")).alias("listing_price")
    if not small:
        merged = table.select(*LISTING_COLUMNS).join(delta_side, "listing_id", "full_outer")
        return merged.select("listing_id", *cols, new_price).select(*LISTING_COLUMNS)
    updated = (
        table.select(*LISTING_COLUMNS)
        .join(delta_side, "listing_id", "left")
        .select("listing_id", *cols, new_price)
    )
    # at most as many ids as the measured delta holds, so no larger to broadcast
    matched = table.select("listing_id").join(delta_side, "listing_id", "left_semi").distinct()
    unknown = delta_side.join(F.broadcast(matched), "listing_id", "left_anti")
    new_rows = unknown.select(
        "listing_id",
        *[F.lit(None).cast(_LISTING_TYPES[c]).alias(c) for c in cols],
        F.col("_new_price").alias("listing_price"),
    )
    return updated.unionByName(new_rows).select(*LISTING_COLUMNS)
