"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the supplied tables in ``sf_dir`` (orders, customer,
nation), so its work grows with them. The matching SQL for DuckDB lives in
:mod:`abode.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode import functions as AF
from abode.operators import churn, constraints, peers, reports, search_index, snapshot, sql_functions
from abode.operators.enrich import cast_columns, enrich
from abode.params import (
    AS_OF,
    BATCH_SINCE,
    DELETE_SEED,
    PCT,
    SEARCH_TERM,
    SELECTED_ADDRESS,
    UNKNOWN_PRICE,
    UPDATE_SEED,
)
from abode.plans import bucketed, in_place
from abode.plans.batch_run import RunConfig, plan_run, run_batch
from abode.schemas import ENRICHED, LISTING_COLUMNS, PEER_STATE, PRICE_TYPE, RAW_JSON
from abode.session import scratch_path
from abode.sinks import write_raw_jsonl, write_snapshot
from abode.sources import raw_listings, read_raw_jsonl, read_snapshot, split_raw_jsonl

Query = Callable[[SparkSession, str], DataFrame]


# --- shared inputs ----------------------------------------------------------


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(raw_listings(spark, sf_dir))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings table: first row per address, ``listing_id = source_id``."""
    return snapshot.to_listings(enriched(spark, sf_dir))


def store(spark: SparkSession, df: DataFrame, name: str, partition_by_city: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet snapshot under the shared checkpoint folder
    and read it back, as a run reads the previous snapshot from storage.

    Unlike an RDD checkpoint, later reads of a Parquet table get column
    pruning, pushed filters and (when partitioned by city) partition pruning.
    """
    path = scratch_path(spark, name)
    write_snapshot(df, path, partition_by_city=partition_by_city)
    return read_snapshot(spark, path, T.StructType([df.schema[c] for c in df.columns]))


def stored_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings table as a stored snapshot.

    Changes and the reports on all listings read the table several times (sample
    histogram, boundary, the change itself; averages and listings), so the
    derivation from the supplied tables is written once instead of being
    recomputed per pass.
    """
    return store(spark, listings(spark, sf_dir), "listings")


def current_and_raw_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Listings dated before ``BATCH_SINCE`` form the current table (stored);
    the later ones (and any without a date) arrive as one raw batch. Both
    halves together are the whole table."""
    raw = raw_listings(spark, sf_dir)
    older = F.coalesce(F.col("list_date") < F.lit(BATCH_SINCE).cast("date"), F.lit(False))
    current = store(spark, snapshot.to_listings(enrich(raw.filter(older))), "current")
    return current, raw.filter(~older)


def current_and_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """As :func:`current_and_raw_batch`, with the batch enriched."""
    current, raw_batch = current_and_raw_batch(spark, sf_dir)
    return current, enrich(raw_batch)


# --- sources and sinks -------------------------------------------------------


def q_scan_raw_jsonl(spark, sf_dir):
    """Raw listings written as JSON lines, read back with the fixed schema, enriched."""
    raw = raw_listings(spark, sf_dir)
    as_json_types = raw.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_JSON.fields if f.name in raw.columns]
    )
    path = scratch_path(spark, "raw_jsonl")
    write_raw_jsonl(as_json_types, path)
    return enrich(read_raw_jsonl(spark, path)).select(*ENRICHED.fieldNames())


def q_scan_snapshot(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    write_snapshot(listings(spark, sf_dir), path)
    return read_snapshot(spark, path)


def q_sink_parquet_roundtrip(spark, sf_dir):
    """Enriched archive written partitioned by city and read back."""
    path = scratch_path(spark, "enriched_archive")
    write_snapshot(enriched(spark, sf_dir), path, partition_by_city=True)
    return read_snapshot(spark, path, ENRICHED)


def q_sql_listing_lookup(spark, sf_dir):
    return spark.sql(
        "SELECT *, datediff(CAST(:as_of AS DATE), list_date) AS days_on_market "
        "FROM {listings} WHERE address = :address",
        args={"address": SELECTED_ADDRESS, "as_of": AS_OF},
        listings=listings(spark, sf_dir),
    )


def _sql_compare(bin_col: str, order_sql: str):
    def run(spark, sf_dir):
        return spark.sql(
            f"""
            SELECT /*+ BROADCAST(s) */ l.{bin_col},
                   CAST(sum(l.listing_price) AS DOUBLE) / count(l.listing_price) AS avg_listing_price
            FROM {{listings}} l
            JOIN (SELECT city, property_type FROM {{listings}} WHERE address = :address LIMIT 1) s
              ON l.city = s.city AND l.property_type = s.property_type
            GROUP BY l.{bin_col}
            ORDER BY {order_sql}
            """,
            args={"address": SELECTED_ADDRESS},
            listings=listings(spark, sf_dir),
        )

    return run


AGE_ORDER_SQL = (
    "CASE "
    + " ".join(f"WHEN age_range = '{label}' THEN {i}" for i, (_, label) in enumerate(AF.AGE_BINS))
    + " END ASC NULLS LAST"
)
q_sql_compare_by_sqft = _sql_compare("sqft_range", "sqft_range")
q_sql_compare_by_age = _sql_compare("age_range", AGE_ORDER_SQL)


# --- enrichment ----------------------------------------------------------------


def q_enrich_listings(spark, sf_dir):
    return enriched(spark, sf_dir)


def q_derive_address(spark, sf_dir):
    return raw_listings(spark, sf_dir).select("source_id", AF.address().alias("address"))


def q_derive_listing_price(spark, sf_dir):
    return raw_listings(spark, sf_dir).select(
        "source_id", "sqft", "property_type", AF.listing_price().alias("listing_price")
    )


def q_price_per_sqft(spark, sf_dir):
    return raw_listings(spark, sf_dir).select(
        "source_id", "property_type", AF.price_per_sqft().alias("price_per_sqft")
    )


def q_bin_sqft(spark, sf_dir):
    return raw_listings(spark, sf_dir).select("source_id", "sqft", AF.sqft_range().alias("sqft_range"))


def q_bin_age(spark, sf_dir):
    return raw_listings(spark, sf_dir).select("source_id", "age", AF.age_range().alias("age_range"))


def q_cast_columns(spark, sf_dir):
    """JSON-typed values (double sizes, text dates) cast to the table types."""
    raw = raw_listings(spark, sf_dir)
    json_typed = raw.select(
        "source_id",
        F.col("street_number").cast("bigint").alias("street_number"),
        F.col("age").cast("double").alias("age"),
        F.col("sqft").cast("double").alias("sqft"),
        F.col("number_bedrooms").cast("bigint").alias("number_bedrooms"),
        F.col("list_date").cast("string").alias("list_date"),
    )
    return json_typed.select(*cast_columns(json_typed))


def q_listings_snapshot(spark, sf_dir):
    return listings(spark, sf_dir)


def q_project_keys(spark, sf_dir):
    return reports.project_keys(listings(spark, sf_dir))


# --- reports ---------------------------------------------------------------------


def _on_listings(fn, *args):
    return lambda spark, sf_dir: fn(listings(spark, sf_dir), *args)


def _on_stored(fn, *args):
    return lambda spark, sf_dir: fn(stored_listings(spark, sf_dir), *args)


# --- snapshot changes and churn ---------------------------------------------------


def q_insert_ignore(spark, sf_dir):
    current, batch = current_and_batch(spark, sf_dir)
    return snapshot.insert_ignore(current, batch)


def q_churn_sample_size(spark, sf_dir):
    return churn.sample_size_frame(listings(spark, sf_dir), PCT).select(
        "n", F.col("pct").cast("decimal(3,2)").alias("pct"), "k"
    )


def _with_unknown_id(table: DataFrame, rows: DataFrame, price=None) -> DataFrame:
    """Append one id above every id in the table (an id the table does not hold)."""
    unknown = table.agg((F.max("listing_id") + 1).alias("listing_id"))
    if price is not None:
        unknown = unknown.select("listing_id", F.lit(Decimal(price)).cast(PRICE_TYPE).alias("listing_price"))
    return rows.unionByName(unknown)


def q_delete_by_key(spark, sf_dir):
    table = stored_listings(spark, sf_dir)
    keys = _with_unknown_id(table, churn.churn_delete_keys(table, DELETE_SEED, PCT))
    return snapshot.delete_by_key(table, keys)


def q_upsert_price(spark, sf_dir):
    table = stored_listings(spark, sf_dir)
    delta = _with_unknown_id(table, churn.reprice_sample(table, UPDATE_SEED, PCT), UNKNOWN_PRICE)
    return snapshot.upsert_price(table, delta)


def q_insert_ignore_split_city(spark, sf_dir):
    """A batch without source ids in which every third address is spelled by
    another split into street and city, some with a null age."""
    current, batch = current_and_batch(spark, sf_dir)
    known = current.select(
        F.col("street_number"),
        F.concat("street_name", F.lit(", "), "city").alias("street_name"),
        F.lit("").alias("city"),
        F.col("address"),
        F.when(F.col("listing_id") % 2 == 0, F.col("age")).alias("age"),
        *[c for c in current.columns if c not in ("listing_id", "street_number", "street_name", "city", "address", "age")],
    ).where("listing_id % 3 = 0")
    twins = batch.drop("source_id").withColumn("age", F.lit(None).cast("int"))
    rows = batch.drop("source_id").unionByName(twins).unionByName(known)
    added = snapshot.insert_ignore(current, rows)
    return added.select("address", "city", "age", "listing_price")


def q_snapshot_by_city_roundtrip(spark, sf_dir):
    """Listings written by city and read back, with empty and null cities among them."""
    city = F.when(F.col("listing_id") % 7 == 0, F.lit("")).when(F.col("listing_id") % 7 != 1, F.col("city"))
    table = listings(spark, sf_dir).withColumn("city", city)
    return store(spark, table, "by_city", partition_by_city=True).select(*LISTING_COLUMNS)


def q_upsert_price_repeated_ids(spark, sf_dir):
    """Every repriced id twice in the delta; the greatest price counts."""
    table = stored_listings(spark, sf_dir)
    delta = churn.reprice_sample(table, UPDATE_SEED, PCT)
    cheaper = delta.withColumn("listing_price", (F.col("listing_price") - 1).cast(PRICE_TYPE))
    return snapshot.upsert_price(table, _with_unknown_id(table, delta.unionByName(cheaper), UNKNOWN_PRICE))


def q_full_batch_run(spark, sf_dir):
    current, raw_batch = current_and_raw_batch(spark, sf_dir)
    config = RunConfig(DELETE_SEED, UPDATE_SEED, Decimal(PCT), Decimal(PCT))
    result, _ = run_batch(current, raw_batch, None, config)
    return result.select(*LISTING_COLUMNS)


def run_with_kept_sums(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The table after a full run, and the sums behind its peer averages: those of
    the table before, stored, brought forward by the run's changes alone."""
    current, raw_batch = current_and_raw_batch(spark, sf_dir)
    path = scratch_path(spark, "peer_sums")
    peers.peer_state(current).write.parquet(path)
    config = RunConfig(DELETE_SEED, UPDATE_SEED, Decimal(PCT), Decimal(PCT))
    table, changes = plan_run(current, raw_batch, None, config)
    delta = peers.peer_changes(changes.new_rows, changes.deleted_rows, changes.repriced_rows)
    return table, peers.apply_changes(spark.read.schema(PEER_STATE).parquet(path), delta)


def q_kept_peer_sums(spark, sf_dir):
    return run_with_kept_sums(spark, sf_dir)[1]


def _kept(fn, kind: str):
    def run(spark, sf_dir):
        table, state = run_with_kept_sums(spark, sf_dir)
        return fn(state, table, SELECTED_ADDRESS, kind)

    return run


def q_kept_price_vs_age_peers(spark, sf_dir):
    table, state = run_with_kept_sums(spark, sf_dir)
    return peers.price_vs_kept_peers(table, state, "age")


BUCKETS, PARTS = 16, 32  # of the test tables; a cluster's snapshot has as many as hold some hundred MB each


def bucketed_listings(spark: SparkSession, table: DataFrame) -> bucketed.BucketedSnapshot:
    path = scratch_path(spark, "bucketed")
    bucketed.write_bucketed(table, path, BUCKETS)
    return bucketed.read_bucketed(spark, path)


def q_bucketed_insert_ignore(spark, sf_dir):
    current, batch = current_and_batch(spark, sf_dir)
    return bucketed.insert_ignore_bucketed(bucketed_listings(spark, current), batch)


def q_bucketed_delete_by_key(spark, sf_dir):
    snap = bucketed_listings(spark, listings(spark, sf_dir))
    keys = _with_unknown_id(snap.listings, churn.churn_delete_keys(snap.listings, DELETE_SEED, PCT))
    return bucketed.delete_by_key_bucketed(snap, keys)


def q_bucketed_upsert_price(spark, sf_dir):
    snap = bucketed_listings(spark, listings(spark, sf_dir))
    delta = _with_unknown_id(snap.listings, churn.reprice_sample(snap.listings, UPDATE_SEED, PCT), UNKNOWN_PRICE)
    return bucketed.upsert_price_bucketed(snap, delta)


def q_change_in_place(spark, sf_dir):
    """Corrections by key: the selected listing goes, listings with street number 1 get a new price."""
    path = scratch_path(spark, "in_parts")
    in_place.write_parts(listings(spark, sf_dir), path, PARTS)
    table = in_place.read_parts(spark, path)
    gone = table.where(F.col("address") == SELECTED_ADDRESS).select("listing_id")
    dearer = table.where("street_number = 1").select("listing_id", (F.col("listing_price") + 1).cast(PRICE_TYPE).alias("listing_price"))
    dearer = dearer.join(gone, "listing_id", "left_anti")
    in_place.change_in_place(spark, path, gone, dearer)
    return in_place.read_parts(spark, path).select(*LISTING_COLUMNS)


def q_broken_constraints(spark, sf_dir):
    """Raw listings are no table yet: addresses repeat, and every tenth listing is offered twice."""
    rows = enriched(spark, sf_dir).withColumnRenamed("source_id", "listing_id").select("listing_id", "address")
    return constraints.broken_constraints(rows.unionByName(rows.where("listing_id % 10 = 0")))


def q_quarantine_raw_lines(spark, sf_dir):
    """Lines of a batch by what became of them: a third is cut short, has a text as size, or isn't an object."""
    raw = raw_listings(spark, sf_dir)
    line = F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_JSON.fields if f.name in raw.columns]))
    kind = F.col("source_id") % 9
    text = (
        F.when(kind == 3, F.expr("substring(line, 1, length(line) - 1)"))
        .when(kind == 5, F.regexp_replace("line", '"sqft":[^,]*', '"sqft":"n/a"'))
        .when(kind == 7, F.concat(F.lit("["), F.col("line"), F.lit("]")))
        .otherwise(F.col("line"))
    )
    path = scratch_path(spark, "raw_with_bad_lines")
    raw.select("source_id", line.alias("line")).select(text.alias("value")).write.text(path)
    good, rejects = split_raw_jsonl(spark, path)
    outcomes = good.select(F.lit("accepted").alias("reason"), F.lit("").alias("fields")).unionByName(
        rejects.select("reason", F.array_join("fields", ",").alias("fields"))
    )
    return outcomes.groupBy("reason", "fields").agg(F.count(F.lit(1)).alias("n"))


def _sql_function(query: str):
    def run(spark, sf_dir):
        sql_functions.register(spark, listings(spark, sf_dir), "listings_of_functions")
        return spark.sql(query, args={"address": SELECTED_ADDRESS})

    return run


def q_listing_lookup_bloom(spark, sf_dir):
    path = scratch_path(spark, "with_bloom")
    write_snapshot(listings(spark, sf_dir), path, bloom_addresses=100_000)
    return reports.listing_lookup(read_snapshot(spark, path), SELECTED_ADDRESS)


def q_address_search_indexed(spark, sf_dir):
    path = scratch_path(spark, "search_index")
    search_index.write_search_index(listings(spark, sf_dir), path, BUCKETS, PARTS)
    return search_index.search_by_index(spark, path, SEARCH_TERM)


def queries() -> dict[str, Query]:
    return {
        "scan_raw_jsonl": q_scan_raw_jsonl,
        "scan_snapshot": q_scan_snapshot,
        "sink_parquet_roundtrip": q_sink_parquet_roundtrip,
        "sql_listing_lookup": q_sql_listing_lookup,
        "sql_compare_by_sqft": q_sql_compare_by_sqft,
        "sql_compare_by_age": q_sql_compare_by_age,
        "enrich_listings": q_enrich_listings,
        "derive_address": q_derive_address,
        "derive_listing_price": q_derive_listing_price,
        "price_per_sqft": q_price_per_sqft,
        "bin_sqft": q_bin_sqft,
        "bin_age": q_bin_age,
        "cast_columns": q_cast_columns,
        "listings_snapshot": q_listings_snapshot,
        "project_keys": q_project_keys,
        "listing_count": _on_listings(reports.listing_count),
        "listing_lookup": _on_listings(reports.listing_lookup, SELECTED_ADDRESS),
        "listing_detail": _on_listings(reports.listing_detail, AS_OF),
        "listing_card": _on_listings(reports.listing_card, SELECTED_ADDRESS, AS_OF),
        "days_on_market": _on_listings(reports.days_on_market, AS_OF),
        "format_price": _on_listings(reports.format_price),
        "photoset_bucket": _on_listings(reports.photoset_bucket),
        "address_options": _on_listings(reports.address_options),
        "address_search": _on_listings(reports.address_search, SEARCH_TERM),
        "similar_listings": _on_listings(reports.similar_listings, SELECTED_ADDRESS),
        "compare_by_sqft": _on_listings(reports.compare_by_sqft, SELECTED_ADDRESS),
        "compare_by_age": _on_listings(reports.compare_by_age, SELECTED_ADDRESS),
        "overlay_by_sqft": _on_listings(reports.overlay_by_sqft, SELECTED_ADDRESS),
        "overlay_by_age": _on_listings(reports.overlay_by_age, SELECTED_ADDRESS),
        "price_vs_sqft_peers": _on_stored(reports.price_vs_sqft_peers),
        "price_vs_age_peers": _on_stored(reports.price_vs_age_peers),
        "insert_ignore": q_insert_ignore,
        "churn_sample_size": q_churn_sample_size,
        "churn_delete_keys": _on_stored(churn.churn_delete_keys, DELETE_SEED, PCT),
        "churn_delete_rows": _on_stored(churn.churn_delete_rows, DELETE_SEED, PCT),
        "delete_by_key": q_delete_by_key,
        "apply_churn_delete": _on_stored(churn.apply_churn_delete, DELETE_SEED, PCT),
        "reprice_sample": _on_stored(churn.reprice_sample, UPDATE_SEED, PCT),
        "upsert_price": q_upsert_price,
        "apply_churn_update": _on_stored(churn.apply_churn_update, UPDATE_SEED, PCT),
        "insert_ignore_split_city": q_insert_ignore_split_city,
        "snapshot_by_city_roundtrip": q_snapshot_by_city_roundtrip,
        "upsert_price_repeated_ids": q_upsert_price_repeated_ids,
        "full_batch_run": q_full_batch_run,
        "kept_peer_sums": q_kept_peer_sums,
        "kept_compare_by_sqft": _kept(peers.compare_kept, "sqft"),
        "kept_overlay_by_age": _kept(peers.overlay_kept, "age"),
        "kept_price_vs_age_peers": q_kept_price_vs_age_peers,
        "broken_constraints": q_broken_constraints,
        "quarantine_raw_lines": q_quarantine_raw_lines,
        "function_similar_homes": _sql_function("SELECT * FROM similar_homes(:address)"),
        "function_compare_by_sqft": _sql_function("SELECT sqft_range, avg_listing_price FROM compare_by_sqft(:address) ORDER BY sqft_range"),
        "function_overlay_by_age": _sql_function(
            "SELECT age_range, avg_listing_price, selected_price, price_minus_avg FROM compare_by_age(:address) ORDER BY place NULLS LAST"
        ),
        "listing_lookup_bloom": q_listing_lookup_bloom,
        "address_search_indexed": q_address_search_indexed,
        "change_in_place": q_change_in_place,
        "bucketed_insert_ignore": q_bucketed_insert_ignore,
        "bucketed_delete_by_key": q_bucketed_delete_by_key,
        "bucketed_upsert_price": q_bucketed_upsert_price,
    }


__all__ = ["queries", "listings", "enriched", "stored_listings"]
