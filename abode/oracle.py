"""Independent SQL statements of every registered query, for DuckDB.

Each statement starts from the supplied tables (``orders``, ``customer``,
``nation``) and rebuilds the listings with plain SQL: ``row_number`` windows
where the Spark side aggregates, ``ORDER BY ... LIMIT`` where the Spark side
uses hash-prefix histograms, ``NOT EXISTS`` where it uses anti joins. The
fixed values (rates, bin edges, factors) come from :mod:`abode.functions`, so
both sides state them once.
"""

from __future__ import annotations

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
from abode.schemas import LISTING_COLUMNS


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


RATE_SQL = (
    f"CASE WHEN property_type = 'semi-detached' THEN 487 "
    f"WHEN property_type = 'single-detached' THEN 512 "
    f"ELSE 472 END"
)
ADDRESS_SQL = "CAST(street_number AS STRING) || ' ' || street_name || ', ' || city"
PRICE_SQL = f"CAST(sqft * {RATE_SQL} AS DECIMAL(12,2))"
SQFT_RANGE_SQL = "CASE WHEN sqft < 1500 THEN '0-1499' WHEN sqft < 2000 THEN '1500-1999' ELSE '2000-2499' END"
AGE_RANGE_SQL = (
    "CASE WHEN age < 6 THEN '0-5' WHEN age < 11 THEN '6-10' WHEN age < 16 THEN '11-15' "
    "WHEN age < 21 THEN '16-20' WHEN age < 26 THEN '21-25' ELSE '26+' END"
)
AVG_SQL = "CAST(sum(listing_price) AS DOUBLE) / count(listing_price)"
RAW_COLS = (
    "source_id, street_number, street_name, city, age, sqft, finished_basement, "
    "number_bedrooms, list_date, property_type"
)
ENRICHED_COLS = RAW_COLS + ", address, listing_price, sqft_range, age_range"
LCOLS = ", ".join(LISTING_COLUMNS)
LCOLS_NO_ID = ", ".join(LISTING_COLUMNS[1:])


def _hex_bucket(text_sql: str, buckets: int) -> str:
    return f"CAST('0x' || substr(md5({text_sql}), 1, 8) AS BIGINT) % {buckets}"


def _sample_hash(seed: int, key: str = "listing_id") -> str:
    return f"md5('{seed}:' || CAST({key} AS STRING))"


def _factor(seed: int, key: str = "listing_id") -> str:
    bucket = _hex_bucket(f"'{seed}:factor:' || CAST({key} AS STRING)", 8)
    return (
        f"CAST(CASE {bucket} WHEN 0 THEN 0.97 WHEN 1 THEN 0.98 WHEN 2 THEN 0.98 WHEN 3 THEN 0.99 "
        "WHEN 4 THEN 1.01 WHEN 5 THEN 1.02 WHEN 6 THEN 1.02 WHEN 7 THEN 1.03 END AS DECIMAL(3,2))"
    )


def _new_price(seed: int) -> str:
    return f"CAST(round(listing_price * {_factor(seed)}, 2) AS DECIMAL(12,2))"


def _sample_keys(table: str, seed: int, pct) -> str:
    return (
        f"SELECT listing_id FROM {table} WHERE listing_id IS NOT NULL "
        f"ORDER BY {_sample_hash(seed)}, listing_id "
        f"LIMIT (SELECT CAST(round_even(count(listing_id) * {pct}, 0) AS BIGINT) FROM {table})"
    )


def _dedup(source: str) -> str:
    return (
        f"SELECT {ENRICHED_COLS} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY address ORDER BY source_id) AS rn FROM {source}) d "
        "WHERE address IS NULL OR rn = 1"
    )


RAW_CTE = """raw AS (
  SELECT o.o_orderkey AS source_id,
         CAST(o.o_orderkey % 500 + 1 AS INTEGER) AS street_number,
         c.c_mktsegment AS street_name,
         n.n_name AS city,
         CAST(o.o_orderkey % 41 AS INTEGER) AS age,
         CAST(900 + CAST(floor(o.o_totalprice) AS BIGINT) % 1600 AS INTEGER) AS sqft,
         o.o_orderkey % 2 = 0 AS finished_basement,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS number_bedrooms,
         CAST(o.o_orderdate AS DATE) AS list_date,
         CASE WHEN o.o_orderstatus = 'F' THEN 'semi-detached'
              WHEN o.o_orderstatus = 'O' THEN 'single-detached'
              ELSE 'townhome' END AS property_type
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

ENRICHED_CTE = f"""enriched AS (
  SELECT {RAW_COLS},
         {ADDRESS_SQL} AS address,
         {PRICE_SQL} AS listing_price,
         {SQFT_RANGE_SQL} AS sqft_range,
         {AGE_RANGE_SQL} AS age_range
  FROM raw
)"""

LISTINGS_CTE = f"""listings AS (
  SELECT source_id AS listing_id, {LCOLS_NO_ID} FROM ({_dedup('enriched')}) u
)"""

BASE = f"WITH {RAW_CTE},\n{ENRICHED_CTE},\n{LISTINGS_CTE}"

# Insert chain: listings dated before BATCH_SINCE form the current table, the
# others arrive as one batch. Together they are the whole table.
_OLDER = f"coalesce(list_date < DATE '{BATCH_SINCE}', false)"
INSERT_CTES = f""",
cur AS (
  SELECT source_id AS listing_id, {LCOLS_NO_ID}
  FROM ({_dedup(f'(SELECT * FROM enriched WHERE {_OLDER})')}) c0
),
batch_u AS ({_dedup(f'(SELECT * FROM enriched WHERE NOT {_OLDER})')}),
fresh AS (
  SELECT * FROM batch_u b
  WHERE b.address IS NULL OR NOT EXISTS (SELECT 1 FROM cur c WHERE c.address = b.address)
),
inserted AS (
  SELECT {LCOLS} FROM cur
  UNION ALL
  SELECT (SELECT max(listing_id) FROM cur) + row_number() OVER (ORDER BY source_id) AS listing_id,
         {LCOLS_NO_ID}
  FROM fresh
)"""


def _churn_ctes(source: str, prefix: str) -> str:
    """``<prefix>_deleted``: source minus its seed-88 sample;
    ``<prefix>_updated``: that table with its seed-89 sample re-priced."""
    del_keys = _sample_keys(source, DELETE_SEED, PCT)
    deleted = f"{prefix}_deleted"
    upd_keys = _sample_keys(deleted, UPDATE_SEED, PCT)
    return f""",
{deleted} AS (
  SELECT * FROM {source} WHERE listing_id NOT IN ({del_keys})
),
{prefix}_upd_keys AS ({upd_keys}),
{prefix}_updated AS (
  SELECT listing_id, {', '.join(c for c in LISTING_COLUMNS[1:] if c != 'listing_price')},
         CASE WHEN listing_id IN (SELECT listing_id FROM {prefix}_upd_keys)
              THEN {_new_price(UPDATE_SEED)} ELSE listing_price END AS listing_price
  FROM {deleted}
)"""


def _segment_cte(table: str = "listings") -> str:
    return f""",
sel AS (
  SELECT city, property_type, listing_price AS selected_price
  FROM {table} WHERE address = {_q(SELECTED_ADDRESS)} LIMIT 1
)"""


def _compare(bin_col: str, base: str = BASE, table: str = "listings") -> str:
    return (
        base
        + _segment_cte(table)
        + f"""
SELECT l.{bin_col}, {AVG_SQL.replace('listing_price', 'l.listing_price')} AS avg_listing_price
FROM {table} l JOIN sel s ON l.city = s.city AND l.property_type = s.property_type
GROUP BY l.{bin_col}"""
    )


def _overlay(bin_col: str, base: str = BASE, table: str = "listings") -> str:
    avg = AVG_SQL.replace("listing_price", "l.listing_price")
    return (
        base
        + _segment_cte(table)
        + f"""
SELECT l.{bin_col}, {avg} AS avg_listing_price, s.selected_price,
       CAST(s.selected_price AS DOUBLE) - {avg} AS price_minus_avg
FROM {table} l JOIN sel s ON l.city = s.city AND l.property_type = s.property_type
GROUP BY l.{bin_col}, s.selected_price"""
    )


def _peers(bin_col: str, base: str = BASE, table: str = "listings") -> str:
    return (
        base
        + f""",
peers AS (
  SELECT city, property_type, {bin_col}, {AVG_SQL} AS avg_listing_price, count(*) AS peer_count
  FROM {table} GROUP BY city, property_type, {bin_col}
)
SELECT l.listing_id, l.address, l.city, l.property_type, l.{bin_col}, l.listing_price,
       p.avg_listing_price, p.peer_count,
       CAST(l.listing_price AS DOUBLE) - p.avg_listing_price AS price_minus_avg
FROM {table} l JOIN peers p
  ON l.city IS NOT DISTINCT FROM p.city
 AND l.property_type IS NOT DISTINCT FROM p.property_type
 AND l.{bin_col} IS NOT DISTINCT FROM p.{bin_col}"""
    )


DAYS_SQL = f"CAST(DATE '{AS_OF}' - list_date AS INTEGER)"
PRICE_TEXT_SQL = "'$' || format('{:,.2f}', CAST(listing_price AS DOUBLE))"
BOOL_TEXT_SQL = (
    "CASE WHEN finished_basement THEN 'True' WHEN NOT finished_basement THEN 'False' END"
)
ENRICHED_SELECT = f"SELECT {ENRICHED_COLS} FROM enriched"


UNKNOWN_ID_SQL = "(SELECT max(listing_id) + 1 FROM listings)"
UPSERT_SQL = f""",
delta AS (
  SELECT listing_id, {_new_price(UPDATE_SEED)} AS new_price FROM listings
  WHERE listing_id IN ({_sample_keys('listings', UPDATE_SEED, PCT)})
  UNION ALL SELECT {UNKNOWN_ID_SQL}, CAST({UNKNOWN_PRICE} AS DECIMAL(12,2))
)
SELECT COALESCE(l.listing_id, d.listing_id) AS listing_id,
       {', '.join('l.' + c for c in LISTING_COLUMNS[1:] if c != 'listing_price')},
       COALESCE(d.new_price, l.listing_price) AS listing_price
FROM listings l FULL OUTER JOIN delta d ON l.listing_id = d.listing_id"""


def oracle_sql() -> dict[str, str]:
    churn_listings = _churn_ctes("listings", "l")
    full_run = BASE + INSERT_CTES + _churn_ctes("inserted", "r")
    similar = (
        BASE
        + _segment_cte()
        + f"\nSELECT {', '.join('l.' + c for c in LISTING_COLUMNS)} FROM listings l "
        "JOIN sel s ON l.city = s.city AND l.property_type = s.property_type"
    )
    lookup = f"{BASE}\nSELECT {LCOLS} FROM listings WHERE address = {_q(SELECTED_ADDRESS)}"
    address_search = (
        f"{BASE}\nSELECT listing_id, address FROM listings WHERE contains(lower(address), lower({_q(SEARCH_TERM)}))"
    )
    delete_by_key = (
        f"{BASE}\nSELECT {LCOLS} FROM listings WHERE listing_id NOT IN "
        f"(SELECT listing_id FROM ({_sample_keys('listings', DELETE_SEED, PCT)}) k UNION ALL SELECT {UNKNOWN_ID_SQL})"
    )
    return {
        # sources and sinks
        "scan_raw_jsonl": f"{BASE}\n{ENRICHED_SELECT}",
        "scan_snapshot": f"{BASE}\nSELECT {LCOLS} FROM listings",
        "broken_constraints": f"""WITH {RAW_CTE},
{ENRICHED_CTE},
offered AS (SELECT source_id, address FROM enriched UNION ALL SELECT source_id, address FROM enriched WHERE source_id % 10 = 0)
SELECT 'unique_listing_id' AS constraint, CAST(source_id AS VARCHAR) AS key, count(*) AS n FROM offered GROUP BY source_id HAVING count(*) > 1
UNION ALL
SELECT 'unique_address', address, count(*) FROM offered WHERE address IS NOT NULL GROUP BY address HAVING count(*) > 1""",
        "quarantine_raw_lines": f"WITH {RAW_CTE}\nSELECT reason, CASE WHEN reason = 'wrong type' THEN 'sqft' ELSE '' END AS fields, "
        "count(*) AS n FROM (SELECT CASE source_id % 9 WHEN 3 THEN 'not JSON' WHEN 5 THEN 'wrong type' WHEN 7 THEN 'not an object' "
        "ELSE 'accepted' END AS reason FROM raw) GROUP BY ALL",
        "sink_parquet_roundtrip": f"{BASE}\n{ENRICHED_SELECT}",
        "sql_listing_lookup": f"{BASE}\nSELECT *, {DAYS_SQL} AS days_on_market FROM listings "
        f"WHERE address = {_q(SELECTED_ADDRESS)}",
        # enrichment
        "enrich_listings": f"{BASE}\n{ENRICHED_SELECT}",
        "derive_address": f"{BASE}\nSELECT source_id, address FROM enriched",
        "derive_listing_price": f"{BASE}\nSELECT source_id, sqft, property_type, listing_price FROM enriched",
        "price_per_sqft": f"{BASE}\nSELECT source_id, property_type, {RATE_SQL} AS price_per_sqft FROM raw",
        "bin_sqft": f"{BASE}\nSELECT source_id, sqft, sqft_range FROM enriched",
        "bin_age": f"{BASE}\nSELECT source_id, age, age_range FROM enriched",
        "cast_columns": f"{BASE}\nSELECT source_id, street_number, age, sqft, number_bedrooms, list_date FROM raw",
        "listings_snapshot": f"{BASE}\nSELECT {LCOLS} FROM listings",
        "project_keys": f"{BASE}\nSELECT listing_id FROM listings",
        # reports
        "listing_count": f"{BASE}\nSELECT count(*) AS listing_count FROM listings",
        "listing_lookup": lookup,
        "listing_lookup_bloom": lookup,
        "listing_detail": f"{BASE}\nSELECT {LCOLS}, {DAYS_SQL} AS days_on_market, "
        f"{PRICE_TEXT_SQL} AS price_text, {BOOL_TEXT_SQL} AS finished_basement_text FROM listings",
        "listing_card": f"{BASE}\nSELECT address, number_bedrooms, property_type, {PRICE_TEXT_SQL} AS price_text, "
        f"sqft, age, {DAYS_SQL} AS days_on_market, {BOOL_TEXT_SQL} AS finished_basement_text "
        f"FROM listings WHERE address = {_q(SELECTED_ADDRESS)}",
        "days_on_market": f"{BASE}\nSELECT listing_id, {DAYS_SQL} AS days_on_market FROM listings",
        "format_price": f"{BASE}\nSELECT listing_id, {PRICE_TEXT_SQL} AS price_text FROM listings",
        "photoset_bucket": f"{BASE}\nSELECT listing_id, address, "
        f"{_hex_bucket('address', 3)} + 1 AS photoset FROM listings",
        "address_options": f"{BASE}\nSELECT address FROM listings WHERE address IS NOT NULL ORDER BY address",
        "address_search": address_search,
        "address_search_indexed": address_search,
        "similar_listings": similar,
        "function_similar_homes": similar,
        "function_compare_by_sqft": _compare("sqft_range"),
        "function_overlay_by_age": _overlay("age_range"),
        "sql_compare_by_sqft": _compare("sqft_range"),
        "sql_compare_by_age": _compare("age_range"),
        "compare_by_sqft": _compare("sqft_range"),
        "compare_by_age": _compare("age_range"),
        "overlay_by_sqft": _overlay("sqft_range"),
        "overlay_by_age": _overlay("age_range"),
        "price_vs_sqft_peers": _peers("sqft_range"),
        "price_vs_age_peers": _peers("age_range"),
        # snapshot changes and churn
        "insert_ignore": BASE + INSERT_CTES + f"\nSELECT {LCOLS} FROM inserted",
        "insert_ignore_split_city": BASE + INSERT_CTES + f""",
late AS (SELECT * FROM enriched WHERE NOT {_OLDER}),
offered AS (SELECT * FROM late UNION ALL SELECT * REPLACE (CAST(NULL AS INTEGER) AS age) FROM late WHERE address IS NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY address ORDER BY street_number NULLS LAST, street_name NULLS LAST,
    city NULLS LAST, age NULLS LAST, sqft NULLS LAST, finished_basement NULLS LAST, number_bedrooms NULLS LAST,
    list_date NULLS LAST, property_type NULLS LAST) AS k FROM offered
)
SELECT address, city, age, listing_price FROM cur
UNION ALL
SELECT address, city, age, listing_price FROM ranked
WHERE address IS NULL OR (k = 1 AND address NOT IN (SELECT address FROM cur WHERE address IS NOT NULL))""",
        "snapshot_by_city_roundtrip": f"{BASE}\nSELECT * REPLACE (CASE listing_id % 7 WHEN 0 THEN '' "
        f"WHEN 1 THEN NULL ELSE city END AS city) FROM (SELECT {LCOLS} FROM listings)",
        "upsert_price_repeated_ids": BASE + UPSERT_SQL,
        "churn_sample_size": f"{BASE}\nSELECT count(listing_id) AS n, CAST({PCT} AS DECIMAL(3,2)) AS pct, "
        f"CAST(round_even(count(listing_id) * {PCT}, 0) AS BIGINT) AS k FROM listings",
        "churn_delete_keys": f"{BASE}\n{_sample_keys('listings', DELETE_SEED, PCT)}",
        "churn_delete_rows": f"{BASE}\nSELECT {LCOLS} FROM listings WHERE listing_id IN "
        f"({_sample_keys('listings', DELETE_SEED, PCT)})",
        "delete_by_key": delete_by_key,
        "apply_churn_delete": BASE + churn_listings + f"\nSELECT {LCOLS} FROM l_deleted",
        "reprice_sample": f"{BASE}\nSELECT listing_id, {_new_price(UPDATE_SEED)} AS listing_price "
        f"FROM listings WHERE listing_id IN ({_sample_keys('listings', UPDATE_SEED, PCT)})",
        "upsert_price": BASE + UPSERT_SQL,
        "apply_churn_update": BASE
        + f""",
upd_keys AS ({_sample_keys('listings', UPDATE_SEED, PCT)})
SELECT listing_id, {', '.join(c for c in LISTING_COLUMNS[1:] if c != 'listing_price')},
       CASE WHEN listing_id IN (SELECT listing_id FROM upd_keys)
            THEN {_new_price(UPDATE_SEED)} ELSE listing_price END AS listing_price
FROM listings""",
        "full_batch_run": full_run + f"\nSELECT {LCOLS} FROM r_updated",
        # peer averages kept through the run: the aggregate over the table after it
        "kept_peer_sums": full_run
        + "\nUNION ALL\n".join(
            f"\nSELECT city, property_type, '{kind}' AS bin_kind, {column} AS bin, "
            "CAST(coalesce(sum(listing_price), 0) AS DECIMAL(38,2)) AS price_sum, "
            "count(listing_price) AS priced, count(*) AS listings FROM r_updated GROUP BY city, property_type, " + column
            for kind, column in (("sqft", "sqft_range"), ("age", "age_range"))
        ),
        "kept_compare_by_sqft": _compare("sqft_range", full_run, "r_updated"),
        "kept_overlay_by_age": _overlay("age_range", full_run, "r_updated"),
        "change_in_place": f"{BASE}\nSELECT * REPLACE (CAST(CASE WHEN street_number = 1 THEN listing_price + 1 ELSE listing_price END "
        f"AS DECIMAL(12,2)) AS listing_price) FROM (SELECT {LCOLS} FROM listings) WHERE address IS DISTINCT FROM {_q(SELECTED_ADDRESS)}",
        # the same changes on tables laid out in buckets
        "bucketed_insert_ignore": BASE + INSERT_CTES + f"\nSELECT {LCOLS} FROM inserted",
        "bucketed_delete_by_key": delete_by_key,
        "bucketed_upsert_price": BASE + UPSERT_SQL,
        "kept_price_vs_age_peers": _peers("age_range", full_run, "r_updated"),
    }
