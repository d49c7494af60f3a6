"""The dashboard's questions as SQL table functions.

``SELECT * FROM similar_homes('12 Main St, Springfield')``: Spark puts a SQL
function's body into the query that calls it, so filters and columns of both are
planned together and the address still reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from abode import functions as AF
from abode.schemas import LISTINGS, LISTING_COLUMNS

SELECTED = "SELECT city AS c, property_type AS t, listing_price AS selected_price FROM {view} WHERE address = {name}.selected LIMIT 1"
AVERAGE = "CAST(sum(listing_price) AS DOUBLE) / count(listing_price)"


def _columns(names: list[str]) -> str:
    return ", ".join(f"{n} {LISTINGS[n].dataType.simpleString()}" for n in names)


def register(spark: SparkSession, listings: DataFrame, view: str = "listings") -> list[str]:
    """Define the functions over ``listings``, which becomes the temporary view ``view``; returns their names.

    * ``listing_by_address(selected)``: the row of an address;
    * ``similar_homes(selected)``: listings of its city and property type;
    * ``compare_by_sqft(selected)``, ``compare_by_age(selected)``: average price of similar homes per range,
      the selected price and the gap (order by ``place``);
    * ``search_addresses(term)``: ids and addresses that contain the term, whatever the case.
    """
    listings.createOrReplaceTempView(view)
    columns = _columns(LISTING_COLUMNS)
    names = ", ".join(LISTING_COLUMNS)
    age_place = "CASE bin " + " ".join(f"WHEN '{label}' THEN {i}" for i, (_, label) in enumerate(AF.AGE_BINS)) + " END"
    bodies = {
        "listing_by_address(selected STRING)": (columns, f"SELECT {names} FROM {view} WHERE address = listing_by_address.selected LIMIT 1"),
        "similar_homes(selected STRING)": (
            columns,
            f"SELECT /*+ BROADCAST(s) */ {names} FROM {view} l JOIN ({SELECTED.format(view=view, name='similar_homes')}) s "
            "ON l.city = s.c AND l.property_type = s.t",
        ),
        "search_addresses(term STRING)": (
            _columns(["listing_id", "address"]),
            f"SELECT listing_id, address FROM {view} WHERE contains(lower(address), lower(search_addresses.term))",
        ),
    }
    for kind, place in (("sqft", "CAST(NULL AS INT)"), ("age", age_place)):
        name = f"compare_by_{kind}"
        bodies[f"{name}(selected STRING)"] = (
            f"{kind}_range STRING, avg_listing_price DOUBLE, selected_price DECIMAL(12,2), price_minus_avg DOUBLE, place INT",
            f"SELECT bin, avg, selected_price, CAST(selected_price AS DOUBLE) - avg, {place} FROM ("
            f"SELECT /*+ BROADCAST(s) */ l.{kind}_range AS bin, s.selected_price AS selected_price, {AVERAGE} AS avg FROM {view} l "
            f"JOIN ({SELECTED.format(view=view, name=name)}) s ON l.city = s.c AND l.property_type = s.t "
            f"GROUP BY l.{kind}_range, s.selected_price)",
        )
    for head, (returns, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS TABLE ({returns}) RETURN {body}")
    return [head.partition("(")[0] for head in bodies]
