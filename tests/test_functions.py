from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode import functions as AF
from abode.operators.enrich import enrich
from tests.helpers import raw_frame, raw_row


def _eval(spark, values, dtype, expr_fn):
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("v", dtype)]))
    return [r[0] for r in df.select(expr_fn(F.col("v"))).collect()]


def test_sqft_bins_edges(spark):
    got = _eval(spark, [1499, 1500, 1999, 2000, 9999, None], T.IntegerType(), AF.sqft_range)
    assert got == ["0-1499", "1500-1999", "1500-1999", "2000-2499", "2000-2499", "2000-2499"]


def test_age_bins_edges(spark):
    ages = [5, 6, 10, 11, 15, 16, 20, 21, 25, 26, None]
    got = _eval(spark, ages, T.IntegerType(), AF.age_range)
    assert got == ["0-5", "6-10", "6-10", "11-15", "11-15", "16-20", "16-20", "21-25", "21-25", "26+", "26+"]


def test_rate_per_property_type(spark):
    types = ["semi-detached", "single-detached", "townhome", "other", None]
    assert _eval(spark, types, T.StringType(), AF.price_per_sqft) == [487, 512, 472, 472, 472]


def test_address_null_when_any_part_null(spark):
    df = raw_frame(spark, [raw_row(1, 12, "O'Neil Ave", "St. John's"), raw_row(2, 12, None)])
    got = [r[0] for r in df.orderBy("source_id").select(AF.address()).collect()]
    assert got == ["12 O'Neil Ave, St. John's", None]


def test_price_text_and_bool_text(spark):
    df = spark.createDataFrame(
        [(Decimal("1234567.50"), True), (Decimal("987.00"), False), (None, None)],
        "p decimal(12,2), b boolean",
    )
    rows = df.select(AF.price_text("p"), AF.bool_text("b")).collect()
    assert [tuple(r) for r in rows] == [("$1,234,567.50", "True"), ("$987.00", "False"), (None, None)]


def test_days_on_market(spark):
    df = spark.createDataFrame([("2023-12-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    assert df.select(AF.days_on_market("d", "2024-01-01")).first()[0] == 31


def test_photoset_is_stable_and_in_range(spark):
    df = spark.createDataFrame([(f"{i} Main, Springfield",) for i in range(200)] + [(None,)], "address string")
    got = [r[0] for r in df.select(AF.photoset("address")).collect()]
    assert set(got[:-1]) == {1, 2, 3} and got[-1] is None
    again = [r[0] for r in df.select(AF.photoset("address")).collect()]
    assert got == again


def test_reprice_factor_values(spark):
    df = spark.range(2000).select(F.col("id").alias("listing_id"))
    factors = {r[0] for r in df.select(AF.reprice_factor("listing_id", 89)).distinct().collect()}
    assert factors == {Decimal(f) for f in AF.REPRICE_FACTORS}
    assert Decimal("1.00") not in factors


def test_enrich_bins_use_uncast_values(spark):
    # JSON values 1499.9 sqft and 5.9 years: bins see the fraction, columns are cast.
    df = spark.createDataFrame(
        [(1, 12, "Main", "Springfield", 5.9, 1499.9, True, 3, "2023-05-01", "townhome", "listing")],
        "source_id long, street_number long, street_name string, city string, age double, "
        "sqft double, finished_basement boolean, number_bedrooms long, list_date string, "
        "property_type string, type string",
    )
    row = enrich(df).first()
    assert row["sqft_range"] == "0-1499" and row["age_range"] == "0-5"
    assert row["sqft"] == 1499 and row["age"] == 5
    assert row["listing_price"] == Decimal("707952.80")  # 1499.9 * 472
    assert str(row["list_date"]) == "2023-05-01"
    assert "type" not in enrich(df).columns


def test_enrich_has_no_python_udf(spark):
    df = enrich(raw_frame(spark, [raw_row(1)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
