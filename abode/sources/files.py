"""File sources: raw JSON-lines batches and Parquet snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abode.schemas import LISTINGS, RAW_JSON
from abode.sinks import CITY_PART, city_part


def read_raw_jsonl(
    spark: SparkSession, path: str, schema: T.StructType = RAW_JSON, mode: str = "FAILFAST"
) -> DataFrame:
    """Read a raw listing batch with a fixed schema.

    No inference job runs over the input. ``FAILFAST`` (default) turns a
    malformed line (or a value of the wrong type) into a failed read instead
    of a silently all-null row; ``PERMISSIVE`` keeps such lines as null rows
    with the raw text in ``_corrupt_record``, as a schema-inferring read does.
    """
    reader = spark.read.option("mode", mode)
    if mode.upper() == "PERMISSIVE":
        schema = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.schema(schema).json(path)


NOT_JSON, NOT_OBJECT, WRONG_TYPE = "not JSON", "not an object", "wrong type"


def split_raw_jsonl(spark: SparkSession, path: str, schema: T.StructType = RAW_JSON) -> tuple[DataFrame, DataFrame]:
    """Good rows of a raw batch, and the lines that don't fit its schema.

    The rejects have ``file``, ``line`` (the text as it came), ``reason`` and ``fields``:
    a line is not JSON, not an object, or has values of a wrong type, whose fields are
    named. Blank lines count as neither, and text after a complete object is not
    seen, as Spark's parser stops there. An array of objects is rejected as a
    whole, though :func:`read_raw_jsonl` takes it apart. Both frames read the batch; nothing is
    kept in memory.
    """
    kept = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.from_json("value", kept, options).alias("row")
    )
    bad = F.col("row").isNull() | F.col("row._corrupt_record").isNotNull()
    good = rows.where(~bad).select(*[F.col(f"row.{c}").alias(c) for c in schema.fieldNames()])
    parsed = F.try_parse_json("line")
    reason = (
        F.when(parsed.isNull(), NOT_JSON)
        .when(~F.schema_of_variant(parsed).startswith("OBJECT"), NOT_OBJECT)
        .otherwise(WRONG_TYPE)
    )
    # present and not null in the line, null in the row
    fields = [F.when(F.get_json_object("line", f"$.{c}").isNotNull() & F.col(f"row.{c}").isNull(), c) for c in schema.fieldNames()]
    wrong = F.when(F.col("reason") == WRONG_TYPE, F.array_compact(F.array(*fields))).otherwise(F.array().cast("array<string>"))
    rejects = rows.where(bad).withColumn("reason", reason).select("file", "line", "reason", wrong.alias("fields"))
    return good, rejects


def read_snapshot(
    spark: SparkSession, path: str, schema: T.StructType = LISTINGS, city: str | None = None
) -> DataFrame:
    """Read a listings snapshot written by :func:`abode.sinks.write_snapshot`.

    With ``city`` only that city's rows are returned; if the snapshot was
    written by city, only its folder is read. Other filters and the column list
    reach the scan.
    """
    table = spark.read.schema(schema).parquet(path)
    if city is not None:
        if CITY_PART in table.columns:
            table = table.filter(F.col(CITY_PART) == city_part(F.lit(city)))
        table = table.filter(F.col("city") == city)
    return table.select(*schema.fieldNames())
