"""Exact duplicates by a tree merge of digest runs.

Every row becomes a fixed-size entry: SHA-256 of the normalised text, its byte
length and a second, independent 64-bit hash. Rows are dealt into ``runs`` by a
hash of their identifier, and equal entries of a run are merged. In each later
round ``fan_in`` neighbouring runs exchange what they hold and merge again,
until one run is left whose entry for a text holds the surviving identifier and
the group's size. The answer then travels down the same tree to the rows.

An entry matches only if digest, length and second hash all agree, at every
level. No round brings together more than ``fan_in`` entries of a text, and the
last step meets a text's rows run by run, so a text that makes up a third of all
rows is spread over all runs, up and down. Texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abode.llm.tables import unused
from abode.plans.joins import bounded_broadcast
from abode.plans.materialize import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS, FAN_IN = 1024, 32
ENTRY = ["_digest", "_bytes", "_check"]


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and every other character as it is."""
    plain = F.length(text) == F.octet_length(text)  # one byte a character: lower() touches A-Z only
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest_rows(df: DataFrame, id_col: str, text_col: str, runs: int) -> DataFrame:
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return df.select(
        F.col(id_col).alias("_id"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(runs)).cast("int").alias("_run"),
        F.unhex(F.sha2(norm, 256)).alias("_digest"),
        F.octet_length(norm).alias("_bytes"),
        F.xxhash64(norm).alias("_check"),
    )


def exact_groups(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    runs: int = RUNS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per input row: ``<id_col>, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they agree after lower-casing A-Z. ``keep`` says which
    identifier of a group stays, ``"max"`` or ``"min"``. Null and empty texts
    form one group. A null identifier never beats another one; a group of null
    identifiers only has a null ``keep_id``. If the surviving identifier occurs
    on several rows of its group, exactly one of them is kept. An empty table
    gives no rows; other columns of ``df`` are not read.
    """
    best = {"max": F.max, "min": F.min}[keep]
    rows = materialize(digest_rows(df, id_col, text_col, runs))

    levels = [
        rows.groupBy(*ENTRY, "_run").agg(best("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    ]
    width = runs
    while width > 1:
        width = -(-width // fan_in)
        levels.append(
            levels[-1]
            .groupBy(*ENTRY, F.expr(f"_run div {fan_in}").cast("int").alias("_run"))
            .agg(best("_keep").alias("_keep"), F.sum("_n").alias("_n"))
        )

    answer = levels[-1]
    for level in reversed(levels[:-1]):
        below = level.select(*ENTRY, F.col("_run").alias("_below"), F.expr(f"_run div {fan_in}").cast("int").alias("_run"))
        answer = below.join(answer, [*ENTRY, "_run"]).drop("_run").withColumnRenamed("_below", "_run")

    copy = F.row_number().over(Window.partitionBy(*ENTRY, "_run", "_id").orderBy("_keep"))
    found = rows.join(answer, [*ENTRY, "_run"]).withColumn("_copy", copy)
    return found.select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_n").alias("group_size"),
        (F.col("_id").eqNullSafe(F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """The rows of ``df`` that :func:`exact_groups` keeps, with all their columns, whatever their names.

    Rows that agree in identifier and normalised text count as one row; one of
    them stays. Rows with a null identifier stay only if their group has no other.

    Only identifiers and digests are shuffled: what goes is looked up by them, and
    the texts stay where they are while that is small enough to broadcast.
    """
    groups = exact_groups(df, id_col, text_col, keep).select(
        F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_digest"), "kept"
    )
    marks = groups.groupBy("_id", "_digest").agg(F.max("kept").alias("_stays"), F.count(F.lit(1)).alias("_rows"))
    marks, _ = bounded_broadcast(marks.where("not _stays or _rows > 1"))
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    sha = unused(df, "row_digest")
    rows = df.withColumn(sha, F.unhex(F.sha2(norm, 256)))
    names = {c: unused(rows, c) for c in marks.columns}
    marks = marks.withColumnsRenamed(names)
    key, digest, stays, repeated = (F.col(names[c]) for c in ("_id", "_digest", "_stays", "_rows"))
    on = F.col(id_col).eqNullSafe(key) & (F.col(sha) == digest)
    # marked rows go; one of those that repeat a row that stays comes back
    out = rows.join(marks, on, "left_anti")
    if not marks.where(stays & (repeated > 1)).isEmpty():
        again = rows.join(marks.where(stays), on, "left_semi")
        out = out.unionByName(again.dropDuplicates([id_col, sha]))
    return out.drop(sha)
