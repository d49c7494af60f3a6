"""Filter interaction audit over a stream of files, with retractions.

Five filters look at every text (``FILTERS``); four depend on the text alone, E
on the whole table: a text fails E if a row with a smaller identifier has the
same text. The files of a table are taken as available-now micro-batches. A row
becomes a mask of the filters it fails; state keyed by the text's SHA-256 holds
the rows of the smallest identifier met so far, which pass E. When a smaller one
arrives, the earlier rows' masks are retracted from the counters of their part
and counted again with E, so after the last file the counters are those of the
whole table, in whatever order the files came.

The state is a table of changes, a folder per micro-batch: a micro-batch joins
its texts with it and adds what is new, in Spark's own joins. (A Python function
per text over Spark's state store takes some 7 ms a text.) Counters are per part,
mask and label. All 120 orders of the filters are worked out from them alone:
they don't grow with the table.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from abode.llm.batches import map_batches
from abode.llm.tables import stored
from abode.session import scratch_path

FILTERS = "ABCDE"
E_BIT = 16
CAPITALS, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"
COUNTED = ["part", "mask", "good", "toxic"]
COUNTERS = "part string, mask int, good boolean, toxic boolean, n long"


def text_mask(text: str) -> int:
    """Bits of the filters A to D that a text fails: few words, few distinct words, capitals, symbols."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # at blank and U+0009 to U+000D
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * (len(raw) - len(raw.translate(None, CAPITALS))) > 3 * len(text),
        len(raw) > len(raw.translate(None, SYMBOLS)),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def _masks(batch: pa.RecordBatch) -> dict:
    texts = [t or "" for t in batch.column("text").to_pylist()]
    return {
        "digest": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts],
        "id": batch.column("id"),
        "part": batch.column("part"),
        "mask": [text_mask(t) for t in texts],
    }


def label_flags(labels: DataFrame, id_col: str) -> DataFrame:
    """One row per labelled identifier: whether some label calls it good, or toxic."""
    return labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_label_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )


def masked_rows(docs: DataFrame, flags: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``digest, id, part, mask, good, toxic, n``: how many rows agree in all that; rows without an identifier are spread over the join."""
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), part.alias("part"), F.col(text_col).cast("string").alias("text"))
    layout = pa.schema(
        [("digest", pa.binary()), ("id", to_arrow_type(texts.schema["id"].dataType)), ("part", pa.string()), ("mask", pa.int32())]
    )
    masked = map_batches(texts, _masks, layout)
    rows = masked.groupBy("digest", "id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    spread = F.when(F.col("id").isNull(), F.xxhash64("digest", "part").bitwiseOR(F.lit(1))).otherwise(0)
    rows = rows.withColumn("_spread", spread)
    known = flags.withColumn("_spread", F.lit(0).cast("long"))
    on = (rows["id"] == known["_label_id"]) & (rows["_spread"] == known["_spread"])
    no = F.lit(False)
    return rows.join(known, on, "left").select(
        "digest", "id", "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "n"
    )


def batch_changes(rows: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signed counts of a micro-batch, and the rows it adds to the state.

    ``rows`` are counted rows, ``state`` the rows added before: those of a text's
    smallest identifier, and earlier ones that were retracted. Every row counts
    as a copy first; the rows of the smallest identifier are then moved to the
    mask without E, and those it replaces are moved back.
    """
    named = rows.where(F.col("id").isNotNull())
    before = state.groupBy("digest").agg(F.min("id").alias("old"))
    arrived = named.groupBy("digest").agg(F.min("id").alias("new"))
    least = arrived.join(before, "digest", "left").withColumn("least", F.least("new", "old"))
    first = named.join(least.select("digest", F.col("least").alias("id")), ["digest", "id"], "left_semi")
    beaten = least.where("least < old").select("digest", F.col("old").alias("id"))
    retracted = state.join(beaten, ["digest", "id"], "left_semi")
    unnamed = rows.where(F.col("id").isNull())
    copy = F.col("mask").bitwiseOR(F.lit(E_BIT))

    def signed(df: DataFrame, mask: Column, sign: int) -> DataFrame:
        return df.select("part", mask.alias("mask"), "good", "toxic", (F.col("n") * sign).alias("n"))

    counts = [
        signed(unnamed, F.col("mask"), 1),
        signed(named, copy, 1),
        signed(first, copy, -1),
        signed(first, F.col("mask"), 1),
        signed(retracted, F.col("mask"), -1),
        signed(retracted, copy, 1),
    ]
    return reduce(DataFrame.unionByName, counts), first


def audit_rows(counters: DataFrame) -> DataFrame:
    """The audit of every part, order and step from counters; zeros included."""
    total = counters.groupBy(*COUNTED).agg(F.sum("n").alias("n"))
    orders = ["".join(p) for p in permutations(FILTERS)]
    steps = total.withColumn("filter_order", F.explode(F.lit(orders))).withColumn("step", F.explode(F.lit([1, 2, 3, 4, 5])))
    place = {x: F.instr("filter_order", x) for x in FILTERS}
    bit = sum((F.when(place[x] == F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))
    earlier = sum((F.when(place[x] < F.col("step"), 1 << i).otherwise(0) for i, x in enumerate(FILTERS)), F.lit(0))
    here = F.col("mask").bitwiseAND(F.col("_bit")) > 0
    gone = F.col("mask").bitwiseAND(F.col("_earlier")) > 0

    def of(rows: Column) -> Column:
        return F.sum(F.when(rows, F.col("n")).otherwise(0))

    audit = (
        steps.withColumn("_bit", bit)
        .withColumn("_earlier", earlier)
        .groupBy("part", "filter_order", "step")
        .agg(
            of(~here & ~gone).alias("kept"),
            of(here & ~gone).alias("removed"),
            of(here & gone).alias("redundant"),
            of(F.col("mask") == F.col("_bit")).alias("unique_fails"),
            of(here & ~gone & F.col("good")).alias("good_lost"),
            of(here & ~gone & F.col("toxic")).alias("toxic_lost"),
        )
    )
    letter = F.expr("substring(filter_order, step, 1)")
    shapley = F.sum("removed").over(Window.partitionBy("part", letter))
    return audit.withColumn("shapley", shapley)


def filter_audit(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    batches: int = 4,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    Takes all Parquet files under ``path``, in about ``batches`` micro-batches of
    the same number of files. ``folder`` holds the stream's checkpoint, its state
    and the counters of each micro-batch; called again with the same folder, only
    files that are new since are read, and the audit covers all of them. Without
    it a fresh one below the shared scratch folder is used. Labels are joined when
    a row is read; a later change of labels changes nothing counted before.

    A null text counts as empty, a null part as the empty string. Rows that repeat
    the smallest identifier of their text all pass E; a row without an identifier
    passes E and is no smaller row for others. If an identifier has several
    labels, one that says good or toxic counts. An empty table gives no rows;
    other columns are not read.
    """
    path, folder = path.rstrip("/"), (folder or scratch_path(spark, "filter_audit")).rstrip("/")
    table = spark.read.parquet(path)
    flags = stored(label_flags(labels, id_col), "label_flags")
    kind = table.schema[id_col].dataType.simpleString()
    layout = f"digest binary, id {kind}, {COUNTERS}"
    # so that both are there, without rows, before the first micro-batch
    spark.createDataFrame([], layout).write.mode("overwrite").parquet(f"{folder}/state/epoch=-1")
    spark.createDataFrame([], COUNTERS).write.mode("overwrite").parquet(f"{folder}/counters/epoch=-1")

    def take(batch: DataFrame, epoch: int) -> None:
        """Reads the state of earlier epochs only, and a repeated epoch writes the same again."""
        rows = f"{folder}/rows/epoch={epoch}"
        masked_rows(batch, flags, id_col, text_col, part_col).write.mode("overwrite").parquet(rows)
        # the caller's session plans adaptively, a stream's doesn't
        state = spark.read.schema(layout + ", epoch int").parquet(f"{folder}/state").where(F.col("epoch") < epoch).drop("epoch")
        counts, added = batch_changes(spark.read.schema(layout).parquet(rows), state)
        counts.groupBy(*COUNTED).agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{folder}/counters/epoch={epoch}")
        added.write.mode("overwrite").parquet(f"{folder}/state/epoch={epoch}")

    query = (
        spark.readStream.schema(table.schema)
        .option("maxFilesPerTrigger", max(1, -(-len(table.inputFiles()) // batches)))
        .option("maxFileAge", "36500d")  # else files a week older than the first batch's newest are passed over
        .parquet(f"{path[:-1]}[{path[-1]}]")  # as a pattern, since a plain path has to be a folder
        .select(id_col, text_col, part_col)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return audit_rows(spark.read.schema(COUNTERS).parquet(f"{folder}/counters"))
