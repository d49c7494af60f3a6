"""Shards of equal row counts along a Hilbert curve.

Each metadata dimension is quantised to ``bits`` bits between its least and
greatest value, a row's cell is its point on the grid, and rows are ordered by
the cell's index on the Hilbert curve. Runs of that order are the shards:
neighbours on the curve are neighbours in every dimension, so each shard covers
a narrow range of all of them and its files can be skipped by their min/max.

The position of a row in the order is found without sorting the rows as a
whole: rows are counted by cell and salt, the counts are summed along the curve
in two levels of bounded size, and a row's number within its cell and salt is
added. Salts (a hash of the identifier) split cells that hold many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from abode.plans.materialize import materialize

BITS, SALTS, PREFIX = 6, 64, 6


def size_code(size: Column) -> Column:
    """Order-preserving code of a positive size: eight steps for each power of two, in whole numbers."""
    power = F.length(F.bin(size)) - 1
    eighths = F.floor(size * 8 / F.pow(F.lit(2.0), power)).cast("bigint") - 8
    return power.cast("bigint") * 8 + eighths


def text_code(value: Column, skip: int) -> Column:
    """Order-preserving number of a string: ``PREFIX`` bytes after the first ``skip``."""
    part = F.hex(F.substring(F.encode(value, "UTF-8"), skip + 1, PREFIX))
    return F.conv(F.rpad(part, 2 * PREFIX, "0"), 16, 10).cast("bigint")


def _common_prefix(low: str | None, high: str | None) -> int:
    a, b = (low or "").encode(), (high or "").encode()
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def hilbert_index(dims: list[str], bits: int) -> Column:
    """Index on the Hilbert curve of integer columns ``dims`` of ``bits`` bits each (Skilling's transform)."""
    n = len(dims)
    x = f"array({', '.join(f'cast({d} as bigint)' for d in dims)})"
    turn = (
        "case when (x[i] & shiftleft(1L, q)) <> 0 then if(j = 0, v ^ (shiftleft(1L, q) - 1), v) "
        "when i <> 0 and (j = 0 or j = i) then v ^ ((x[0] ^ x[i]) & (shiftleft(1L, q) - 1)) else v end"
    )
    if bits > 1:
        x = f"aggregate(sequence({bits - 1}, 1, -1), {x}, (y, q) -> aggregate(sequence(0, {n - 1}), y, (x, i) -> transform(x, (v, j) -> {turn})))"
    gray = x
    if n > 1:
        gray = f"aggregate(sequence(1, {n - 1}), {x}, (x, i) -> transform(x, (v, j) -> if(j = i, v ^ x[i - 1], v)))"
    if bits > 1:
        last = f"aggregate(sequence({bits - 1}, 1, -1), 0L, (t, q) -> if((g[{n - 1}] & shiftleft(1L, q)) <> 0, t ^ (shiftleft(1L, q) - 1), t))"
        gray = f"transform(array({gray}), g -> transform(g, v -> v ^ {last}))[0]"
    bit = f"aggregate(sequence({bits - 1}, 0, -1), 0L, (h, q) -> aggregate(g, h, (k, v) -> shiftleft(k, 1) | (shiftright(v, q) & 1)))"
    return F.expr(f"transform(array({gray}), g -> {bit})[0]")


def hilbert_shards(
    df: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    text_dims: tuple[str, ...] = ("source", "lang"),
    bits: int = BITS,
    salts: int = SALTS,
) -> DataFrame:
    """One row per input row: ``<id_col>, size, text_crc32, shard, slot, hilbert``.

    ``size`` is the text's UTF-8 bytes plus 1, ``text_crc32`` the CRC of those
    bytes; a null text counts as empty. Dimensions are the size, the identifier
    (a whole number) and the string columns ``text_dims``; a null is least.
    Counts of shards differ by one at most; ``slot`` numbers a shard's rows from
    0 without gaps, in curve order. Rows that tie in everything are numbered in
    any order, and are the same row to a reader. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = F.octet_length(text).cast("bigint") + 1
    rows = materialize(
        df.select(
            F.col(id_col).cast("bigint").alias("_id"),
            size.alias("_size"),
            size_code(size).alias("_code"),
            F.crc32(F.encode(text, "UTF-8")).alias("_crc"),
            *[F.col(c).cast("string").alias(f"_s{i}") for i, c in enumerate(text_dims)],
        )
    )
    cuts = [F.count(F.lit(1)).alias("n")]
    for c in ("_id", "_code"):
        cuts += [F.min(c).alias(f"lo{c}"), F.max(c).alias(f"hi{c}")]
    for i in range(len(text_dims)):
        short = F.substring(f"_s{i}", 1, 256)
        cuts += [F.min(short).alias(f"lo_s{i}"), F.max(short).alias(f"hi_s{i}")]
    ends = rows.agg(*cuts).collect()[0]

    def grid(value: Column, low: int | None, high: int | None) -> Column:
        if low is None:
            return F.lit(0)
        wide = "decimal(38,0)"
        step = (value.cast(wide) - F.lit(low).cast(wide)) * F.lit(1 << bits).cast(wide)
        cell = F.floor(step / F.lit(high - low + 1).cast(wide)).cast("int")
        return F.coalesce(F.least(F.greatest(cell, F.lit(0)), F.lit((1 << bits) - 1)), F.lit(0))

    dims = [grid(F.col("_code"), ends["lo_code"], ends["hi_code"]), grid(F.col("_id"), ends["lo_id"], ends["hi_id"])]
    for i in range(len(text_dims)):
        skip = _common_prefix(ends[f"lo_s{i}"], ends[f"hi_s{i}"])
        codes = [int.from_bytes(((v or "").encode()[skip:] + bytes(PREFIX))[:PREFIX], "big") for v in (ends[f"lo_s{i}"], ends[f"hi_s{i}"])]
        dims.append(grid(text_code(F.col(f"_s{i}"), skip), *codes))
    names = [f"_d{i}" for i in range(len(dims))]
    cell = [*names, "_salt"]
    placed = rows.select(
        "_id", "_size", "_crc",
        *[d.alias(n) for d, n in zip(dims, names)],
        F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int").alias("_salt"),
    )

    # counts along the curve: cells within a stretch of 4096 indices, then stretches
    stretch = max(0, bits * len(dims) - 12)
    cells = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).withColumn("_h", hilbert_index(names, bits))
    cells = cells.withColumn("_part", F.shiftright("_h", stretch))
    parts = cells.groupBy("_part").agg(F.sum("_n").alias("_pn"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows at most
    parts = parts.select("_part", F.coalesce(F.sum("_pn").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_part").orderBy("_h", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_off", F.coalesce(F.sum("_n").over(inner), F.lit(0)))
    cells = cells.join(parts, "_part").select(*cell, "_h", (F.col("_base") + F.col("_off")).alias("_start"))

    within = Window.partitionBy(*cell).orderBy("_id", "_size", "_crc")
    n, k = ends["n"], shards
    ranked = placed.join(cells, cell).withColumn("_rank", F.col("_start") + F.row_number().over(within) - 1)
    ranked = ranked.withColumn("_shard", F.expr(f"(_rank * {k}) div {max(n, 1)}"))
    first = F.expr(f"(_shard * {n} + {k - 1}) div {k}")
    return ranked.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - first).alias("slot"),
        F.col("_h").alias("hilbert"),
    )


def write_shards(df: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``df`` into one folder per shard, each file sorted along the curve.

    Joins on the identifier, which must be unique and not null.
    """
    spot = placed.select(F.col(id_col).alias("_pid"), F.col("shard"), F.col("slot").alias("_slot"))
    out = df.drop("shard").join(spot, F.col(id_col) == F.col("_pid")).drop("_pid")
    out.repartitionByRange("shard", "_slot").sortWithinPartitions("shard", "_slot").drop("_slot").write.partitionBy(
        "shard"
    ).parquet(path)
