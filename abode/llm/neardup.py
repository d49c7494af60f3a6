"""Near duplicates: fast similarity sketches, banding, exact verification, components.

A document's set is its distinct ``WORDS``-word shingles. Its sketch has
``BINS`` coordinates filled in rounds: round r hashes every shingle afresh, the
hash's first bits name a bin and the rest is a value; a bin keeps the least
value of the first round that reaches it. A set of more than a few hundred
shingles fills all bins in one or two rounds. After ``BINS`` rounds, round
``BINS + b`` deals all shingles to bin b, so no coordinate stays empty. Two sets
agree in a coordinate with the probability of their Jaccard similarity.

Coordinates form bands; documents that share a band are candidates. Documents
with equal sets are one class from the start, so copies make no pairs. In each
band's bucket all classes are compared with the bucket's first; classes of a
bucket that are not connected then are compared with each other where their
rarest shingles allow the threshold (:func:`rare_pairs`). Every comparison
counts whole shingle sets.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abode.llm.batches import map_batches
from abode.llm.components import components
from abode.llm.tables import few_arrow_rows, unused
from abode.llm.words import U, mix, multipliers, runs, word_hashes, words
from abode.plans.joins import bounded_broadcast
from abode.plans.materialize import materialize

WORDS, PERCENT = 5, 75
BIN_BITS, ROWS = 7, 4
BINS = 1 << BIN_BITS
BANDS = BINS // ROWS  # a pair at the threshold shares no band with probability (1 - 0.75**4)**32 < 6e-6
SMALL = 48
ARROW_ROWS = 1000  # rows of one or two whole texts that go to Python at a time
_SEEDS, _BAND = multipliers(2 * BINS, 11), multipliers(ROWS, 13)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles, sorted; fewer than ``WORDS`` words make one."""
    return np.unique(runs(word_hashes(words(text)), WORDS))


def _keys(items: np.ndarray, seed: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Bin, round and value of each item, as one number that sorts in this order."""
    h = mix(items * seed)
    return (h >> U(64 - BIN_BITS) << U(64 - BIN_BITS)) | (turn << U(56 - BIN_BITS)) | (h << U(BIN_BITS) >> U(BIN_BITS + 8))


def sketch(items: np.ndarray) -> np.ndarray:
    """Fast similarity sketch of a non-empty set of hashes."""
    out, filled = np.zeros(BINS, dtype=U), np.zeros(BINS, dtype=bool)
    step = BINS if len(items) <= SMALL else 1
    for r in range(0, BINS, step):
        turn = np.arange(r, r + step, dtype=U)[:, None]
        keys = np.sort(_keys(items[None, :], _SEEDS[r : r + step, None], turn), axis=None)
        bins = (keys >> U(64 - BIN_BITS)).astype(np.int64)
        first = np.concatenate([[True], bins[1:] != bins[:-1]])
        bins, keys = bins[first], keys[first]
        new = ~filled[bins]
        out[bins[new]] = keys[new]
        filled[bins] = True
        if filled.all():
            return out
    for b in np.flatnonzero(~filled):
        low = (U(1) << U(64 - BIN_BITS)) - U(1)
        out[b] = U(b) << U(64 - BIN_BITS) | np.min(_keys(items, _SEEDS[BINS + b], U(BINS + b)) & low)
    return out


def bands(items: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = sketch(items).reshape(BANDS, ROWS)
    return mix((rows * _BAND).sum(axis=1, dtype=U) + np.arange(BANDS, dtype=U)).view(np.int64)


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, n, hi, lo, bands`` of each row: set size, digest of the set, band keys (null without shingles)."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def work(batch: pa.RecordBatch) -> dict:
        out = {f.name: [] for f in schema}
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            items = shingles(text)
            digest = np.frombuffer(xxhash.xxh3_128_digest(items.tobytes()), dtype=np.int64) if len(items) else (None, None)
            for name, value in zip(out, (i, len(items), digest[0], digest[1], bands(items) if len(items) else None)):
                out[name].append(value)
        return out

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, work, schema)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose texts' whole sets reach ``percent``.

    ``texts`` has ``id, text``. The text of ``b`` travels with the pair, as a
    class is ``b`` in few pairs; the join on ``a``, which many pairs may share,
    reads exchanges on both sides, which adaptive execution splits.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: OrderedDict[int, tuple[str, np.ndarray]] = OrderedDict()

    def work(batch: pa.RecordBatch) -> dict:
        out = {"a": [], "b": []}
        for a, b, left, right in zip(*(batch.column(c).to_pylist() for c in range(4))):
            if a not in held or held[a][0] != left:
                held[a] = left, shingles(left)
                if len(held) > 64:
                    held.popitem(last=False)
            if similar(held[a][1], shingles(right), percent):
                out["a"].append(a)
                out["b"].append(b)
        return out

    right = texts.select(F.col("id").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("left"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return map_batches(both, work, schema).distinct()


def rare_pairs(docs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of ``docs`` (``rep, n, label``) with different labels that can reach ``percent``; none that does is left out.

    Used for documents whose buckets stay mixed, as those that share a long
    common passage do: pairs of them by bucket would grow with the square of the
    bucket. Each set is ordered by how many sets hold a shingle, rare ones
    first. Two sets of enough overlap share one of the first
    ``n - ceil(share * n) + 1`` shingles, at positions that leave room for the
    overlap. A common passage stands last and joins nothing. Within a shingle,
    the most frequent label isn't compared with itself.
    """
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("label", pa.int64()), ("g", pa.int64())])

    def spread(batch: pa.RecordBatch) -> dict:
        sets = [shingles(t) for t in batch.column(3).to_pylist()]
        sizes = [len(s) for s in sets]
        out = {c: np.repeat(batch.column(i).to_numpy(), sizes) for i, c in enumerate(("rep", "n", "label"))}
        return out | {"g": np.concatenate([*sets, np.empty(0, dtype=U)]).view(np.int64)}

    whole = docs.join(texts.withColumnRenamed("id", "rep"), "rep").dropDuplicates(["rep"])
    grams = materialize(map_batches(whole.select("rep", "n", "label", "text"), spread, schema))
    often = materialize(grams.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    order = Window.partitionBy("rep").orderBy(F.coalesce("df", F.lit(1)), "g")
    ranked = grams.join(often, "g", "left").withColumn("p", F.row_number().over(order))
    head = materialize(ranked.where(f"df > 1 and p <= n - ceil({percent} * n / 100) + 1").select("g", "rep", "n", "label", "p"))
    votes = head.groupBy("g", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("g")
    major = votes.agg(F.max(F.struct("c", "label")).alias("m"), F.count(F.lit(1)).alias("k")).where("k > 1")
    head = materialize(head.join(major.select("g", F.col("m.label").alias("major")), "g"))
    other = head.select("g", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "label", "p")])
    found = head.where("label <> major").join(other, "g").where(
        f"label <> label2 and (label2 = major or label < label2) and 100 * least(n, n2) >= {percent} * greatest(n, n2) "
        f"and (100 + {percent}) * (1 + least(n - p, n2 - p2)) >= {percent} * (n + n2)"
    )
    return found.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``<id_col>, n_shingles, component_id, kept``.

    Documents whose sets' intersection is at least ``percent`` of their union
    are linked. ``component_id`` is the least identifier reachable by links, and
    ``kept`` whether it is the row's own. A document without words (null, empty
    or blank text) is linked with nothing. Rows without an identifier take no
    part in linking: their ``component_id`` is null and they are kept. Rows that
    share an identifier count as one document. An empty table gives no rows;
    other columns aren't read.
    """
    with few_arrow_rows(df.sparkSession, ARROW_ROWS):
        return _near_groups(df, id_col, text_col, percent)


def _near_groups(df: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """All Python runs in the stored steps; what is returned joins their rows."""
    rows = materialize(sketches(df, id_col, text_col))
    sets = rows.where("n > 0 and id is not null")
    classes = materialize(
        sets.groupBy("hi", "lo").agg(F.min("id").alias("rep"), F.min("n").alias("n"), F.first("bands").alias("bands"))
    )
    texts = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    keys = classes.select(F.explode("bands").alias("key"), "rep", "n")
    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"  # no smaller set reaches the share

    centres = materialize(
        keys.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("c"), F.count(F.lit(1)).alias("size")).where("size > 1")
        .select("key", F.col("c.rep").alias("a"), F.col("c.n").alias("m"), "size")
    )
    star = keys.join(centres, "key").where(f"rep <> a and {fits}").select("a", F.col("rep").alias("b")).distinct()
    star = materialize(star)
    links = materialize(verify(star, texts, percent))
    labels = components(links)

    # classes of one bucket that are still apart
    known = labels.select(F.col("node").alias("rep"), "label")
    placed = keys.join(centres.where("size > 2").select("key"), "key").join(known, "rep", "left")
    placed = materialize(placed.select("key", "rep", "n", F.coalesce("label", "rep").alias("label")))
    apart = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("key")
    mixed = placed.join(apart, "key").select("rep", "n", "label").distinct()
    rest = materialize(rare_pairs(mixed, texts, percent).join(star, ["a", "b"], "left_anti"))
    more = materialize(verify(rest, texts, percent))
    labels = components(links.unionByName(more))

    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    named = materialize(named.select("hi", "lo", F.coalesce("label", "rep").alias("component_id")))
    out = rows.join(named, ["hi", "lo"], "left").withColumn(
        "component_id", F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component_id", "id"))
    )
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` that :func:`near_groups` keeps, with all their columns, whatever their names.

    Rows without an identifier stay. Texts are not shuffled for it while the identifiers that
    go are few enough to broadcast.
    """
    name = unused(df, "gone_id")
    gone = near_groups(df, id_col, text_col, percent).where("not kept").select(F.col(id_col).alias(name)).distinct()
    gone, _ = bounded_broadcast(gone)
    return df.join(gone, F.col(id_col) == F.col(name), "left_anti")
