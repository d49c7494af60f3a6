"""Random churn: exact-k key samples, deletes and re-pricing.

The reference draws ``k = round(n * pct)`` keys uniformly on the driver. Here
the draw is reproducible and distributed: keys are ordered by a seeded md5
(``md5("<seed>:<id>")``, ties by id) and the sample is the first ``k`` in that
order. Instead of sorting the table, the ``k``-th smallest (hash, id) pair is
located with hash-prefix histograms, after which "in the sample" is a plain
column predicate: deletes become a filter and re-pricing a ``CASE``, both
map-only over the table.
"""

from __future__ import annotations

import random
from dataclasses import dataclass
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from abode import functions as AF
from abode.plans.materialize import materialize

# A share of the table: a Decimal, or text/float converted exactly via str().
Share = Decimal | str | float

# Hex digits added per histogram level (16**4 = 65,536 buckets per level).
PREFIX_STEP = 4
# Candidates kept for a sample, as a multiple of its share.
CANDIDATE_MARGIN = 2
# A boundary bucket at most this large is resolved by a bounded top-k.
BOUNDARY_MAX_ROWS = 200_000


def draw_pct(seed: int) -> Decimal:
    """The reference's churn share: ``round(uniform(0.01, 0.03), 2)``.

    Gives 0.01 / 0.02 / 0.03 with probability 1/4, 1/2, 1/4; seeded here.
    """
    return Decimal(str(round(random.Random(seed).uniform(0.01, 0.03), 2)))


def sample_size(n: int, pct: Share) -> int:
    """``round(n * pct)`` with half-to-even rounding, on exact decimals."""
    return int((Decimal(n) * Decimal(str(pct))).quantize(Decimal(1), rounding=ROUND_HALF_EVEN))


def sample_size_frame(table: DataFrame, pct: Share) -> DataFrame:
    """One row ``(n, pct, k)`` computed as a Spark aggregate; ``n`` counts the
    rows that have an id, which are the rows a sample draws from."""
    p = F.lit(Decimal(str(pct)))
    n = F.count("listing_id")
    return table.agg(
        n.alias("n"),
        p.alias("pct"),
        F.bround(n * p, 0).cast("bigint").alias("k"),
    )


@dataclass(frozen=True)
class SampleCut:
    """The sample is every key whose (hash, key) pair is <= (hash, key) here."""

    hash_value: str | None
    key_value: int | None
    seed: int
    key: str = "listing_id"

    def predicate(self) -> Column:
        if self.hash_value is None:
            return F.lit(False)
        h = AF.sample_hash(self.key, self.seed)
        pred = (h < F.lit(self.hash_value)) | (
            (h == F.lit(self.hash_value)) & (F.col(self.key) <= F.lit(self.key_value))
        )
        return F.coalesce(pred, F.lit(False))


def _histogram(scope: DataFrame, prefix_len: int) -> tuple[list[str], np.ndarray]:
    """Counts per hash prefix, in prefix order.

    The result has at most ``16 ** PREFIX_STEP`` rows whatever the table
    size (the prefix space bounds it), so it is returned to the driver like
    any small summary, as one Arrow batch. It is computed with map-side
    partial aggregation.
    """
    bucket = F.substring("_h", 1, prefix_len)
    table = scope.groupBy(bucket.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).toArrow()
    order = pc.sort_indices(table, sort_keys=[("_p", "ascending")])
    table = table.take(order)
    return table.column("_p").to_pylist(), table.column("_n").to_numpy().astype(np.int64)


def _scope(table: DataFrame, seed: int, key: str) -> DataFrame:
    return table.select(F.col(key).alias("_k"), AF.sample_hash(key, seed).alias("_h")).filter(
        F.col("_k").isNotNull()
    )


def _refuse_repeats(scope: DataFrame, key: str) -> None:
    """Raise if a key occurs twice in the boundary bucket: a cut there could not take exactly ``k`` rows.

    All rows of a key share its hash, so they are all in the bucket.
    """
    twice = scope.groupBy("_k").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(1)
    if twice:
        raise ValueError(f"{key} {twice[0]['_k']} occurs {twice[0]['n']} times; a sample needs unique keys")


def _resolve(scope: DataFrame, hist, prefix_len: int, k: int, seed: int, key: str) -> SampleCut:
    """Walk the histograms down to the k-th smallest (hash, key) pair."""
    remaining = k
    while True:
        prefixes, counts = hist
        running = np.cumsum(counts)
        i = int(np.searchsorted(running, remaining))  # first bucket reaching k
        remaining -= int(running[i] - counts[i])
        scope = scope.filter(F.substring("_h", 1, prefix_len) == F.lit(prefixes[i]))
        if counts[i] <= BOUNDARY_MAX_ROWS or prefix_len >= 32:
            _refuse_repeats(scope, key)
            last = (
                scope.orderBy("_h", "_k")
                .limit(int(remaining))
                .agg(F.max(F.struct("_h", "_k")).alias("m"))
                .collect()[0]["m"]
            )
            return SampleCut(last["_h"], last["_k"], seed, key)
        prefix_len = min(32, prefix_len + PREFIX_STEP)
        hist = _histogram(scope, prefix_len)


def _cut(scope: DataFrame, hist, k: int, seed: int, key: str) -> SampleCut:
    n = int(hist[1].sum())
    if k <= 0:
        return SampleCut(None, None, seed, key)
    if k >= n:  # the sample is the whole table
        top = scope.agg(F.max(F.struct("_h", "_k")).alias("m")).collect()[0]["m"]
        return SampleCut(top["_h"], top["_k"], seed, key)
    return _resolve(scope, hist, PREFIX_STEP, k, seed, key)


def find_cut(table: DataFrame, seed: int, k: int, key: str = "listing_id") -> SampleCut:
    """Locate the k-th smallest (seeded hash, key) pair without a global sort.

    Each level histograms a few more hex digits of the hash (at most 65,536
    groups), finds the bucket where the running count reaches ``k``, and
    narrows the search to that bucket. md5 spreads unique keys evenly, so one
    level suffices up to ~10^10 rows and each extra level divides the
    boundary by 65,536. The last bucket is resolved by a top-k of at most
    ``BOUNDARY_MAX_ROWS`` rows. Keys must be unique; a repeated one at the
    boundary raises.
    """
    if k <= 0:
        return SampleCut(None, None, seed, key)
    scope = _scope(table, seed, key)
    return _cut(scope, _histogram(scope, PREFIX_STEP), k, seed, key)


def sample_cut(table: DataFrame, seed: int, pct: Share, key: str = "listing_id") -> SampleCut:
    """Cut for ``k = round(n * pct)``; the first histogram also yields ``n``,
    so counting and the first level share one pass over the keys."""
    scope = _scope(table, seed, key)
    hist = _histogram(scope, PREFIX_STEP)
    return _cut(scope, hist, sample_size(int(hist[1].sum()), pct), seed, key)


def _below(key: str, seed: int, pct: Share) -> Column:
    """Whether a key's hash is in the first ``CANDIDATE_MARGIN`` times ``pct`` of all hashes, to four digits."""
    buckets = 16**PREFIX_STEP
    limit = int(Decimal(buckets) * CANDIDATE_MARGIN * Decimal(str(pct))) + 1
    if limit >= buckets:
        return F.lit(True)
    return F.substring(AF.sample_hash(key, seed), 1, PREFIX_STEP) < F.lit(f"{limit:0{PREFIX_STEP}x}")


def churn_cuts(
    table: DataFrame, delete_seed: int, delete_pct: Share, update_seed: int, update_pct: Share, key: str = "listing_id"
) -> tuple[SampleCut, SampleCut]:
    """Cuts of the delete sample and of the re-price sample, drawn from what the deletes leave.

    The same cuts as :func:`sample_cut` on the table and then on the table without the
    first sample, from one pass over its keys instead of two for each. The pass counts the keys
    and stores those whose hash for either seed is small enough that the sample lies
    among them: a few per cent of the keys. Both cuts are then found there, the
    second among the keys that the first leaves. Hashes are spread evenly, so a
    sample passes its candidates only in small tables; it is then cut from the table itself.
    """
    first, second = _below(key, delete_seed, delete_pct), _below(key, update_seed, update_pct)
    seen = Observation()
    keys = table.select(F.col(key)).where(F.col(key).isNotNull()).observe(seen, F.count(F.lit(1)).alias("n"))
    held = materialize(keys.where(first | second))
    n = int(seen.get.get("n", 0))  # missing where the optimizer finds the table empty

    def among(few: DataFrame, whole: DataFrame, k: int, seed: int) -> SampleCut:
        scope = _scope(few, seed, key)
        hist = _histogram(scope, PREFIX_STEP)
        return _cut(scope, hist, k, seed, key) if int(hist[1].sum()) >= k else find_cut(whole, seed, k, key)

    deletes = sample_size(n, delete_pct)
    gone = among(held.where(first), table, deletes, delete_seed)
    updates = sample_size(n - min(n, deletes), update_pct)
    left = held.where(second & ~gone.predicate())
    return gone, among(left, table.where(~gone.predicate()), updates, update_seed)


def churn_delete_keys(table: DataFrame, seed: int, pct: Share) -> DataFrame:
    """The sampled keys (``listing_id``) chosen for deletion."""
    cut = sample_cut(table, seed, pct)
    return table.filter(cut.predicate()).select("listing_id")


def churn_delete_rows(table: DataFrame, seed: int, pct: Share) -> DataFrame:
    """Full rows of the sampled keys (the reference's fetch-by-key step)."""
    cut = sample_cut(table, seed, pct)
    return table.filter(cut.predicate())


def apply_churn_delete(table: DataFrame, seed: int, pct: Share) -> DataFrame:
    """Delete ``round(n * pct)`` sampled rows: one map-only filter."""
    cut = sample_cut(table, seed, pct)
    return table.filter(~cut.predicate())


def reprice_sample(table: DataFrame, seed: int, pct: Share) -> DataFrame:
    """``(listing_id, listing_price)`` with the new price for each sampled row."""
    cut = sample_cut(table, seed, pct)
    factor = AF.reprice_factor("listing_id", seed)
    return table.filter(cut.predicate()).select(
        "listing_id", AF.repriced("listing_price", factor).alias("listing_price")
    )


def apply_churn_update(table: DataFrame, seed: int, pct: Share) -> DataFrame:
    """Re-price ``round(n * pct)`` sampled rows in place: one map-only CASE."""
    cut = sample_cut(table, seed, pct)
    factor = AF.reprice_factor("listing_id", seed)
    new_price = F.when(cut.predicate(), AF.repriced("listing_price", factor)).otherwise(
        F.col("listing_price")
    )
    return table.withColumn("listing_price", new_price)
