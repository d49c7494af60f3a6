import hashlib
from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from abode import functions as AF
from abode.operators import churn
from tests.helpers import listing_frame, listing_row


@pytest.mark.parametrize("n,pct,k", [(16, "0.03", 0), (50, "0.01", 0), (150, "0.01", 2), (13270, "0.02", 265)])
def test_sample_size_half_even(n, pct, k):
    assert churn.sample_size(n, pct) == k


def test_sample_size_frame_matches(spark):
    df = spark.range(150).withColumnRenamed("id", "listing_id")
    row = churn.sample_size_frame(df, "0.01").first()
    assert (row["n"], row["k"]) == (150, 2)


def test_draw_pct_values():
    seen = Counter(churn.draw_pct(s) for s in range(4000))
    assert set(seen) == {Decimal("0.01"), Decimal("0.02"), Decimal("0.03")}
    # middle value about half of the draws
    assert 0.45 < seen[Decimal("0.02")] / 4000 < 0.55


def _brute_force(ids, seed, k):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))[:k]


@settings(max_examples=8, deadline=None)
@given(
    ids=st.lists(st.integers(min_value=0, max_value=10**12), min_size=0, max_size=300, unique=True),
    seed=st.integers(min_value=0, max_value=1000),
    frac=st.floats(min_value=0, max_value=1),
)
def test_cut_equals_brute_force(spark, ids, seed, frac):
    k = int(len(ids) * frac)
    df = spark.createDataFrame([(i,) for i in ids], "listing_id long")
    cut = churn.find_cut(df, seed, k)
    got = sorted(r[0] for r in df.filter(cut.predicate()).collect())
    assert got == sorted(_brute_force(ids, seed, k))


def test_cut_multi_level_refinement(spark, monkeypatch):
    # force the histogram to refine: boundary buckets must be tiny
    monkeypatch.setattr(churn, "BOUNDARY_MAX_ROWS", 0)
    monkeypatch.setattr(churn, "PREFIX_STEP", 1)
    ids = list(range(0, 3000, 3))
    df = spark.createDataFrame([(i,) for i in ids], "listing_id long")
    for k in (1, 17, 500, 999, 1000, 1500):
        cut = churn.find_cut(df, 88, k)
        got = sorted(r[0] for r in df.filter(cut.predicate()).collect())
        assert got == sorted(_brute_force(ids, 88, k)), k


def test_delete_and_reprice_touch_only_sample(spark):
    rows = [listing_row(i, f"{i} Main, Springfield", price=f"{100000 + i}.00") for i in range(1, 401)]
    table = listing_frame(spark, rows)
    keys = {r[0] for r in churn.churn_delete_keys(table, 88, "0.03").collect()}
    assert len(keys) == 12
    kept = churn.apply_churn_delete(table, 88, "0.03")
    assert {r[0] for r in kept.select("listing_id").collect()} == set(range(1, 401)) - keys

    updated = {r["listing_id"]: r["listing_price"] for r in churn.apply_churn_update(table, 89, "0.02").collect()}
    before = {r[0]: r[11] for r in rows}
    changed = {i for i in before if updated[i] != before[i]}
    sample = {r[0]: r[1] for r in churn.reprice_sample(table, 89, "0.02").collect()}
    assert changed == set(sample) and len(sample) == 8
    for i, new in sample.items():
        factor = new / before[i]
        assert min(abs(factor - Decimal(f)) for f in AF.REPRICE_FACTORS) < Decimal("0.0001")


def test_empty_sample(spark):
    table = listing_frame(spark, [listing_row(i, f"{i} a") for i in range(1, 17)])
    assert churn.apply_churn_delete(table, 88, "0.03").count() == 16
    assert churn.churn_delete_keys(table, 88, "0.03").count() == 0
    assert table.filter(churn.find_cut(table, 1, 0).predicate()).count() == 0
    # k >= n takes everything
    assert table.filter(churn.find_cut(table, 1, 99).predicate()).count() == 16


@pytest.mark.parametrize("bound", [5, 200_000])
def test_repeated_key_at_the_boundary_raises(spark, monkeypatch, bound):
    monkeypatch.setattr(churn, "BOUNDARY_MAX_ROWS", bound)
    df = spark.createDataFrame([(7,)] * 50 + [(i,) for i in range(100, 120)], "listing_id long")
    ahead = df.filter("listing_id <> 7").filter(churn.AF.sample_hash("listing_id", 3) < churn.AF.sample_hash(churn.F.lit(7), 3)).count()
    with pytest.raises(ValueError, match="unique"):
        churn.find_cut(df, 3, ahead + 10)


def test_rows_without_an_id_are_not_counted(spark):
    df = spark.createDataFrame([(i,) for i in range(100)] + [(None,)] * 50, "listing_id long")
    assert churn.sample_size_frame(df, "0.1").first()["k"] == df.filter(churn.sample_cut(df, 1, "0.1").predicate()).count() == 10
