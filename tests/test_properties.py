"""Property tests: set-wise operators against plain Python models."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from abode.operators import snapshot
from abode.operators.enrich import enrich
from tests.helpers import listing_frame, listing_row, raw_frame, raw_row

streets = st.sampled_from(["Main", "Oak", None])
numbers = st.integers(min_value=1, max_value=6)


@settings(max_examples=6, deadline=None)
@given(
    table_numbers=st.sets(numbers, max_size=4),
    batch=st.lists(st.tuples(numbers, streets), max_size=12),
)
def test_insert_ignore_matches_model(spark, table_numbers, batch):
    current_rows = [listing_row(10 * (i + 1), f"{n} Main, Springfield") for i, n in enumerate(sorted(table_numbers))]
    current = listing_frame(spark, current_rows)
    mark = max([r[0] for r in current_rows], default=0)
    raw = [raw_row(100 + i, n, street=s) for i, (n, s) in enumerate(batch)]
    out = snapshot.insert_ignore(current, enrich(raw_frame(spark, raw)), id_mark=mark)

    # model: first occurrence (smallest source_id) per address, skip taken ones
    taken = {r[1] for r in current_rows}
    kept = []
    for sid, (n, s) in sorted((100 + i, b) for i, b in enumerate(batch)):
        addr = None if s is None else f"{n} {s}, Springfield"
        if addr is not None and addr in taken:
            continue
        if addr is not None:
            taken.add(addr)
        kept.append(addr)
    expected = sorted([(r[0], r[1]) for r in current_rows] + [(mark + i + 1, a) for i, a in enumerate(kept)])
    got = sorted((r["listing_id"], r["address"]) for r in out.collect())
    assert got == expected


@settings(max_examples=6, deadline=None)
@given(
    ids=st.sets(st.integers(min_value=1, max_value=40), max_size=15),
    delta=st.dictionaries(st.integers(min_value=1, max_value=60), st.integers(min_value=1, max_value=999), max_size=8),
)
def test_upsert_and_delete_match_model(spark, ids, delta):
    table = listing_frame(spark, [listing_row(i, f"{i} a", f"{i}.00") for i in sorted(ids)])
    d = spark.createDataFrame(
        [(k, Decimal(v)) for k, v in delta.items()], "listing_id long, listing_price decimal(12,2)"
    )
    got = {r["listing_id"]: r["listing_price"] for r in snapshot.upsert_price(table, d).collect()}
    model = {i: Decimal(i) for i in ids}
    model.update({k: Decimal(v) for k, v in delta.items()})
    assert got == model

    keys = spark.createDataFrame([(k,) for k in delta], "listing_id long")
    left = sorted(r[0] for r in snapshot.delete_by_key(table, keys).collect())
    assert left == sorted(set(ids) - set(delta))
