"""Rows that stay: users' columns of any name, repeated rows, beyond the broadcast bound, many spans."""

import time

import pytest
from edge_rows import EDGE
from pyspark.sql import functions as F

from abode.llm import exactdup, neardup, pii
from abode.plans import joins
from abode.plans.materialize import materialize

NAMES = ["_row_sha", "_sha", "_kid", "_gone", "gone_id", "ROW_DIGEST", "_rows", "_stays", "_digest", "kept", "_copy"]


@pytest.mark.parametrize("bound", [None, 0])
def test_users_columns_stay_as_they_are(spark, edge, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", bound)
    own = edge.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in NAMES if n != "_id"})
    for out in (exactdup.drop_exact_copies(own, keep="min"), neardup.drop_near_copies(own)):
        assert out.columns == own.columns
        for r in out.collect():
            assert r["doc_id"] is None or all(r[n] == f"{n}{r['doc_id']}" for n in NAMES)
    kept = sorted(str(r["doc_id"]) for r in exactdup.drop_exact_copies(own, keep="min").collect())
    # 1 to 2: null and empty; 5 to 6: equal but for case, 5 twice; 7 and 8 differ beyond A-Z
    assert kept == ["1", "3", "4", "5", "7", "8", "9", "None"]


def test_a_repeated_row_stays_once(spark):
    rows = [(4, "Ab"), (4, "aB"), (4, "ab"), (5, "AB"), (6, "c"), (None, "ab"), (None, "d"), (None, "d"), (7, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), (r["text"] or "").lower()) for r in exactdup.drop_exact_copies(df, keep="min").collect())
    assert got == [("4", "ab"), ("6", "c"), ("7", ""), ("None", "d")]
    assert exactdup.drop_exact_copies(df.limit(0)).collect() == []


def test_texts_are_not_shuffled(spark, documents):
    for out in (exactdup.drop_exact_copies(documents), neardup.drop_near_copies(documents)):
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_many_spans_take_linear_time():
    one = "mail a@b.cd or iban GB82 WEST 1234 5698 7654 32 "

    def seconds(n):
        best = 9e9
        for _ in range(3):
            t = time.perf_counter()
            found = pii.find(one * n)
            best = min(best, time.perf_counter() - t)
        assert len(found) == 2 * n
        return best

    assert seconds(8000) < 6 * seconds(2000)


def test_added_spans_overlap_no_base_span():
    text = "card 4111 1111 1111 1111, ssn 123-45-6789 and mail x@y.zz, iban GB82 WEST 1234 5698 7654 32" * 3 + EDGE[4][1]
    found = pii.find(text)
    base = [(s, e) for s, k, e, _ in found if k < pii.BASE]
    added = [(s, e) for s, k, e, _ in found if k >= pii.BASE]
    assert base and added and not any(a < e and s < b for s, e in added for a, b in base)


def test_whole_texts_go_to_python_in_small_batches(spark, documents, monkeypatch):
    seen = []
    monkeypatch.setattr(neardup, "materialize", lambda df: (seen.append(df.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")), materialize(df))[1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    neardup.near_groups(documents.limit(30))
    assert seen and all(0 < int(n) <= 1000 for n in seen)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
