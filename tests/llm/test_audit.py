"""The filter audit: files in any order, edge rows, a continued stream."""

from itertools import permutations

from edge_rows import COLUMNS, EDGE
from pyspark.sql import functions as F

from abode.llm import audit

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
LABELS = "doc_id long, quality int, toxic int"


def plain(rows, labels):
    """The audit by looping over rows and orders."""
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    fails = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = [w for w in __import__("re").split("[ \t-\r]+", text) if w]
        f = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": any(i is not None and doc_id is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
        }
        fails.append((lang or "", doc_id, {k for k, v in f.items() if v}))
    out = {}
    for part in {p for p, _, _ in fails}:
        mine = [(i, f) for p, i, f in fails if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            for step, own in enumerate(order, 1):
                gone = [bool(f & set(order[: step - 1])) for _, f in mine]
                removed = [(i, f) for (i, f), g in zip(mine, gone) if own in f and not g]
                total[own] += len(removed)
                out[part, order, step] = [
                    sum(own not in f and not g for (_, f), g in zip(mine, gone)),
                    len(removed),
                    sum(own in f and g for (_, f), g in zip(mine, gone)),
                    sum(f == {own} for _, f in mine),
                    sum(i in good for i, _ in removed),
                    sum(i in toxic for i, _ in removed),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def found(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COUNTS] for r in rows}
    assert len(out) == len(rows)
    return out


def write(spark, path, rows, mode="append"):
    spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").coalesce(1).write.mode(mode).parquet(path)


LONG = " ".join(f"w{i}" for i in range(250))
ROWS = [
    [(9, LONG, "en"), (8, "A# b", "de"), (None, LONG, "en"), (5, None, None)],
    [(4, LONG, "fr"), (9, LONG, "en"), (2, "A# b", "en"), (6, "", "en")],
    [(3, LONG, "en"), (3, LONG, "de"), (7, "A# b", None), (1, "x | y", "en")],
    [(3, LONG, "en"), (11, LONG, "fr"), (0, "A# b", "de"), (12, "a a a", "en")],
]
GIVEN = [(9, 1, 0), (3, 1, 1), (3, 0, None), (4, 0, 1), (2, 1, 0), (2, None, 1), (None, 1, 1), (77, 1, 1)]


def test_files_in_any_order(spark, scratch):
    """Smaller identifiers in later files: earlier masks are taken back."""
    labels = spark.createDataFrame(GIVEN, LABELS)
    want = plain([r for part in ROWS for r in part], GIVEN)
    for order in ([0, 1, 2, 3], [3, 1, 0, 2]):
        path = scratch("docs")
        for i in order:
            write(spark, path, ROWS[i])
        assert found(audit.filter_audit(spark, path, labels, batches=4)) == want
    assert found(audit.filter_audit(spark, path, labels, batches=1)) == want


def test_continued(spark, scratch):
    """A later call with the same folder reads only the new files."""
    labels = spark.createDataFrame(GIVEN, LABELS)
    path, folder = scratch("docs"), scratch("audit")
    for n in range(1, 5):
        write(spark, path, ROWS[n - 1])
        got = found(audit.filter_audit(spark, path, labels, batches=1, folder=folder))
        assert got == plain([r for part in ROWS[:n] for r in part], GIVEN)
    epochs = spark.read.parquet(f"{folder}/counters").select(F.max("epoch")).collect()[0][0]
    assert epochs == 3
    again = found(audit.filter_audit(spark, path, labels, batches=1, folder=folder))
    assert again == got


def test_repeated_epoch(spark):
    """The same micro-batch against the same state gives the same changes."""
    layout = f"digest binary, id long, {audit.COUNTERS}"
    state = spark.createDataFrame([(b"a", 5, "en", 1, True, False, 2), (b"a", 9, "en", 1, False, False, 1)], layout)
    rows = spark.createDataFrame([(b"a", 4, "de", 1, False, False, 1), (b"a", 7, "fr", 1, False, False, 1)], layout)
    counts, added = audit.batch_changes(rows, state)
    sums = counts.groupBy("part", "mask", "good").agg(F.sum("n").alias("n")).where("n <> 0").collect()
    assert {(r["part"], r["mask"], r["good"]): r["n"] for r in sums} == {
        ("de", 1, False): 1, ("fr", 17, False): 1, ("en", 1, True): -2, ("en", 17, True): 2,
    }
    assert [r["id"] for r in added.collect()] == [4]


def test_edge_rows(spark, edge, nothing, scratch):
    path = scratch("edge")
    edge.write.parquet(path)
    labels = spark.createDataFrame([], LABELS)
    assert found(audit.filter_audit(spark, path, labels)) == plain([(r[0], r[1], r[2]) for r in EDGE], [])
    empty = scratch("empty")
    nothing.write.parquet(empty)
    assert audit.filter_audit(spark, empty, labels).collect() == []
    assert COLUMNS.startswith("doc_id")
