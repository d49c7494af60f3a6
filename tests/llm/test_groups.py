"""Near duplicates, shared passages and the pipeline: operators that compare documents."""

import random
from collections import Counter, defaultdict

import numpy as np
from edge_rows import EDGE, SF

from abode.llm import neardup, passages
from abode.llm.words import words

SCHEMA = "doc_id long, text string"


def plain_sets(texts):
    out = {}
    for i, t in texts.items():
        w = words(t)
        out[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    return out


def plain_components(sets):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                a1, b1 = sorted((find(a), find(b)))
                root[b1] = a1
    return {i: find(i) for i in ids}


def test_near_groups(spark, documents, texts):
    rng = random.Random(2)
    word = lambda: rng.choice("abcdefghijklmnop") + rng.choice("qrstuvwxyz")
    made = {}
    for f in range(12):  # families of edited copies, half of them around a shared passage
        shared = [word() for _ in range(60)]
        for c in range(12):
            own = [word() for _ in range(25)] if f % 2 else []
            copy = list(shared)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(60)] = word()
            made[1000 + 12 * f + c] = " ".join(own + copy)
    made |= {1: None, 2: "", 3: " \n", 4: "a b", 5: "A  b", 6: "a b c", 7: "a b", 8: "x " * 30000}
    for data in (made, texts):
        df = spark.createDataFrame(list(data.items()), SCHEMA)
        rows = {r["doc_id"]: r for r in neardup.near_groups(df).collect()}
        sets = plain_sets(data)
        want = plain_components(sets)
        assert {i: r["component_id"] for i, r in rows.items()} == want
        assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in rows.items())


def test_near_groups_edges(edge, nothing):
    rows = neardup.near_groups(edge).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(e[0] for e in EDGE)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[6]["component_id"] == 5 and not by_id[6]["kept"] and by_id[8]["component_id"] == 8
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert neardup.near_groups(nothing).collect() == []
    assert neardup.drop_near_copies(edge).columns == edge.columns


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(1)
    draw = lambda n: rng.integers(0, 1 << 62, n, dtype=np.uint64)
    for size, common in ((600, 450), (40, 30), (5, 4), (1, 1)):
        agree = []
        for _ in range(30):
            shared = draw(common)
            a, b = (np.unique(np.concatenate([shared, draw(size - common)])) for _ in range(2))
            agree.append(np.mean(neardup.sketch(a) == neardup.sketch(b)))
        assert abs(np.mean(agree) - common / (2 * size - common)) < 0.04


def test_passages_cover_long_shared_runs(documents, texts):
    found = defaultdict(set)
    for r in passages.shared_passages(documents).collect():
        found[r["doc_id"]].update(range(r["start"], r["end"]))
        assert (r["ref_id"], r["ref_start"]) < (r["doc_id"], r["start"]) and r["alike"] >= passages.LEAST_ALIKE
    seen, missed, total = set(), 0, 0
    for i in sorted(texts):
        w = words(texts[i])
        for p in range(len(w) - 49):
            run = tuple(w[p : p + 50])
            if run in seen:
                total += 1
                missed += not found[i].issuperset(range(p, p + 50))
            seen.add(run)
    assert total and missed == 0


def test_fuzzy_passages(spark, edge, nothing):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    prose = lambda n: [word() for _ in range(n)]
    passage = prose(70)
    docs = []
    for i in range(40):
        copy = list(passage)
        for at in (15 + i % 5, 33, 52):
            copy[at : at + 1] = [[word()], [], [word(), word()]][i % 3]
        docs.append((i, " ".join(prose(30 + i) + copy + prose(20))))
    docs += [(100 + i, " ".join(prose(200))) for i in range(20)]
    rows = passages.shared_passages(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {r["doc_id"] for r in rows} == set(range(1, 40)) and all(r["ref_id"] < 40 for r in rows)
    held = defaultdict(set)
    for r in rows:
        held[r["doc_id"]].update(range(r["start"], r["end"]))
        assert r["start"] >= 28 + r["doc_id"]
    assert all(len(h) >= 55 for h in held.values())
    cut = passages.cut_passages(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(rows)).collect()
    assert all(len(words(r["text"])) <= 50 + r["doc_id"] + 16 for r in cut if 0 < r["doc_id"] < 40)
    assert {r["doc_id"] for r in passages.shared_passages(edge).collect()} <= {9}
    assert passages.shared_passages(nothing).collect() == []


def test_chains_are_ordered_and_disjoint():
    rng = random.Random(1)
    matches = [(i * 7, 500 + i * 7 + rng.randint(0, 2)) for i in range(20)] + [(rng.randint(0, 200), rng.randint(0, 400)) for _ in range(15)]
    found = passages.chains(matches)
    assert len(found[0]) >= 18
    for c in found:
        assert all(a < b and x < y for (a, x), (b, y) in zip(c, c[1:]))
    used = [m for c in found for m in c]
    assert len(used) == len(set(used))


def test_pipeline(spark):
    import corpus_pipeline as P
    from abode.llm import decontam

    rows = {r["doc_id"]: r for r in P.run(spark, SF).collect()}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [(r["item_id"], decontam.normal(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {i: t for i, t in docs.items() if any(c.isalpha() for c in t or "")}
    first = {}
    for i in sorted(left):
        first.setdefault(left[i].encode().lower(), i)
    left = {i: left[i] for i in first.values()}
    component = plain_components(plain_sets(left))
    left = {i: t for i, t in left.items() if component[i] == i}
    left = {i: t for i, t in left.items() if not any(item in decontam.normal(t) for _, item in items)}
    assert set(rows) == set(left) and all(r["round_trip"] for r in rows.values())
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None


def test_seeds_are_window_minima():
    rng = np.random.default_rng(5)
    for n in (6, 14, 15, 16, 40, 400):
        hashes = rng.integers(0, 50 if n % 2 else 1 << 62, n, dtype=np.uint64)
        grams = passages.runs(hashes, passages.K)
        at, found = passages.seeds(hashes)
        span = min(passages.SPAN, len(grams))
        if len(grams) > passages.SPAN:
            want = {j + i for j in range(len(grams) - span + 1) for i in range(span) if grams[j + i] == grams[j : j + span].min()}
            assert set(at.tolist()) == want
        assert np.array_equal(found, grams[at].view(np.int64)) and len(at)


def test_pipeline_stages_on_edge_rows(spark):
    import corpus_pipeline as P
    from edge_rows import COLUMNS

    odd = [
        (20, "a first text under a shared identifier", "en", "s", 1, 7, "x", 1),
        (20, "and quite another one under the same identifier", "en", "s", 1, 7, "x", 1),
        (None, "one more row without identifier", "en", "s", 1, 7, "x", 1),
        (None, "long words " * 4000, "en", "s", 1, 7, "x", 1),
    ]
    docs = spark.createDataFrame(EDGE + odd, COLUMNS)
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF).checkpoint()
    kept = Counter(r["doc_id"] for r in docs.collect())
    assert kept == {5: 1, 7: 1, 8: 1, 9: 1, 20: 2, None: 3}
    rows = P.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(r["doc_id"] for r in rows) == kept and all(r["round_trip"] for r in rows)


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_passages_with_a_changed_word_in_four(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    prose = lambda n: [word() for _ in range(n)]
    docs, own = [], {}
    for step in (4, 5, 6, 8, 9, 10):
        for n in (50, 60):
            for _ in range(10):
                i, passage = len(docs), prose(n)
                copy = [word() if at % step == step // 2 else w for at, w in enumerate(passage)]
                assert 1 - plain_edits(passage, copy) / n >= passages.LEAST_ALIKE
                docs += [(i, " ".join(prose(80) + passage + prose(30))), (i + 1, " ".join(prose(40) + copy + prose(70)))]
                own[i + 1] = n
    rows = passages.shared_passages(spark.createDataFrame(docs, SCHEMA)).collect()
    text = {i: words(t) for i, t in docs}
    for r in rows:
        a, b = text[r["doc_id"]][r["start"] : r["end"]], text[r["ref_id"]][r["ref_start"] : r["ref_end"]]
        assert r["edits"] == plain_edits(a, b)
    held = {r["doc_id"]: min(r["end"], 40 + own[r["doc_id"]]) - max(r["start"], 40) for r in rows if r["ref_id"] == r["doc_id"] - 1}
    assert set(held) == set(own) and all(held[i] >= 0.9 * n for i, n in own.items())


def test_variants_edited_in_different_places(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    prose = lambda n: [word() for _ in range(n)]
    passage = prose(60)
    variants = [[word() if rng.random() < 0.1 else w for w in passage] for _ in range(300)]
    docs = [(i, " ".join(prose(20) + v + prose(20))) for i, v in enumerate(variants)]
    alike = lambda a, b: sum(x == y for x, y in zip(a, b)) >= 0.7 * 60
    want = {i for i in range(300) if any(alike(variants[i], v) for v in variants[:i])}
    assert {r["doc_id"] for r in passages.shared_passages(spark.createDataFrame(docs, SCHEMA)).collect()} == want


def test_extension_beyond_the_words_at_hand(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    prose = lambda n: [word() for _ in range(n)]
    near, far = prose(30), prose(120)
    # the words after the first 30 stand unchanged in many documents, of which 100 is neither the first nor the nearest
    docs = [(0, " ".join(far))] + [(i, " ".join(prose(5) + far)) for i in range(1, 40)]
    docs += [(100, " ".join(near + far)), (101, " ".join(far)), (102, " ".join(prose(9) + near + far))]
    rows = passages.shared_passages(spark.createDataFrame(docs, SCHEMA)).where("doc_id = 102").collect()
    assert any(r["ref_id"] == 100 and (r["start"], r["end"]) == (9, 159) for r in rows)
    assert any(r["ref_id"] == 0 and r["end"] - r["start"] >= 120 for r in rows)
