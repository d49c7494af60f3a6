"""Collocations against plain counting, the tiles against np.unique, the joins beyond the broadcast bound."""

import random
import re
from collections import Counter

import numpy as np
from edge_rows import EDGE
from hypothesis import given, settings
from hypothesis import strategies as st

from abode.llm import collocations
from abode.plans import joins

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, least, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            ws = [w for w in re.split("[ \t]", piece) if w]
            n[lang] += len(ws)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    f.setdefault(lang, Counter())[tuple(ws[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in frequent.items():
            covered = any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in frequent.items()
            )
            if not covered:
                cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def made(seed, many):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "B", "cc", "É", "é", "d'e", "f-g", "x y"]
    return [
        ("".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", ". ", "\n", ",", "\r\v "]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, "und", ""]))
        for _ in range(many)
    ]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1, 1500), min_size=2, max_size=400), st.integers(1, 60))
def test_tiles(codes, full):
    codes = np.array(codes, dtype=np.int32)
    collocations.FULL, keep = full, collocations.FULL
    try:
        left, right, n, at, which = collocations.pairs(codes, 1501)
    finally:
        collocations.FULL = keep
    want = Counter((a, b) for a, b in zip(codes.tolist(), codes.tolist()[1:]) if a >= 0 and b >= 0)
    got = list(zip(left.tolist(), right.tolist(), n.tolist()))
    assert len(got) == len(want) and {(a, b): k for a, b, k in got} == want
    for i, w in zip(at.tolist(), which.tolist()):
        assert (left[w], right[w]) == (codes[i], codes[i + 1])


def test_a_full_tile():
    codes = np.random.default_rng(1).integers(0, 700, 200_000).astype(np.int32)
    left, right, n, at, which = collocations.pairs(codes, 700)
    assert np.bincount(which).tolist() == n.tolist() and n.sum() == len(at) == 199_999
    pairs = left * 700 + right
    assert len(np.unique(pairs)) == len(pairs)


def test_against_plain_counting(spark, monkeypatch):
    rows = made(5, 150)
    rows += [("new york city hall " * 3, "en")] * 4 + [("one two three four five", "en")] * 9 + [("same same same same", "fr")] * 6
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    want = plain(rows, 5)
    assert len(want) > 100
    assert found(collocations.collocations(df, least=5)) == want
    monkeypatch.setattr(collocations, "CHUNK", 40)
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 0)
    assert found(collocations.collocations(df, least=5)) == want
    assert found(collocations.collocations(df, least=5, top=7)) == plain(rows, 5, 7)


def test_edge_rows(spark, edge, nothing):
    rows = [(e[1], e[2]) for e in EDGE]
    assert found(collocations.collocations(edge, least=2)) == plain(rows, 2)
    assert collocations.collocations(nothing).collect() == []
    assert collocations.collocations(edge.where("text = ''")).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    layout = "unit long, lang string, a long, words array<string>, heads array<long>, tails array<long>"
    a = 9 * 10**15
    df = spark.createDataFrame([(1, "en", a, ["x", "y"], [a + 1, a], [a + 3, a])], layout)
    row = collocations._scored(df, None).collect()[0]
    assert (row["l"], row["r"], row["score"]) == (a + 1, a + 3, 2000000 * a // (2 * a + 4))
