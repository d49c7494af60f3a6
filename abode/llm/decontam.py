"""Benchmark decontamination: find test items in documents within an edit budget.

An item of n characters may differ by k edits (a share of n). Cut into k + 1
pieces, at least one piece must occur unchanged in any such copy, so an
Aho-Corasick pass over the pieces of all items finds every place worth a look,
and Myers' bit-parallel distance decides there, on growing spans around the
piece first. Windows of one item that
overlap are verified as one, so no character is verified twice for an item.

Documents are only mapped over: no shuffle, whatever is common in them. Items
reach the tasks in blocks of bounded size; a large benchmark takes several
passes over the documents, one for each block.
"""

from __future__ import annotations

import pickle
from functools import lru_cache

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from abode.llm.batches import map_batches

RATE = 0.1  # edits allowed, as a share of the item's characters
LEAST_PIECE, LEAST_ITEM = 8, 20
BLOCK_CHARS = 8_000_000


def normal(text: str) -> str:
    """Lower case, each run of white space one blank."""
    return " ".join(text.lower().split())


def budget(n: int, rate: float = RATE) -> int:
    """Edits allowed in an item of ``n`` characters, so that no piece is under ``LEAST_PIECE``."""
    return max(0, min(int(n * rate), n // LEAST_PIECE - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length with their offsets."""
    cuts = [i * len(item) // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def ancestors(n: int, k: int) -> list[list[tuple[int, int, int]]]:
    """For each piece, the spans that hold it when the pieces are halved again and again, small ones first.

    A span of p pieces comes as ``(start, end, p - 1)``. If the whole has at most
    k edits, one of any span's halves has fewer edits than pieces, down to a piece
    with none; so a hit counts only if each span around it is within its share.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(k + 1)]

    def halve(low: int, high: int) -> None:
        if high - low > 1:
            half = (low + high) // 2
            halve(low, half)
            halve(half, high)
            for i in range(low, high):
                out[i].append((low * n // (k + 1), high * n // (k + 1), high - low - 1))

    halve(0, k + 1)
    return out


def masks(pattern) -> dict:
    """Bit positions of each character of a string, or of each element of a list."""
    out: dict = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


def distances(peq: dict, n: int, text, anchored: bool = False):
    """Myers' algorithm: after each character of ``text``, the least edit distance of the
    pattern to a substring that ends there (or, ``anchored``, to the whole text so far)."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score, carry = full, 0, n, 1 if anchored else 0
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1 | carry) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        yield score


class Matcher:
    """Searches normalised texts for a block of items ``(id, normalised text)``."""

    def __init__(self, items: list[tuple], rate: float):
        self.items = [(i, t, budget(len(t), rate)) for i, t in items]
        self.masks: dict[tuple, dict] = {}
        self.around = [ancestors(len(t), k) for _, t, k in self.items]
        where: dict[str, list[tuple[int, int, int]]] = {}
        for at, (_, text, k) in enumerate(self.items):
            for i, (offset, piece) in enumerate(pieces(text, k)):
                where.setdefault(piece, []).append((at, i, offset))
        self.machine = ahocorasick.Automaton()
        for piece, places in where.items():
            self.machine.add_word(piece, (len(piece), places))
        if where:
            self.machine.make_automaton()
        self.empty = not where

    def find(self, text: str) -> list[tuple]:
        """``(item id, distance, start, end)`` of the best match of each item found; the first of equally good ones."""
        if self.empty:
            return []
        starts: dict[int, set[int]] = {}
        for end, (size, places) in self.machine.iter(text):
            for at, i, offset in places:
                place = end + 1 - size - offset
                if place not in starts.get(at, ()) and self._likely(at, i, place, text):
                    starts.setdefault(at, set()).add(place)
        out = []
        for at, places in sorted(starts.items()):
            best = self._verify(at, sorted(places), text)
            if best:
                out.append((self.items[at][0], *best))
        return out

    def _mask(self, at: int, start: int, end: int, step: int = 1) -> dict:
        key = at, start, end, step
        if key not in self.masks:
            self.masks[key] = masks(self.items[at][1][start:end][::step])
        return self.masks[key]

    def _likely(self, at: int, i: int, place: int, text: str) -> bool:
        """Whether each proper span around piece ``i`` is within its share of edits where the item would stand."""
        for a, b, e in self.around[at][i][:-1]:
            part = text[max(0, place + a - e) : place + b + e]
            if min(distances(self._mask(at, a, b), b - a, part), default=b - a) > e:
                return False
        return True

    def _verify(self, at: int, places: list[int], text: str) -> tuple[int, int, int] | None:
        _, item, k = self.items[at]
        n, best = len(item), None
        windows: list[list[int]] = []
        for p in places:
            a, b = max(0, p - k), min(len(text), p + n + k)
            if windows and a <= windows[-1][1]:
                windows[-1][1] = max(windows[-1][1], b)
            else:
                windows.append([a, b])
        for a, b in windows:
            for i, d in enumerate(distances(self._mask(at, 0, n), n, text[a:b]), a + 1):
                if d <= k and (best is None or d < best[0]):
                    best = d, i
        if best is None:
            return None
        d, end = best
        back = distances(self._mask(at, 0, n, -1), n, text[max(0, end - n - k) : end][::-1], anchored=True)
        size = next((i for i, x in enumerate(back, 1) if x == d), 0)
        return d, end - size, end


@lru_cache(maxsize=2)
def matcher(packed: bytes) -> Matcher:
    return Matcher(*pickle.loads(packed))


def blocks(benchmark: DataFrame, item_col: str, text_col: str, rate: float, block_chars: int = BLOCK_CHARS) -> list[bytes]:
    """The items, normalised, in packed blocks of about ``block_chars`` characters.

    Items with a null text or under ``LEAST_ITEM`` characters are left out: such
    strings occur in ordinary prose.
    """
    items = benchmark.where(F.col(text_col).isNotNull()).select(
        F.col(item_col).alias("_item"), F.col(text_col).cast("string").alias("_text")
    )
    total = items.agg(F.sum(F.length("_text"))).collect()[0][0] or 0
    count = max(1, -(-total // block_chars))
    out = []
    for b in range(count):
        own = items.where(F.pmod(F.xxhash64("_text"), F.lit(count)) == b).collect()
        found = [(r["_item"], normal(r["_text"])) for r in own]
        found = sorted({x for x in found if len(x[1]) >= LEAST_ITEM}, key=lambda x: (x[0] is None, x))
        out.append(pickle.dumps((found, rate)))
    return out


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """A row for each document and item found in it: ``<id_col>, <item_col>, distance, start, end``.

    Texts are compared in lower case with runs of white space as one blank;
    ``start`` and ``end`` (exclusive) count characters of that form. Documents
    with no item, with a null or an empty text give no rows, nor does an empty
    table or benchmark. Rows that repeat a document repeat its matches; an item
    that occurs several times in a document is reported once, at its best place.
    """
    schema = pa.schema(
        [
            (id_col, to_arrow_type(df.schema[id_col].dataType)),
            (item_col, to_arrow_type(benchmark.schema[item_col].dataType)),
            ("distance", pa.int32()),
            ("start", pa.int64()),
            ("end", pa.int64()),
        ]
    )

    def one(packed: bytes) -> DataFrame:
        def work(batch: pa.RecordBatch) -> dict:
            own = matcher(packed)
            rows = [(i, *m) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t for m in own.find(normal(t))]
            return {f.name: [r[c] for r in rows] for c, f in enumerate(schema)}

        return map_batches(df.select(F.col(id_col), F.col(text_col)), work, schema)

    parts = [one(b) for b in blocks(benchmark, item_col, item_text_col, rate, block_chars)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_leaks(
    df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE
) -> DataFrame:
    """``df`` without the rows in whose text an item was found."""
    for packed in blocks(benchmark, item_col, item_text_col, rate):
        df = df.where(_clean(packed)(F.col(text_col)))
    return df


def _clean(packed: bytes):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        own = matcher(packed)
        return pd.Series([not (t and own.find(normal(t))) for t in texts])

    return clean
